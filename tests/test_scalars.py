import math

from pyspark.sql import functions as F

from cohortlens.functions import scalars as s


def one(spark, col, **values):
    schema = ", ".join(f"{k} {'double' if not isinstance(v, str) else 'string'}" for k, v in values.items())
    row = [tuple(v for v in values.values())]
    return spark.createDataFrame(row, schema).select(col.alias("o")).first()["o"]


def test_ratio_guards(spark):
    r = s.ratio(F.col("a"), F.col("b"))
    assert one(spark, r, a=3.0, b=2.0) == 1.5
    assert one(spark, r, a=3.0, b=0.0) == math.inf
    assert one(spark, r, a=0.0, b=0.0) is None
    assert spark.range(1).select(s.ratio(F.lit(1.0), F.lit(None).cast("double")).alias("o")).first()["o"] is None


def test_normal_ci_worked_example(spark):
    df = spark.createDataFrame([(100.0, 5.0)], "e double, se double")
    row = s.normal_ci(df, "e", "se").first()
    assert (round(row["lower"], 6), round(row["upper"], 6)) == (90.2, 109.8)


def test_exceeds_is_strict(spark):
    assert one(spark, s.exceeds(F.col("a"), F.lit(150.0)), a=150.0) is False
    assert one(spark, s.exceeds(F.col("a"), F.lit(150.0)), a=150.001) is True


def test_strata_key_prints_missing_group(spark):
    df = spark.createDataFrame([(None, True, 125.0), ("EUR", False, 12.5)], "g string, c boolean, t double")
    keys = [r["k"] for r in df.select(s.strata_key(F.col("g"), F.col("c"), F.col("t")).alias("k")).collect()]
    assert keys == ["NA_TRUE_125", "EUR_FALSE_12.5"]


def test_p_value_bands(spark):
    df = spark.createDataFrame([(p,) for p in (None, 0.0009, 0.001, 0.009, 0.01, 0.049, 0.05)], "p double")
    got = [r["b"] for r in df.select(s.p_value_band(F.col("p")).alias("b")).collect()]
    assert got == ["NA", "p < 0.001", "p < 0.01", "p < 0.01", "p < 0.05", "p < 0.05", "p \u2265 0.05"]


def test_texts(spark):
    df = spark.createDataFrame([(1.236, math.inf, None)], "a double, b double, c double")
    row = df.select(
        s.ratio_label(F.col("a")).alias("a"), s.ratio_label(F.col("b")).alias("b"), s.ratio_label(F.col("c")).alias("c"),
        s.pct_label(F.col("a")).alias("p"), s.pct_label(F.col("c")).alias("n"),
        s.ci_label(F.col("a"), F.lit(0.5), F.col("c"), 2, "%").alias("ci"),
        s.group_label(F.lit("EUR"), F.lit(12)).alias("g"),
    ).first()
    assert tuple(row) == ("1.24x", "\u221e", "NA", "1.2%", "NA%", "1.24% (0.50%-NA%)", "EUR (n = 12)")


def test_round_cols_half_even(spark):
    df = spark.createDataFrame([(0.125, 0.125)], "estimate_a double, other double")
    assert tuple(s.round_cols(df, ["estimate"]).first()) == (0.12, 0.125)


def test_relabel_and_kind(spark):
    df = spark.createDataFrame([("sens", "lpa_pred_nm"), ("odd", "lpa_nmol_max")], "m string, n string")
    got = df.select(s.relabel(F.col("m"), s.METRIC_LABELS).alias("m"), s.measurement_type(F.col("n")).alias("n")).collect()
    assert [tuple(r) for r in got] == [("Sensitivity", "Predicted"), ("odd", "Measured")]


def test_unit_conversion(spark):
    df = spark.createDataFrame([(10.0, "mg/dL"), (10.0, "nmol/L"), (10.0, None)], "v double, u string")
    assert [r["o"] for r in df.select(s.to_nmol(F.col("v"), F.col("u")).alias("o")).collect()] == [21.5, 10.0, 10.0]


def test_prefer_adjusted(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0)], "a double, b double")
    assert [r["o"] for r in df.select(s.prefer_adjusted(F.col("a"), F.col("b")).alias("o")).collect()] == [1.0, 2.0]
