import pytest
from pyspark.sql import functions as F

from cohortlens.operators import cohort, joins


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_pred_summary_worked_example_and_missing_part(spark):
    parts = spark.createDataFrame(
        [("S1", 40.0, 3.0), ("S1", 60.0, 4.0), ("S2", 1.0, None), ("S2", None, 1.0), ("S3", float("nan"), 1.0)],
        "ID string, Lpa_pred_nM double, min_uncertainty_nM double",
    )
    got = {r["ID"]: r for r in cohort.pred_summary(parts).collect()}
    assert (got["S1"]["lpa_pred_nm"], got["S1"]["lpa_pred_se"]) == (100.0, 5.0)
    assert round(got["S1"]["lpa_pred_lci95"], 6) == 90.2 and round(got["S1"]["lpa_pred_uci95"], 6) == 109.8
    assert got["S2"]["lpa_pred_nm"] is None and got["S2"]["lpa_pred_se"] is None
    assert got["S3"]["lpa_pred_nm"] is None and got["S3"]["lpa_pred_se"] == 1.0


@pytest.fixture
def two_tables(spark):
    pred = spark.createDataFrame([(1, 10.0), (2, 20.0), (None, 30.0), (4, 40.0)], "ID bigint, lpa_pred_nm double")
    measured = spark.createDataFrame(
        [(1, 1.0), (1, 1.5), (None, 3.0), (9, 9.0)] + [(4, float(v)) for v in range(50)], "ID bigint, lpa_nmol_max double"
    )
    return pred, measured


def test_left_join_null_safe_with_duplicates(two_tables):
    got = rows(cohort.join_pred_measured(*two_tables), "ID", "lpa_pred_nm", "lpa_nmol_max")
    assert len(got) == 2 + 1 + 1 + 50
    assert (None, 30.0, 3.0) in got and (2, 20.0, None) in got and (1, 10.0, 1.5) in got
    assert not any(g[0] == 9 for g in got)


def test_hot_key_path_gives_the_same_rows(two_tables):
    plain = rows(cohort.join_pred_measured(*two_tables, hot_rows=None), "ID", "lpa_pred_nm", "lpa_nmol_max")
    assert joins.hot_keys(two_tables[1], "ID", 10) == ([4], True)
    assert rows(cohort.join_pred_measured(*two_tables, hot_rows=10), "ID", "lpa_pred_nm", "lpa_nmol_max") == plain


def test_null_on_one_side_only(two_tables):
    pred, measured = two_tables
    for a, b in ((pred.filter("ID is not null"), measured), (pred, measured.filter("ID is not null"))):
        assert rows(cohort.join_pred_measured(a, b), "ID", "lpa_nmol_max") == rows(
            cohort.join_pred_measured(a, b, hot_rows=None), "ID", "lpa_nmol_max"
        )


def test_hot_key_without_prediction_is_dropped(spark, two_tables):
    pred, measured = two_tables
    got = cohort.join_pred_measured(pred.filter("ID <> 4"), measured, hot_rows=10)
    assert rows(got, "ID") == rows(cohort.join_pred_measured(pred.filter("ID <> 4"), measured, hot_rows=None), "ID")


def test_min_group_boundary_and_null_group(pairs):
    df = pairs([("A", 1, 1)] * 20 + [("B", 1, 1)] * 21 + [(None, 1, 1)] * 25 + [("B", None, 1)] * 5)
    kept = cohort.validation_cohort(df)
    assert rows(kept.groupBy("GIA").agg(F.count("*").alias("c"), F.max("n").alias("n")), "GIA", "c", "n") == [
        ("B", 21, 21), (None, 25, 25)
    ]


def test_attach_falls_back_to_a_shuffled_join(pairs, monkeypatch):
    df = pairs([(f"g{i % 30}", 1, 1) for i in range(300)] + [(None, 1, 1)])
    small = rows(cohort.add_group_size(df), "ID", "n")
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 5)
    assert rows(cohort.add_group_size(df), "ID", "n") == small
    assert rows(cohort.min_group_filter(df, "GIA", 9), "ID", "n") == [r for r in small if r[1] > 9]


def test_nan_is_missing_in_pairs(pairs):
    assert cohort.complete_pairs(pairs([("A", float("nan"), 1), ("A", 1, None), ("A", 1, 2)])).count() == 1


def test_contracts(pairs):
    df = pairs([("EUR", 1, 1), ("XX", 1, 1), (None, 1, 1)])
    with pytest.raises(ValueError, match="age"):
        cohort.require_columns(df, ["ID", "age"])
    assert rows(cohort.domain_violations(df), "GIA") == [("XX",), (None,)]
    with pytest.raises(ValueError, match="XX"):
        cohort.require_domain(df)
    assert cohort.available_columns(df, ["age", "GIA"]) == ["GIA"]
    assert cohort.available_columns(df, ["age"], at_least=2, exclude=["ID"], extra=2) == ["GIA", "lpa_nmol_max"]


def test_group_order_puts_other_last(pairs):
    df = pairs([("B", 1, 1)] * 5 + [("A", 1, 1)] * 5 + [("Other", 1, 1)] * 90 + [("C", 1, 1)] * 7)
    order = cohort.group_order(df)
    assert [r["GIA"] for r in order.orderBy("ord").collect()] == ["C", "A", "B", "Other"]
    table = df.sparkSession.createDataFrame([("A", 1), ("Z", 2), ("Overall", 3), ("C", 4)], "GIA string, v int")
    assert [r["GIA"] for r in cohort.overall_first(table, order).collect()] == ["Overall", "C", "A", "Z"]


def test_sizes_keep_null_group_apart_from_total(pairs):
    got = rows(cohort.group_sizes(pairs([("A", 1, 1), (None, 1, 1), (None, 2, 2)])), "GIA", "pop_size")
    assert sorted(got, key=str) == sorted([("A", 1), (None, 2), ("Overall", 3)], key=str)


def test_preparation(spark):
    m = spark.createDataFrame([(1, 10.0, "mg/dL"), (1, 20.0, "nmol/L"), (2, None, "mg/dL")], "id int, v double, u string")
    assert rows(cohort.max_per_person(m, "id", "v", "u"), "id", "lpa_nmol_max") == [(1, 21.5), (2, None)]
    codes = spark.createDataFrame([(1, "401"), (1, "401"), (1, "250"), (2, "250"), (2, None)], "id int, code string")
    assert rows(cohort.code_flag(codes, "id", "code", {"HTN": "401", "DM": "250"}), "id", "HTN", "DM") == [
        (1, True, False), (2, False, False)
    ]
    a, b = spark.createDataFrame([(1,), (2,), (2,)], "ID int"), spark.createDataFrame([(2,), (3,), (4,)], "ID int")
    assert tuple(cohort.id_overlap(a, b).first()) == (1, 1, 2)
    assert [r["t"] for r in cohort.total_count(a).select(F.col("total_count").alias("t")).collect()] == [3, 3, 3]


def test_headline_counts_rows_and_measured_apart(spark, pairs):
    parts = spark.createDataFrame([(1,), (1,), (2,), (2,)], "ID int")
    measured = pairs([("A", 1, 1), ("A", None, 1), ("A", float("nan"), 1)])
    metrics = spark.createDataFrame(
        [("Overall", "rsq", 0.12345), ("Overall", "rmse", 3.25), ("A", "rsq", 0.9)], "GIA string, metric string, estimate double"
    )
    row = cohort.headline(parts, measured, measured.limit(1), metrics).first()
    assert tuple(row) == (2.0, 3, 1, 1, 0.123, 3.2)
