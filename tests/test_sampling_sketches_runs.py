import random

import pytest
from pyspark.sql import functions as F

from cohortlens.functions.draws import draw60
from cohortlens.operators import impact, sampling, sketches
from cohortlens.sources import runs

ROW = "ID bigint, g string, x double"


@pytest.fixture
def rows(spark):
    rng = random.Random(2)
    data = [(i, rng.choice("aaab"), rng.uniform(0, 9)) for i in range(3000)] + [(9000 + i, "c", 1.0) for i in range(20)]
    data += [(None, None, None), (1, None, float("nan"))] + [(5555, "hot", 2.5)] * 900 + [(7000 + i, "hot", 2.5) for i in range(900)]
    return spark.createDataFrame(data, ROW)


def brute(df, k, seed):
    """The k smallest draws per group by a plain sort."""
    text = [F.coalesce(F.col(c).try_cast("decimal(38,6)").cast("string"), F.lit("NA")) for c in ("ID", "x")]
    groups = {}
    for r in df.select("*", draw60(seed, "sample", *text).alias("draw")).collect():
        groups.setdefault(r["g"], []).append((r["draw"], str(r["ID"]), str(r["x"])))
    return {g: (sorted(v)[:k], len(v)) for g, v in groups.items()}


def as_groups(sample):
    out = {}
    for r in sample.collect():
        out.setdefault(r["g"], []).append((r["draw"], str(r["ID"]), str(r["x"])))
    return {g: sorted(v) for g, v in out.items()}


@pytest.mark.parametrize("k", [1, 10, 100, 2500])
def test_smallest_draws_of_every_group(rows, k):
    sample = sampling.bottom_k(rows, ["g"], ["ID", "x"], k, 4)
    want = brute(rows, k, 4)
    assert as_groups(sample) == {g: v for g, (v, _) in want.items()}
    weights = {r["g"]: (r["n"], r["w"]) for r in sample.groupBy("g").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    for g, (kept, n) in want.items():
        assert weights[g] == (len(kept), pytest.approx(n))


def test_samples_of_parts_merge(rows):
    parts = [sampling.bottom_k(rows.filter(F.coalesce(F.pmod("ID", F.lit(3)), F.lit(0)) == i), ["g"], ["ID", "x"], 40, 4) for i in range(3)]
    merged, whole = sampling.merge_samples(parts, ["g"], ["ID", "x"], 40), sampling.bottom_k(rows, ["g"], ["ID", "x"], 40, 4)
    assert as_groups(merged) == as_groups(whole)
    total = lambda s: sorted((str(r["g"]), r["w"]) for r in s.groupBy("g").agg(F.round(F.sum("weight"), 6).alias("w")).collect())
    assert total(merged) == total(whole)


def test_sample_of_nothing(rows):
    assert sampling.bottom_k(rows.limit(0), ["g"], ["ID"], 5).count() == 0
    with pytest.raises(ValueError):
        sampling.bottom_k(rows, ["g"], ["ID"], 0)


def test_sketches_of_parts(spark, tmp_path):
    rng = random.Random(3)
    days = spark.createDataFrame([(d, rng.choice("ab"), rng.gauss(d, 5), rng.choice([None, 1.0, float("nan")])) for d in range(5) for _ in range(8000)],
                                 "day int, g string, x double, y double")
    folder = str(tmp_path / "sketches")
    sketches.store_sketches(sketches.sketch_parts(days.filter("day < 4"), ["x", "y"], "day", "g", 400), folder)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "sketches").rglob("*.parquet")}
    sketches.store_sketches(sketches.sketch_parts(days.filter("day = 4"), ["x", "y"], "day", "g", 400), folder)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "sketches").rglob("*.parquet")}
    assert before.items() <= after.items() and len(after) > len(before)
    table = sketches.stored_sketches(spark, folder)
    summary = sketches.approx_summary(table, 400)
    check = sketches.rank_check(summary, days, ["x", "y"], "g").collect()
    assert len(check) == 2 * 2 * 3 and all(r["within"] for r in check)
    assert sum(r["n"] for r in check if r["variable"] == "x") == 3 * 40_000
    # A wrong estimate is noticed, and one part can be asked for alone.
    wrong = sketches.rank_check(summary.withColumn("median", F.col("median") + 3), days, ["x"], "g")
    assert {r["within"] for r in wrong.filter("p = 0.5").collect()} == {False}
    assert sketches.approx_summary(table.filter("part = 2"), 400).agg(F.sum("n")).first()[0] < 16_000
    # Replacing a part does not count it twice.
    sketches.store_sketches(sketches.sketch_parts(days.filter("day = 2"), ["x"], "day", "g", 400), folder)
    assert sketches.approx_summary(sketches.stored_sketches(spark, folder), 400).filter("variable = 'x'").agg(F.sum("n")).first()[0] == 40_000


def test_few_values_have_exact_ranks(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 101)], "x double")
    row = sketches.summary_continuous_approx(df, ["x"]).first()
    assert (row["stratum"], row["n"], row["p25"], row["median"], row["p75"]) == ("Overall", 100, 25.0, 50.0, 75.0)
    assert sketches.summary_continuous_approx(df.limit(0), ["x"]).count() == 0


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_run_is_seen_whole_or_not_at_all(spark, tmp_path, fmt):
    folder = str(tmp_path / "results")
    good = spark.createDataFrame([(1, "a,b"), (2, None), (2, None)], "n int, t string")
    broken = good.select(F.raise_error(F.lit("broken")).cast("int").alias("n"))
    assert runs.manifests(spark, folder).count() == 0
    with pytest.raises(Exception, match="broken"):
        runs.commit_run(spark, {"first": good, "second": broken}, folder, fmt)
    with pytest.raises(ValueError, match="no complete run"):
        runs.read_run(spark, folder)
    one = runs.commit_run(spark, {"first": good, "second": good.limit(0)}, folder, fmt)
    with pytest.raises(Exception, match="broken"):
        runs.commit_run(spark, {"first": good.limit(1), "second": broken}, folder, fmt)
    seen = runs.read_run(spark, folder, verify=True)
    assert sorted(map(str, seen["first"].collect())) == sorted(map(str, runs.read_run(spark, folder, one)["first"].collect()))
    assert seen["first"].count() == 3 and seen["second"].count() == 0
    two = runs.commit_run(spark, {"first": good.limit(2)}, folder, fmt)
    assert set(runs.read_run(spark, folder)) == {"first"} and set(runs.read_run(spark, folder, one)) == {"first", "second"}
    assert runs.manifests(spark, folder).select("run_id").distinct().count() == 2
    # What was changed behind the manifest's back is noticed.
    runs._stored(spark, f"{folder}/runs/{one}/first", fmt, "n int, t string").limit(1).write.mode("append").option("header", True).format(fmt).save(f"{folder}/runs/{two}/first")
    with pytest.raises(ValueError, match="not what was committed"):
        runs.read_run(spark, folder, verify=True)


def test_fingerprint_tells_tables_apart(spark):
    mark = lambda data, schema="a string, b string": runs.fingerprint(spark.createDataFrame(data, schema))
    assert mark([("x", "y"), ("u", None)]) == mark([("u", None), ("x", "y")])
    different = [[("x", None)], [(None, "x")], [("x", "")], [("x", None)] * 2, [("x", None)] * 3, [("-", None)], []]
    assert len({mark(d) for d in different}) == len(different)


def test_prevalence_reads_the_cohort_once(spark, tmp_path):
    cohort = spark.createDataFrame([(i, "AB"[i % 2], float(i), float(i + 3)) for i in range(200)], "ID bigint, GIA string, lpa_nmol_max double, lpa_pred_nm double")
    cohort.write.parquet(str(tmp_path / "cohort"))
    ppv = spark.createDataFrame([("A", 150.0, "ppv", 0.5)], "GIA string, threshold double, metric string, estimate double")
    table = impact.prevalence_table(spark.read.parquet(str(tmp_path / "cohort")), ppv, [100.0, 150.0])
    mode = table._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    assert "FileScan" not in table._jdf.queryExecution().explainString(mode)
    got = {(r["GIA"], r["threshold"]): r["predicted_elevated_count"] for r in table.collect()}
    assert got[("Overall", 150.0)] == got[("A", 150.0)] + got[("B", 150.0)] == 52
