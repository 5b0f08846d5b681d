import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from cohortlens.operators import intervals as iv

CALL = "chrom string, pos bigint, ref string, alt string, sample string"
REGION = "region string, chrom string, first bigint, last bigint"


def plan(df):
    mode = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def brute(records, regions):
    return sorted(
        (*r[:2], r[4], g[0]) for r in records for g in regions
        if None not in (r[0], r[1], g[1], g[2], g[3]) and r[0] == g[1] and g[2] <= g[3]
        and r[1] <= g[3] and r[1] + max(len(r[2] or ""), 1) - 1 >= g[2]
    )


@pytest.mark.parametrize("bin_bases", [1, 7, 100, 16_384])
def test_all_pairs_once(spark, bin_bases):
    rng = random.Random(bin_bases)
    records = [(rng.choice("12"), rng.randint(-20, 400), "A" * rng.choice([0, 1, 2, 30, 90]), "G", f"s{i}") for i in range(150)]
    records += [records[0], (None, 5, "A", "G", "n1"), ("1", None, "A", "G", "n2"), ("1", 5, None, "G", "n3")]
    regions = [(f"r{i}", rng.choice("123"), a := rng.randint(-10, 380), a + rng.choice([-3, 0, 5, 200])) for i in range(30)]
    regions += [regions[0], ("r", None, 1, 9), ("r", "1", None, 9), ("r", "1", 1, None)]
    calls, places = spark.createDataFrame(records, CALL), spark.createDataFrame(regions, REGION)
    found = iv.overlaps(calls, places, bin_bases=bin_bases)
    assert found.columns == [*calls.columns, "region"]
    want = brute(records, regions)
    assert sorted((r["chrom"], r["pos"], r["sample"], r["region"]) for r in found.collect()) == want
    hit = {w[2] for w in want}
    semi = [r["sample"] for r in iv.overlaps(calls, places, "left_semi", bin_bases).collect()]
    anti = [r["sample"] for r in iv.overlaps(calls, places, "left_anti", bin_bases).collect()]
    assert sorted(semi + anti) == sorted(r[4] for r in records) and set(semi) == hit and not hit & set(anti)


def test_both_bounds_reach_the_scan_and_row_groups_are_skipped(spark, tmp_path):
    rows = [("6", p, "A" * 50, "G", "s") for p in range(0, 100_000, 10)]
    folder = str(tmp_path / "calls")
    iv.lay_out(spark.createDataFrame(rows, CALL), folder, 20)
    regions = spark.createDataFrame([("a", "6", 50_000, 50_100), ("b", "6", 50_500, 50_510)], REGION)
    found = iv.overlaps(iv.read_laid_out(spark, folder), regions)
    pushed = next(line for line in plan(found).splitlines() if "PushedFilters" in line)
    assert "LessThanOrEqual(pos,50510)" in pushed and "GreaterThanOrEqual(last,50000)" in pushed and "EqualTo(chrom,6)" in pushed
    assert found.count() == 15 + 6
    # Files hold neighbouring positions.
    columns = [pq.read_table(f)["pos"].to_pylist() for f in Path(folder).glob("*.parquet")]
    ends = sorted((min(c), max(c)) for c in columns if c)
    assert len(ends) >= 10 and all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_nothing_to_find(spark):
    calls = spark.createDataFrame([("6", 5, "A", "G", "s")], CALL)
    none = spark.createDataFrame([], REGION)
    assert iv.overlaps(calls, none).count() == 0 and iv.overlaps(calls, none, "left_anti").count() == 1
    assert iv.overlaps(calls.limit(0), spark.createDataFrame([("a", "6", 1, 9)], REGION)).count() == 0
    with pytest.raises(ValueError):
        iv.overlaps(calls, none, "outer")


def test_files_of_long_alleles_stay_small_in_memory(spark, tmp_path, monkeypatch):
    # Such texts shrink to nothing when shuffled, so the number of files must not depend on shuffled sizes.
    monkeypatch.setattr(iv, "FILE_BYTES", 1 << 20, raising=False)
    calls = spark.range(2000).selectExpr("'6' as chrom", "id * 3 as pos", "repeat('A', 5000) as ref", "'G' as alt", "'s' as sample")
    iv.lay_out(calls, str(tmp_path / "calls"))
    held = [sum(len(t) for t in pq.read_table(f)["ref"].to_pylist()) for f in Path(tmp_path / "calls").glob("*.parquet")]
    assert len(held) >= 10 and max(held) < 3 << 20 and sum(held) == 10_000_000
    iv.lay_out(calls.limit(0), str(tmp_path / "none"))
    assert iv.read_laid_out(spark, str(tmp_path / "none")).count() == 0
