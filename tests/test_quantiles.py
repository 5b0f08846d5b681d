import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import quantiles

PROBS = {"a": 0.0, "b": 0.025, "c": 0.5, "d": 0.75, "e": 1.0}


def check(spark, groups):
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs]
    rows += [("x", None), ("x", float("nan")), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    got = {r["k"]: r for r in quantiles.exact_quantiles(df, ["k"], "v", PROBS).collect()}
    for k, vs in groups.items():
        assert got[k]["n"] == len(vs)
        for name, p in PROBS.items():
            assert got[k][name] == pytest.approx(np.quantile(vs, p), abs=1e-12), (k, name)
    assert got[None]["c"] == 1.5 and "x" not in got


def test_small_groups(spark):
    check(spark, {"three": [1, 2, 4], "one": [7], "ties": [1] * 9 + [5], "two": [3, 1]})
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "v double")
    assert quantiles.exact_quantiles(df, [], "v", {"q": 0.025}).first()["q"] == pytest.approx(1.05)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_large_groups_take_the_sketch_path(spark, monkeypatch, seed):
    monkeypatch.setattr(quantiles, "ACCURACY", 200)
    monkeypatch.setattr(quantiles, "_MARGIN", 4.0 / 200)
    rng = np.random.default_rng(seed)
    check(spark, {
        "normal": rng.normal(size=5000), "hot": np.where(rng.uniform(size=4000) < 0.4, 3.0, rng.exponential(size=4000)),
        "few": rng.integers(0, 5, 3000), "heavy": rng.standard_cauchy(3001) ** 3, "small": rng.normal(size=150),
    })


def test_only_few_values_reach_the_window(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "ACCURACY", 1000)
    monkeypatch.setattr(quantiles, "_MARGIN", 4.0 / 1000)
    df = spark.range(200_000).select(F.hash("id").cast("double").alias("v"))
    got = quantiles.exact_quantiles(df, [], "v", {"m": 0.5})
    assert got.first()["m"] == pytest.approx(df.agg(F.expr("percentile(v, 0.5)")).first()[0])


@pytest.mark.parametrize("seed", [1, 2])
def test_slices_give_the_same(spark, monkeypatch, seed):
    monkeypatch.setattr(quantiles, "SPLIT_ROWS", 100)
    monkeypatch.setattr(quantiles, "_SLICES", 16)
    test_large_groups_take_the_sketch_path(spark, monkeypatch, seed)


def test_no_window_holds_more_as_a_group_grows(spark, monkeypatch):
    """The largest number of values that one slice orders stays put while the group grows."""
    monkeypatch.setattr(quantiles, "SPLIT_ROWS", 100)
    monkeypatch.setattr(quantiles, "ACCURACY", 100)
    monkeypatch.setattr(quantiles, "_MARGIN", 4.0 / 100)
    most = []
    ranked = quantiles._ranked

    def spy(counted, keys, split):
        assert split
        most.append(counted.groupBy(*keys, "region", "slice").count().agg(F.max("count")).first()[0])
        return ranked(counted, keys, split)

    monkeypatch.setattr(quantiles, "_ranked", spy)
    for n, slices in ((20_000, 64), (80_000, 256)):
        monkeypatch.setattr(quantiles, "_SLICES", slices)
        df = spark.range(n).select(F.rand(3).alias("v"))
        got = quantiles.exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"]
        assert got == pytest.approx(df.agg(F.expr("percentile(v, 0.5)")).first()[0])
    assert most[1] < 1.5 * most[0]
