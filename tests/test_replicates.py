"""Replicate vectors against the weights row by row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import replicates, resample


def cohort(pairs, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for g, n in (("A", 300), ("B", 150), ("C", 20), (None, 9)):
        y = rng.uniform(20, 250, n).round(1)
        rows += [(g, a, b) for a, b in zip(y, y + rng.normal(0, 40, n))]
    return pairs(rows + [("A", 100.0, 100.0)] * 40)


def long_form(vectors, per_vector):
    """Weights per content and replicate, added up over the runs."""
    each = vectors.select("*", F.posexplode("weights").alias("i", "weight")).filter("weight > 0")
    content = ["stratum", "GIA", "lpa_nmol_max", "lpa_pred_nm"]
    return each.groupBy(*content, (F.col("block") * per_vector + F.col("i") + 1).cast("int").alias("replicate")).agg(
        F.sum("weight").alias("weight")
    )


@pytest.mark.parametrize("copies, per_vector, resamples", [(1024, 250, 30), (7, 11, 30), (1, 30, 30), (16, 1, 5)])
def test_vectors_hold_the_weights(pairs, monkeypatch, copies, per_vector, resamples):
    monkeypatch.setattr(resample, "_COPIES_PER_CHUNK", copies)
    drawn = resample.numeric_resampler(cohort(pairs), resamples, 3)
    vectors = replicates.weight_vectors(drawn, per_vector)
    want = sorted(map(tuple, drawn.weights().collect()), key=str)
    assert sorted(map(tuple, long_form(vectors, per_vector).collect()), key=str) == want
    rows = vectors.collect()
    assert max(r["copies"] for r in rows) <= copies and {len(r["weights"]) for r in rows} <= {per_vector, resamples % per_vector or per_vector}
    totals = vectors.groupBy("stratum").agg(F.sum(F.aggregate("weights", F.lit(0), lambda n, v: n + v)).alias("t")).collect()
    sizes = {r["stratum"]: r["size"] for r in drawn.strata.collect()}
    assert {r["stratum"]: r["t"] for r in totals} == {s: n * resamples for s, n in sizes.items()}


def test_overfull_strata(pairs):
    """Without slack about every other replicate draws more than its rows and is picked anew."""
    strata = resample.bootstrap_strata(cohort(pairs), "GIA", 0.1, 3)
    drawn = resample.Resampler(strata, ["GIA"], "lpa_nmol_max", "lpa_pred_nm", 40, 3, slack=0.0)
    assert sorted(map(tuple, long_form(replicates.weight_vectors(drawn, 16), 16).collect()), key=str) == sorted(
        map(tuple, drawn.weights().collect()), key=str
    )


def test_dot_products_give_the_bootstrap(pairs):
    drawn = resample.numeric_resampler(cohort(pairs), 60, 3)
    vectors = replicates.weight_vectors(drawn, 25)
    got = {(r["GIA"], r["replicate"], r["metric"]): r["value"] for r in replicates.vector_replicates(vectors, "lpa_nmol_max", "lpa_pred_nm", per_vector=25).collect()}
    want = {(r["GIA"], r["replicate"], r["metric"]): r["value"] for r in resample.numeric_replicates(drawn).collect()}
    assert got.keys() == want.keys() and len(got) == 5 * 60 * 3
    for key, value in want.items():
        assert got[key] == pytest.approx(value, rel=1e-9), key


def test_no_rows(pairs):
    drawn = resample.numeric_resampler(cohort(pairs).limit(0), 5, 3)
    vectors = replicates.weight_vectors(drawn)
    assert vectors.count() == 0 and replicates.vector_replicates(vectors, "lpa_nmol_max", "lpa_pred_nm").count() == 0


def test_picks_are_neither_joined_nor_shuffled_one_by_one(pairs):
    drawn = resample.numeric_resampler(cohort(pairs), 30, 3)
    for df in (replicates.weight_vectors(drawn), drawn.weights()):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        # Runs are listed by one explode and runs of picks by another; no row per position, per pick, or sum per replicate.
        assert plan.count("Generate") <= 3 and "position" not in plan.replace("pick_positions", "") and "count(1)" not in plan
        assert "sum(weight" not in plan


@pytest.mark.parametrize("wide, copies, slack", [(1, 7, 3.0), (64, 7, 0.0), (64, 1024, 3.0), (5000, 1, -2.0), (1, 1, 1e9)])
def test_ranges_do_not_change_the_weights(pairs, monkeypatch, wide, copies, slack):
    """Runs that begin in one range of positions and end in the next, values of several runs, many picks."""
    strata = resample.bootstrap_strata(cohort(pairs), "GIA", 0.1, 3)
    y = F.col("lpa_nmol_max")

    def sums(drawn):
        explicit = drawn.weights().groupBy("GIA", "replicate").agg(F.sum("weight").cast("double").alias("n"), F.sum(F.col("weight") * y).alias("sy"))
        return [{(r["GIA"], r["replicate"]): (r["n"], pytest.approx(r["sy"])) for r in df.collect()} for df in (explicit, drawn.sums({"n": F.lit(1.0), "sy": y}))]

    monkeypatch.setattr(resample, "_POSITIONS_PER_RANGE", wide)
    monkeypatch.setattr(resample, "_COPIES_PER_CHUNK", copies)
    explicit, by_term = sums(resample.Resampler(strata, ["GIA"], "lpa_nmol_max", "lpa_pred_nm", 12, 3, slack))
    assert explicit.keys() == by_term.keys()
    assert all(explicit[k][0] == by_term[k][0] and by_term[k][1].expected == explicit[k][1] for k in explicit)
