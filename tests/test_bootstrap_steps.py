"""What the steps of the row by row bootstrap carry and repeat."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from cohortlens.operators import cohort, resample
from verification import queries
from verification.oracle import ORACLE


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _cohort(pairs):
    return pairs([("AFR" if i % 3 else "EUR", i % 17 + 1, i % 13 + 2) for i in range(300)])


def test_picks_carry_the_values_not_their_terms(spark, pairs, monkeypatch):
    asked = []
    found = resample.Resampler._picked

    def picked(self, drawn, columns):
        out = found(self, drawn, columns)
        asked.append(out.columns)
        return out

    monkeypatch.setattr(resample.Resampler, "_picked", picked)
    resampler = resample.numeric_resampler(_cohort(pairs), 30, 5)
    sums = resampler.sums(resample.numeric_terms(F.col(resampler.truth), F.col(resampler.estimate), 3.0, 2.0))
    assert set(asked[0]) == {"stratum", "replicate", "position", "GIA", "lpa_nmol_max", "lpa_pred_nm"}
    # Weighted sums of the same resamples, from their weights.
    y, w = F.col("lpa_nmol_max") - 3.0, F.col("weight")
    want = resampler.weights().groupBy("GIA", "replicate").agg(F.sum(w).alias("n"), F.sum(w * y * y).alias("syy"))
    want = {(r["GIA"], r["replicate"]): (r["n"], r["syy"]) for r in want.collect()}
    got = {(r["GIA"], r["replicate"]): (r["n"], r["syy"]) for r in sums.collect()}
    assert got.keys() == want.keys() and all(abs(got[k][j] - want[k][j]) < 1e-6 for k in want for j in (0, 1))


def test_tasks_are_long_beside_what_they_hand_on():
    # A million rows and 1000 resamples: some tasks of seconds, not fifty of a fraction of one.
    shape = SimpleNamespace(units=SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=SimpleNamespace(defaultParallelism=2))))
    assert resample.Resampler._tasks(shape, 1_000_000_000, resample._DRAWS_PER_TASK) <= 10


def test_group_sizes_do_not_join_the_pairs_again(spark, pairs, monkeypatch):
    table = _cohort(pairs)
    joined = table.join(table.select("ID", F.lit(1).alias("one")), "ID")
    seen, found = [], cohort.min_group_filter
    monkeypatch.setattr(cohort, "min_group_filter", lambda df, *a: seen.append(_plan(df)) or found(df, *a))
    inputs = SimpleNamespace(pairs=joined)
    assert queries._valid(inputs).count() == 300
    assert seen and "Join" not in seen[0]


def test_registered_weights_are_those_of_a_whole_run(pairs, monkeypatch):
    """As many resamples as the bootstrap of a validation run has, in the query and in its SQL."""
    asked, found = [], resample.numeric_resampler
    monkeypatch.setattr(resample, "numeric_resampler", lambda df, n, seed: asked.append(n) or found(df, 3, seed))
    build = {q: f for q, f in queries.QUERIES.items() if q == "bootstrap_weights"}["bootstrap_weights"]
    monkeypatch.setattr(queries, "Inputs", lambda spark, sf_dir: SimpleNamespace(pairs=_cohort(pairs)))
    assert build(None, "").agg(F.max("replicate")).first()[0] == 3 and asked == [1000]
    assert "generate_series(1, 1000)" in ORACLE["bootstrap_weights"] and "generate_series(1, 20)" not in ORACLE["bootstrap_weights"]


def test_bootstraps_write_only_what_they_read(pairs):
    inputs = SimpleNamespace(pairs=_cohort(pairs).withColumn("age", F.lit(1.0)))
    assert set(queries._valid(inputs).columns) == {"ID", "GIA", "lpa_nmol_max", "lpa_pred_nm", "n"}
