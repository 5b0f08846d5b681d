import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlens.functions import draws
from cohortlens.operators import resample


@pytest.fixture
def cohort(pairs):
    rng = np.random.default_rng(5)
    rows = []
    for g, n in (("A", 300), ("B", 150), ("C", 20)):
        y = rng.uniform(20, 250, n).round(1)
        rows += [(g, a, b) for a, b in zip(y, y + rng.normal(0, 40, n))]
    rows += [("A", 100.0, 100.0)] * 40  # equal rows
    return pairs(rows)


def resampler(df, b=12, seed=3, pool=0.1):
    return resample.numeric_resampler(df, b, seed, pool)


def test_strata_pooling(pairs):
    df = pairs([("A", 1, 1)] * 85 + [("B", 1, 1)] * 8 + [("C", 1, 1)] * 7)
    assert {r[0] for r in resample.bootstrap_strata(df, "GIA").select("stratum").collect()} == {"A"}
    many = pairs([(f"g{i % 20}", 1, 1) for i in range(200)])
    assert {r[0] for r in resample.bootstrap_strata(many, "GIA").select("stratum").collect()} == {"all"}
    strict = resample.bootstrap_strata(pairs([("A", 1, 1)] * 99 + [(None, 1, 1)]), "GIA", pool=0)
    assert {r[0] for r in strict.select("stratum").collect()} == {"A", "NA"}


def test_pooled_rows_spread_over_the_kept_strata(pairs):
    df = pairs([("A", 1, 1)] * 450 + [("B", 1, 1)] * 450 + [("C", 1, 1)] * 60 + [(None, 1, 1)] * 40)
    got = resample.bootstrap_strata(df, "GIA", seed=1)
    assert got.filter("GIA in ('A','B') and stratum <> GIA").count() == 0
    spread = {r["stratum"]: r["count"] for r in got.filter("GIA is null or GIA = 'C'").groupBy("stratum").count().collect()}
    assert set(spread) == {"A", "B"} and min(spread.values()) > 25


@pytest.mark.parametrize("per_bucket", [250_000, 10])
def test_positions_number_each_stratum_once(cohort, monkeypatch, per_bucket):
    monkeypatch.setattr(resample, "_ROWS_PER_BUCKET", per_bucket)
    index = resample.resample_index(resample.bootstrap_strata(cohort, "GIA"), ["GIA"], "lpa_nmol_max", "lpa_pred_nm").toPandas()
    assert index["copies"].max() == 40
    for _, part in index.groupby("stratum"):
        taken = np.concatenate([np.arange(s, s + c) for s, c in zip(part["start"], part["copies"])])
        assert sorted(taken) == list(range(len(taken)))


def test_positions_do_not_depend_on_buckets(cohort, monkeypatch):
    def index():
        df = resample.resample_index(resample.bootstrap_strata(cohort, "GIA"), ["GIA"], "lpa_nmol_max", "lpa_pred_nm")
        return sorted(map(tuple, df.collect()))

    first = index()
    monkeypatch.setattr(resample, "_ROWS_PER_BUCKET", 3)
    assert index() == first


def test_each_resample_has_the_stratum_size(cohort):
    r = resampler(cohort)
    got = r.weights().groupBy("stratum", "replicate").agg(F.sum("weight").alias("w")).toPandas()
    sizes = {row["stratum"]: row["size"] for row in r.strata.collect()}
    assert len(got) == 12 * len(sizes)
    assert all(w == sizes[s] for s, w in zip(got["stratum"], got["w"]))


@pytest.mark.parametrize("slack", [3.0, 0.0, -2.0, 1e9])
def test_sums_agree_with_the_explicit_weights(cohort, slack):
    """Also where half, nearly all or none of the counts are discarded, and where all draws are picks."""
    r = resample.Resampler(resample.bootstrap_strata(cohort, "GIA"), ["GIA"], "lpa_nmol_max", "lpa_pred_nm", 12, 3, slack)
    w = r.weights().toPandas()
    sizes = {row["stratum"]: row["size"] for row in r.strata.collect()}
    totals = w.groupby(["stratum", "replicate"])["weight"].sum()
    assert len(totals) == 12 * len(sizes) and all(n == sizes[s] for (s, _), n in totals.items())
    y, x = F.col("lpa_nmol_max"), F.col("lpa_pred_nm")
    sums = r.sums({"n": F.lit(1.0), "sy": y, "sxy": x * y}).toPandas().set_index(["GIA", "replicate"]).sort_index()
    w["sy"], w["sxy"] = w["weight"] * w["lpa_nmol_max"], w["weight"] * w["lpa_nmol_max"] * w["lpa_pred_nm"]
    want = w.groupby(["GIA", "replicate"])[["weight", "sy", "sxy"]].sum().sort_index()
    assert np.allclose(sums.to_numpy(), want.to_numpy())


def test_overfull_replicates_are_redrawn(cohort):
    """Enough replicates that some strata exceed their size; every total must still be exact."""
    r = resampler(cohort, b=1500)
    got = r.sums({"n": F.lit(1.0)}).groupBy("replicate").agg(F.sum("n").alias("n")).toPandas()
    assert len(got) == 1500 and (got["n"] == r.rows).all()


def test_weights_have_multinomial_moments(cohort):
    r = resampler(cohort.filter("GIA = 'A'"), b=400)
    w = r.weights().toPandas()
    copies = r.units.select("lpa_nmol_max", "lpa_pred_nm", "copies").toPandas()
    wide = w.pivot_table(index=["lpa_nmol_max", "lpa_pred_nm"], columns="replicate", values="weight", fill_value=0)
    wide = wide.reindex(pd.MultiIndex.from_frame(copies[["lpa_nmol_max", "lpa_pred_nm"]]), fill_value=0).to_numpy()
    single = copies["copies"].to_numpy() == 1
    n = r.rows
    assert wide[single].mean() == pytest.approx(1, abs=0.02)
    assert wide[single].var() == pytest.approx(1 - 1 / n, abs=0.03)
    heavy = wide[copies["copies"].to_numpy() == 40][0]
    assert heavy.mean() == pytest.approx(40, abs=1.2)
    assert heavy.var() == pytest.approx(40 * (1 - 40 / n), rel=0.3)
    # weights of different rows are slightly negatively correlated: the total is fixed
    assert (wide.sum(axis=0) == n).all()


def test_a_dominant_value_is_cut_into_runs(pairs, monkeypatch):
    monkeypatch.setattr(resample, "_COPIES_PER_CHUNK", 100)
    df = pairs([("A", 5, 6)] * 1000 + [("A", v, v + 1) for v in range(1000)])
    r = resampler(df, b=30)
    assert r._chunks().agg(F.max("copies")).first()[0] == 100
    got = r.weights().groupBy("replicate").agg(F.sum("weight").alias("w"), F.sum(F.when(F.col("lpa_nmol_max") == 5, F.col("weight"))).alias("h")).toPandas()
    assert (got["w"] == 2000).all() and got["h"].mean() == pytest.approx(1000, abs=25)


def test_numeric_boot_against_pandas(cohort):
    r = resampler(cohort)
    w = r.weights().toPandas()
    want = {}
    for name in ("A", "B", "C", "Overall"):
        values = []
        for _, part in w.groupby("replicate"):
            part = part if name == "Overall" else part[part["GIA"] == name]
            full = part.loc[part.index.repeat(part["weight"])]
            y, x = full["lpa_nmol_max"], full["lpa_pred_nm"]
            values.append((np.corrcoef(y, x)[0, 1] ** 2, (abs(y - x) / y).mean() * 100, np.sqrt(((y - x) ** 2).mean())))
        want[name] = np.array(values)
    got = {(g["GIA"], g["metric"]): g for g in resample.numeric_boot(cohort, 12, 3).collect()}
    for name, values in want.items():
        for i, metric in enumerate(("rsq", "mape", "rmse")):
            row, v = got[(name, metric)], values[:, i]
            assert row["estimate"] == pytest.approx(v.mean()) and row["sd"] == pytest.approx(v.std(ddof=1))
            assert row["lower_ci"] == pytest.approx(np.quantile(v, 0.025)) and row["upper_ci"] == pytest.approx(np.quantile(v, 0.975))


def test_undefined_numeric_cases(pairs):
    df = pairs([("const", v, 5) for v in range(1, 41)] + [("zero", 0, 1)] * 20 + [("zero", v, v + 1) for v in range(1, 21)])
    got = {(g["GIA"], g["metric"]): g for g in resample.numeric_boot(df, 10, 1).collect()}
    assert got[("const", "rsq")]["estimate"] is None and got[("const", "rmse")]["estimate"] is not None
    assert got[("zero", "mape")]["estimate"] == float("inf")


def test_bootstrap_ci_null_rule(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", 1.0), ("b", None), ("b", 3.0)], "k string, value double")
    got = {r["k"]: r for r in resample.bootstrap_ci(df, ["k"]).collect()}
    assert got["a"]["lower_ci"] == pytest.approx(1.05) and got["a"]["estimate"] == pytest.approx(7 / 3)
    assert got["b"]["estimate"] is None and got["b"]["sd"] is None and got["b"]["upper_ci"] == pytest.approx(2.95)


def test_class_draws_by_cell_and_by_row_agree(cohort):
    thresholds = [100.0, 150.0]
    def boot(by_cell):
        df = resample.class_boot(cohort, thresholds, 300, 3, by_cell=by_cell)
        return {(r["GIA"], r["threshold"], r["metric"]): r for r in df.collect()}
    cells, rows = boot(True), boot(False)
    assert set(cells) == set(rows)
    for key, row in cells.items():
        if key[0] != "C" and row["estimate"] is not None and rows[key]["estimate"] is not None:
            assert row["estimate"] == pytest.approx(rows[key]["estimate"], abs=0.02), key
            assert row["sd"] == pytest.approx(rows[key]["sd"], rel=0.3, abs=0.005), key


@pytest.mark.parametrize("draw", [resample.class_sums_by_cell, resample.class_sums_by_row])
def test_class_resamples_have_all_rows(cohort, draw):
    sums = draw(cohort, [100.0, 150.0], 60, 3)
    got = sums.groupBy("replicate").agg(F.sum(F.expr("tp + fp + tn + fn")).alias("n")).toPandas()
    assert len(got) == 60 and (got["n"] == 2 * cohort.count()).all()


def test_results_do_not_depend_on_partitioning(cohort):
    first = sorted(map(str, resample.numeric_boot(cohort, 6, 9).select("GIA", "metric", F.round("estimate", 9)).collect()))
    again = sorted(map(str, resample.numeric_boot(cohort.repartition(7), 6, 9).select("GIA", "metric", F.round("estimate", 9)).collect()))
    assert first == again


def test_poisson_counts_follow_their_rate():
    n = 10_000
    counts = draws.poisson_counts(12345, n, np.arange(n), np.arange(1, 101))
    rate = draws.thinned_rate(n)
    assert counts.mean() == pytest.approx(rate, abs=0.005)
    assert counts.var() == pytest.approx(rate, abs=0.01)
    assert abs(np.corrcoef(counts[0], counts[1])[0, 1]) < 0.04
    assert abs(np.corrcoef(counts[:, 0], counts[:, 1])[0, 1]) < 0.4
    assert draws.thinned_rate(4) == 0 and draws.poisson_counts(1, 4, np.arange(4), np.arange(1, 9)).sum() == 0


def test_strata_of_any_level_type(spark):
    import datetime

    for name, values in (("boolean", [True, False]), ("double", [1e10, 2.0]), ("int", [1, 2]), ("date", [datetime.date(2020, 1, 1), datetime.date(2021, 1, 1)])):
        df = spark.createDataFrame([(i, values[i % 2]) for i in range(200)], f"ID int, level {name}")
        got = resample.bootstrap_strata(df, "level").groupBy("level", "stratum").count().collect()
        assert sorted(x["count"] for x in got) == [100, 100] and len({x["stratum"] for x in got}) == 2


def test_level_named_like_a_missing_one(spark):
    df = spark.createDataFrame([(1, "NA"), (2, None), (3, "x")], "ID int, level string")
    assert len({x["stratum"] for x in resample.bootstrap_strata(df, "level", pool=0).collect()}) == 3


def test_cutoffs_use_the_whole_uniform():
    for n in (10, 1000, 10**12):
        cuts = draws.poisson_cutoffs(n)
        assert list(cuts) == sorted(cuts) and 2**53 - cuts[-1] <= 2 and len(cuts) <= 24


def test_quantiles_of_large_means():
    u = np.random.default_rng(3).integers(0, 2**53, 20000)
    for mean in (0.3, 7.5, 900.0, 1e7):
        got = draws.poisson_quantiles(mean, u)
        assert abs(got.mean() - mean) < 5 * np.sqrt(mean / len(u)) and abs(got.var() / mean - 1) < 0.1
    edges = np.array([0, 2**53 - 1])
    low, high = draws.poisson_quantiles(4.0, edges)
    assert low == 0 and 15 < high < 60
    assert (np.diff(draws.poisson_quantiles(50.0, np.sort(u))) >= 0).all()


@pytest.mark.parametrize("pool", [0.0, 0.1, 0.9])
def test_cells_counted_side_by_side_are_the_rows_counted(pairs, pool):
    rows = [(None if i % 7 == 0 else "ABCDE"[i * i % 5], None if i % 13 == 0 else i % 40, i * 3 % 41) for i in range(300)]
    args = (pairs(rows), [5.0, 17.5, 30.0])
    keys = ["stratum", "GIA", "threshold", "truth", "called"]
    plain = resample._class_rows(*args, pool, 4, "GIA", "lpa_nmol_max", "lpa_pred_nm", "ID").groupBy(*keys).count()
    cells = resample.class_cells(*args, 4, pool).select(*keys, "copies")
    assert sorted(map(repr, map(tuple, cells.collect()))) == sorted(map(repr, map(tuple, plain.collect())))
    plan = resample._cell_rows(*args, pool, 4, "GIA", "lpa_nmol_max", "lpa_pred_nm", "ID")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline") < plan.index("Aggregate")  # rows are counted below, multiplied above
