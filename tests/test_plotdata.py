import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import cohort, plotdata


@pytest.fixture
def valid(pairs):
    rng = np.random.default_rng(3)
    rows = [(g, float(y), float(y * 0.7 + rng.normal(0, 15))) for g, n in (("A", 120), ("B", 60)) for y in rng.lognormal(4, 0.6, n)]
    return cohort.validation_cohort(pairs(rows)), rows


def arrays(rows, group):
    return np.array([(y, x) for g, y, x in rows if group in (g, "Overall")]).T


def test_fit_line_and_band(valid):
    df, rows = valid
    lines = {r["GIA"]: r for r in plotdata.fit_line(df).collect()}
    band = plotdata.fit_band(plotdata.fit_line(df)).toPandas()
    for g in ("A", "B", "Overall"):
        y, x = arrays(rows, g)
        slope, intercept = np.polyfit(x, y, 1)
        assert lines[g]["slope"] == pytest.approx(slope) and lines[g]["intercept"] == pytest.approx(intercept)
        s = np.sqrt(((y - intercept - slope * x) ** 2).sum() / (len(x) - 2))
        part = band[band["GIA"] == g].sort_values("i")
        assert len(part) == 80 and part["x"].iloc[0] == x.min() and part["x"].iloc[-1] == pytest.approx(x.max())
        se = s * np.sqrt(1 / len(x) + (part["x"] - x.mean()) ** 2 / ((x - x.mean()) ** 2).sum())
        assert np.allclose(part["se"], se)


def test_fit_line_of_constant_predictions(pairs):
    row = plotdata.fit_line(pairs([("A", 1, 5), ("A", 2, 5), ("A", 4, 5)])).filter("GIA = 'A'").first()
    assert row["slope"] is None and row["residual_se"] is None and row["n"] == 3


def direct(values, grid, adjust):
    q1, q3 = np.quantile(values, [0.25, 0.75])
    bw = 0.9 * min(values.std(ddof=1), (q3 - q1) / 1.34) * len(values) ** -0.2 * adjust
    return bw, np.exp(-0.5 * ((grid[:, None] - values[None, :]) / bw) ** 2).sum(axis=1) / (len(values) * bw * np.sqrt(2 * np.pi))


def test_density_against_the_direct_sum(valid):
    df, rows = valid
    got = plotdata.density(df).toPandas()
    assert len(got) == 3 * 2 * 512 and got["x"].nunique() == 512
    for g in ("A", "B", "Overall"):
        y, x = arrays(rows, g)
        for kind, v in (("Measured", y), ("Predicted", x)):
            part = got[(got["panel"] == g) & (got["measurement"] == kind)].sort_values("i")
            bw, want = direct(v, part["x"].to_numpy(), 2.0)
            assert part["bandwidth"].iloc[0] == pytest.approx(bw)
            assert np.allclose(part["density"], want, atol=want.max() * 2e-3)
            assert np.trapezoid(part["density"], part["x"]) == pytest.approx(1, abs=0.12)


def test_violin_uses_the_own_range(valid):
    df, rows = valid
    got = plotdata.violin_density(df).toPandas()
    for g in ("A", "B"):
        v = np.log10(arrays(rows, g)[0])
        part = got[got["GIA"] == g].sort_values("i")
        assert part["x"].iloc[0] == pytest.approx(v.min()) and part["x"].iloc[-1] == pytest.approx(v.max())
        assert np.allclose(part["density"], direct(v, part["x"].to_numpy(), 1.0)[1], atol=part["density"].max() * 2e-3)


def test_box_stats(pairs):
    values = [10.0**v for v in (0, 1, 1.1, 1.2, 1.3, 1.4, 1.5, 4)] + [0, -3]
    row = plotdata.box_stats(pairs([("A", v, 1) for v in values])).first()
    logs = np.array([0, 1, 1.1, 1.2, 1.3, 1.4, 1.5, 4])
    assert row["n"] == 8 and row["n_outliers"] == 2
    assert row["median"] == pytest.approx(np.median(logs)) and row["q1"] == pytest.approx(np.quantile(logs, 0.25))
    assert row["whisker_low"] == pytest.approx(1) and row["whisker_high"] == pytest.approx(1.5)


def test_points(valid, spark):
    df, _ = valid
    assert {r["label"] for r in plotdata.scatter_points(df).select("label").distinct().collect()} == {"A (n = 120)", "B (n = 60)"}
    metrics = spark.createDataFrame(
        [("A", "rsq", 0.5, None, "Numeric"), ("Overall", "ppv", 0.5, 150.0, "Classification"), ("A", "ppv", 0.5, 125.0, "Classification")],
        "GIA string, metric string, estimate double, threshold double, metric_type string",
    )
    got = plotdata.performance_points(metrics, cohort.group_sizes(df), cohort.group_order(df)).orderBy("ord").collect()
    assert [(r["GIA"], r["pop_size"], r["ord"]) for r in got] == [("Overall", 180, 0), ("A", 120, 1)]
    nnt = spark.createDataFrame([("B", "nnt", 2.0)], "GIA string, metric string, estimate double")
    assert plotdata.nnt_points(nnt, cohort.group_sizes(df), cohort.group_order(df)).first()["pop_size"] == 60
    assert df.filter(F.col("n") <= 20).count() == 0
