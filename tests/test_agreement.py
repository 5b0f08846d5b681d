import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import agreement, resample


def table(df, *key):
    return {tuple(r[k] for k in key): r for r in df.collect()}


def test_numeric_metrics_against_numpy(pairs):
    rng = np.random.default_rng(1)
    data = [("A" if i % 3 else "B", y, y * 0.8 + e) for i, (y, e) in enumerate(zip(rng.uniform(1, 9, 200), rng.normal(0, 1, 200)))]
    got = table(agreement.metrics_numeric(pairs(data)), "GIA")
    for name in ("A", "B", "Overall"):
        y, x = np.array([(r[1], r[2]) for r in data if name in (r[0], "Overall")]).T
        row = got[(name,)]
        assert row["rsq"] == pytest.approx(np.corrcoef(y, x)[0, 1] ** 2)
        assert row["rmse"] == pytest.approx(np.sqrt(np.mean((y - x) ** 2)))
        assert row["mape"] == pytest.approx(np.mean(np.abs((y - x) / y)) * 100)


def test_numeric_edge_rules(pairs):
    got = table(agreement.metrics_numeric(pairs([("const", 1, 5), ("const", 2, 5), ("zero", 0, 1), ("zero", 2, 3), ("und", 0, 0), ("und", 1, 2)])), "GIA")
    assert got[("const",)]["rsq"] is None
    assert got[("zero",)]["mape"] == math.inf
    assert got[("und",)]["mape"] is None


def test_class_metrics_edges(spark):
    cells = spark.createDataFrame(
        [("full", 150.0, 8, 2, 85, 5), ("nocall", 150.0, 0, 0, 9, 1), ("nopos", 150.0, 0, 3, 7, 0), ("noneg", 150.0, 4, 0, 0, 6)],
        "GIA string, threshold double, tp bigint, fp bigint, tn bigint, fn bigint",
    )
    got = table(agreement.metrics_class(cells), "GIA")
    full = got[("full",)]
    assert (full["sens"], full["ppv"], full["accuracy"]) == (8 / 13, 0.8, 0.93)
    assert full["spec"] == 85 / 87 and full["npv"] == 85 / 90 and full["f_meas"] == 16 / 23
    assert got[("nocall",)]["ppv"] is None and got[("nocall",)]["f_meas"] is None and got[("nocall",)]["npv"] == 0.9
    assert got[("nopos",)]["sens"] is None and got[("nopos",)]["ppv"] is None and got[("nopos",)]["npv"] is None
    assert got[("noneg",)]["spec"] is None and got[("noneg",)]["ppv"] is None and got[("noneg",)]["sens"] == 0.4


def test_confusion_cells_add_up(pairs):
    df = pairs([("A", v, 300 - v) for v in range(100, 220, 5)] + [(None, v, v) for v in range(100, 220, 7)])
    counts = agreement.with_overall(agreement.confusion_counts(df, [125.0, 150.0]))
    got = table(counts.withColumn("n", F.expr("tp + fp + tn + fn")), "GIA", "threshold")
    assert got[("A", 150.0)]["n"] == 24 and got[(None, 150.0)]["n"] == 18 and got[("Overall", 125.0)]["n"] == 42
    assert len(got) == 6


def test_point_metrics_have_the_resampled_schema(pairs):
    df = pairs([("A", v, v + v % 7) for v in range(100, 220, 3)])
    both = agreement.union_metrics(agreement.point_metrics_numeric(df), agreement.point_metrics_class(df, [150.0]))
    boot = agreement.union_metrics(resample.numeric_boot(df, 5, 1), resample.class_boot(df, [150.0], 5, 1))
    assert set(both.columns) == set(boot.columns)
    assert both.filter("sd is not null or lower_ci is not null").count() == 0
    assert both.filter("metric_type = 'Numeric' and threshold is not null").count() == 0
    assert agreement.overall_only(both).count() + agreement.grouped_only(both).count() == both.count() == 18
