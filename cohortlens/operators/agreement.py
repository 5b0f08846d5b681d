"""Agreement of predictions with measurements on the full sample: numeric and classification metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.config import CLASS_METRICS, ESTIMATE, GROUP, NUMERIC_METRICS, OVERALL, TRUTH
from cohortlens.functions.metrics import confusion_metrics, numeric_metrics
from cohortlens.functions.scalars import exceeds, overall_or, strata_key


def metrics_numeric(df: DataFrame, group: str = GROUP, truth: str = TRUTH, estimate: str = ESTIMATE) -> DataFrame:
    """rsq, mape and rmse per group and overall, one row each."""
    aggregates = numeric_metrics(F.col(truth), F.col(estimate))
    return (
        df.select(group, truth, estimate)
        .groupingSets([[group], []], group)
        .agg(overall_or(group).alias("__name"), *[c.alias(m) for m, c in aggregates.items()])
        .select(F.col("__name").alias(group), *NUMERIC_METRICS)
    )


def cross_thresholds(df: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Each row once per threshold."""
    return df.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))


def classified(
    df: DataFrame, thresholds: Sequence[float], group: str = GROUP, truth: str = TRUTH, estimate: str = ESTIMATE
) -> DataFrame:
    """Rows by threshold with their true and predicted class and the resampling stratum."""
    crossed = cross_thresholds(df, thresholds)
    t = F.col("threshold")
    flags = crossed.withColumns(
        {"true_class": exceeds(F.col(truth), t), "pred_class": exceeds(F.col(estimate), t)}
    )
    return flags.withColumn("strata", strata_key(F.col(group), F.col("true_class"), t))


def confusion_counts(
    df: DataFrame, thresholds: Sequence[float], group: str = GROUP, truth: str = TRUTH, estimate: str = ESTIMATE
) -> DataFrame:
    """tp, fp, tn, fn per group and threshold.

    All thresholds are counted side by side in one aggregation, so the rows are not multiplied by the thresholds;
    only the aggregated table is turned to long form.
    """
    y, x = F.col(truth), F.col(estimate)

    def cells(t: float) -> Column:
        up, called = y > t, x > t
        return F.struct(
            F.lit(float(t)).alias("threshold"),
            F.count_if(up & called).alias("tp"),
            F.count_if(~up & called).alias("fp"),
            F.count_if(~up & ~called).alias("tn"),
            F.count_if(up & ~called).alias("fn"),
        )

    wide = df.groupBy(group).agg(F.array(*[cells(t) for t in thresholds]).alias("cells"))
    return wide.select(group, F.inline("cells"))


def with_overall(counts: DataFrame, group: str = GROUP) -> DataFrame:
    """Counts per group and threshold plus their totals per threshold (row ``Overall``)."""
    sums = [F.sum(c).alias(c) for c in ("tp", "fp", "tn", "fn")]
    return (
        counts.groupingSets([[group, "threshold"], ["threshold"]], group, "threshold")
        .agg(overall_or(group).alias("__name"), *sums)
        .drop(group)
        .withColumnRenamed("__name", group)
    )


def metrics_class(counts: DataFrame, group: str = GROUP) -> DataFrame:
    """Classification metrics, one row per group and threshold, from confusion counts."""
    formulas = confusion_metrics(*[F.col(c) for c in ("tp", "fp", "tn", "fn")])
    return counts.select(group, "threshold", *[c.alias(m) for m, c in formulas.items()])


def metrics_class_by_threshold_grouping(df: DataFrame, thresholds: Sequence[float], group: str = GROUP) -> DataFrame:
    """Classification metrics per group and overall from a single scan."""
    return metrics_class(with_overall(confusion_counts(df, thresholds, group), group), group)


def pivot_longer(df: DataFrame, ids: Sequence[str], values: Sequence[str], names_to: str, values_to: str) -> DataFrame:
    """Wide to long; the value columns are cast to double first."""
    wide = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
    return wide.unpivot(list(ids), list(values), names_to, values_to)


def _as_points(long: DataFrame) -> DataFrame:
    null = F.lit(None).cast("double")
    return long.withColumns({"sd": null, "lower_ci": null, "upper_ci": null})


def point_metrics_numeric(df: DataFrame, group: str = GROUP) -> DataFrame:
    """Numeric metrics in the schema of the resampled ones, without sd and interval."""
    return _as_points(pivot_longer(metrics_numeric(df, group), [group], NUMERIC_METRICS, "metric", "estimate"))


def point_metrics_class(df: DataFrame, thresholds: Sequence[float], group: str = GROUP) -> DataFrame:
    """Classification metrics in the schema of the resampled ones, without sd and interval."""
    wide = metrics_class_by_threshold_grouping(df, thresholds, group)
    return _as_points(pivot_longer(wide, [group, "threshold"], CLASS_METRICS, "metric", "estimate"))


def union_metrics(numeric: DataFrame, classification: DataFrame) -> DataFrame:
    """All metrics in one long table; numeric rows have no threshold."""
    return numeric.withColumn("metric_type", F.lit("Numeric")).unionByName(
        classification.withColumn("metric_type", F.lit("Classification")), allowMissingColumns=True
    )


def overall_only(metrics: DataFrame, group: str = GROUP) -> DataFrame:
    """The overall rows of a metric table."""
    return metrics.filter(F.col(group) == OVERALL)


def grouped_only(metrics: DataFrame, group: str = GROUP) -> DataFrame:
    """The per-group rows of a metric table; a NULL group is a group."""
    return metrics.filter(~F.coalesce(F.col(group) == OVERALL, F.lit(False)))
