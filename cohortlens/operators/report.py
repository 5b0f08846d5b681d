"""Report tables: pivots of the metric table and the concluding row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.config import CLASS_METRICS, GROUP, NUMERIC_METRICS
from cohortlens.functions.scalars import METRIC_LABELS, ci_label, ratio, relabel, round_cols
from cohortlens.operators.agreement import grouped_only, overall_only
from cohortlens.operators.cohort import overall_first, take_n

STATS = ("estimate", "lower_ci", "upper_ci")


def _wide(metrics: DataFrame, by: Sequence[str], codes: Sequence[str], scale: float = 1.0) -> DataFrame:
    """One row per ``by`` with columns ``{estimate,lower_ci,upper_ci}_{metric}``; the metric list is fixed."""
    picked = [
        (F.max(F.when(F.col("metric") == m, F.col(s))) * scale).alias(f"{s}_{m}") for m in codes for s in STATS
    ]
    return metrics.groupBy(*by).agg(*picked)


def pivot_wider_numeric(metrics: DataFrame, group: str = GROUP) -> DataFrame:
    """One row per group: numeric metrics with their intervals, rounded to two digits."""
    numeric = metrics.filter(F.col("metric").isin(*NUMERIC_METRICS))
    return round_cols(_wide(numeric, [group], NUMERIC_METRICS), STATS, 2)


def pivot_wider_class(metrics: DataFrame, threshold: float = 150.0, group: str = GROUP) -> DataFrame:
    """One row per group at one threshold: classification metrics in percent with their intervals."""
    at = metrics.filter(F.col("threshold") == threshold)
    return _wide(at, [group], CLASS_METRICS, 100.0)


def threshold_table(metrics: DataFrame, thresholds: Sequence[float], group: str = GROUP) -> DataFrame:
    """One row per threshold: overall sens, spec, ppv and npv in percent with their intervals."""
    chosen = overall_only(metrics, group).filter(F.col("threshold").isin([float(t) for t in thresholds]))
    return _wide(chosen, ["threshold"], ("sens", "spec", "ppv", "npv"), 100.0)


def _cell(metric: str, digits: int, unit: str = "") -> Column:
    return ci_label(*[F.col(f"{s}_{metric}") for s in STATS], digits, unit)


def numeric_report(metrics: DataFrame, order: DataFrame, group: str = GROUP) -> DataFrame:
    """The numeric metrics table as text, Overall first."""
    wide = pivot_wider_numeric(metrics, group)
    shown = wide.select(
        group, _cell("rsq", 2).alias("R2"), _cell("rmse", 1).alias("RMSE"), _cell("mape", 1, "%").alias("MAPE")
    )
    return overall_first(shown, order, group=group)


def class_report(metrics: DataFrame, order: DataFrame, threshold: float = 150.0, group: str = GROUP) -> DataFrame:
    """The classification metrics table as text, Overall first."""
    wide = pivot_wider_class(metrics, threshold, group)
    shown = wide.select(group, *[_cell(m, 1, "%").alias(METRIC_LABELS[m]) for m in CLASS_METRICS])
    return overall_first(shown, order, group=group)


def threshold_report(metrics: DataFrame, thresholds: Sequence[float], group: str = GROUP) -> DataFrame:
    """The thresholds table as text."""
    wide = threshold_table(metrics, thresholds, group)
    named = F.concat(F.col("threshold").cast("decimal(18,0)").cast("string"), F.lit(" nmol/L"))
    return wide.orderBy("threshold").select(
        named.alias("Threshold"),
        *[_cell(m, 1, "%").alias(METRIC_LABELS[m]) for m in ("sens", "spec", "ppv", "npv")],
    )


def labelled_metrics(metrics: DataFrame) -> DataFrame:
    """Metric rows with their display label."""
    return metrics.withColumn("performance", relabel(F.col("metric"), METRIC_LABELS))


def best_group(metrics: DataFrame, group: str = GROUP) -> DataFrame:
    """The group with the highest R2, ties by name."""
    rsq = grouped_only(metrics, group).filter((F.col("metric") == "rsq") & F.col("estimate").isNotNull())
    return take_n(rsq.select(group, "estimate"), 1, F.desc("estimate"), F.asc(group))


def conclusions(metrics: DataFrame, threshold: float = 150.0, rsq_cut: float = 0.5, group: str = GROUP) -> DataFrame:
    """One row: strength of the prediction, best group, and sens, spec and number needed to test at one threshold."""
    overall = overall_only(metrics, group)

    def value(name: str, at_threshold: bool = True) -> Column:
        chosen = F.col("metric") == name
        if at_threshold:
            chosen = chosen & (F.col("threshold") == threshold)
        return F.max(F.when(chosen, F.col("estimate")))

    numbers = overall.agg(
        value("rsq", False).alias("rsq"), value("sens").alias("sens"), value("spec").alias("spec"), value("ppv").alias("ppv")
    )
    best = best_group(metrics, group)
    return numbers.select(
        F.when(F.col("rsq") > rsq_cut, F.lit("strong")).otherwise(F.lit("moderate")).alias("performance"),
        F.bround("rsq", 2).alias("rsq"),
        best.select(group).scalar().alias("best_group"),
        F.bround(best.select("estimate").scalar(), 2).alias("best_rsq"),
        F.bround(F.col("sens") * 100, 1).alias("sens_pct"),
        F.bround(F.col("spec") * 100, 1).alias("spec_pct"),
        F.bround(ratio(F.lit(1.0), F.col("ppv")), 1).alias("nnt"),
    )

