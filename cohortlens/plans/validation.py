"""The whole validation: two input tables to all result tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from cohortlens.config import GROUP, ID, PART_ESTIMATE, PART_UNCERTAINTY, TRUTH, ValidationConfig
from cohortlens.operators import agreement, cohort, impact, plotdata, report, resample, summary
from cohortlens.operators.joins import settled
from cohortlens.sources.scratch import written
from cohortlens.sources.tables import write_results


@dataclass(frozen=True)
class Cohort:
    """The two tables everything else reads, each written once."""

    joined: DataFrame
    valid: DataFrame


def build_cohort(parts: DataFrame, measured: DataFrame, config: ValidationConfig = ValidationConfig()) -> Cohort:
    """Predictions per person joined with the measurements, and the usable part of it."""
    cohort.require_columns(parts, [ID, PART_ESTIMATE, PART_UNCERTAINTY])
    cohort.require_columns(measured, [ID, TRUTH, GROUP])
    pred = cohort.pred_summary(parts, z=config.z)
    joined = written(cohort.join_pred_measured(pred, measured), "joined")
    valid = written(cohort.validation_cohort(joined, config.min_group), "valid")
    cohort.require_domain(valid)
    return Cohort(joined, valid)


def all_metrics(valid: DataFrame, config: ValidationConfig = ValidationConfig()) -> DataFrame:
    """Numeric and classification metrics per group and overall, bootstrapped unless switched off."""
    if config.do_bootstrap:
        numeric = resample.numeric_boot(valid, config.resamples, config.seed, config.pool, config.ci)
        classes = resample.class_boot(valid, config.thresholds, config.resamples, config.seed, config.pool, config.ci)
    else:
        numeric = agreement.point_metrics_numeric(valid)
        classes = agreement.point_metrics_class(valid, config.thresholds)
    return agreement.union_metrics(numeric, classes)


def validate(parts: DataFrame, measured: DataFrame, config: ValidationConfig = ValidationConfig()) -> dict[str, DataFrame]:
    """All result tables by name; the metric table is written once because most others read it."""
    tables = build_cohort(parts, measured, config)
    joined, valid = tables.joined, tables.valid
    at = config.primary_threshold
    metrics = written(all_metrics(valid, config), "metrics")
    order, _ = settled(cohort.group_order(valid))
    sizes, _ = settled(cohort.group_sizes(valid))
    prevalence, _ = settled(impact.prevalence_table(joined, metrics, config.thresholds))
    improvement, _ = settled(impact.detection_improvement(prevalence))
    nnt = impact.nnt(metrics, at)
    lines, _ = settled(plotdata.fit_line(valid))
    tidy, _ = settled(summary.demographics(valid, GROUP))
    names = [r[GROUP] for r in order.orderBy("ord").select(GROUP).collect() if r[GROUP] is not None]
    return {
        "demographics_overall": summary.demographics(valid),
        "demographics_by_ancestry": summary.wide_by_group(tidy, names),
        "demographics_by_ancestry_tidy": tidy,
        "ancestry_order": order,
        "numeric_metrics_by_group": agreement.grouped_only(metrics.filter("metric_type = 'Numeric'")),
        "numeric_metrics_overall": agreement.overall_only(metrics.filter("metric_type = 'Numeric'")),
        "class_metrics_by_group": agreement.grouped_only(metrics.filter("metric_type = 'Classification'")),
        "class_metrics_overall": agreement.overall_only(metrics.filter("metric_type = 'Classification'")),
        "all_metrics": metrics,
        "group_sizes": sizes,
        "nnt_metrics": nnt,
        "prevalence_by_threshold": prevalence,
        "detection_improvement": improvement,
        "detection_comparison": impact.detection_comparison(improvement, order, at),
        "headline": cohort.headline(parts, measured, valid, metrics),
        "numeric_report": report.numeric_report(metrics, order),
        "class_report": report.class_report(metrics, order, at),
        "threshold_report": report.threshold_report(metrics, config.thresholds),
        "conclusions": report.conclusions(metrics, at, config.rsq_cut),
        "scatter_points": plotdata.scatter_points(valid),
        "fit_line": lines,
        "fit_band": plotdata.fit_band(lines),
        "density": plotdata.density(valid),
        "box_stats": plotdata.box_stats(valid),
        "violin_density": plotdata.violin_density(valid),
        "performance_points": plotdata.performance_points(metrics, sizes, order, at),
        "nnt_points": plotdata.nnt_points(nnt, sizes, order),
    }


# The result files of a run, each named like its table here or as said.
RESULT_FILES = {
    **{name: name for name in (
        "demographics_overall", "demographics_by_ancestry", "demographics_by_ancestry_tidy", "numeric_metrics_by_group",
        "numeric_metrics_overall", "class_metrics_by_group", "class_metrics_overall", "all_metrics", "nnt_metrics",
    )},
    "prevalence_by_threshold": "lpa_prevalence_by_threshold",
    "detection_comparison": "lpa_detection_comparison_150",
}


def write_run(tables: dict[str, DataFrame], folder: str, fmt: str = "csv") -> Sequence[str]:
    """Write the tables of ``validate`` that a run reports, one folder each; returns the paths."""
    return write_results({file: tables[name] for name, file in RESULT_FILES.items()}, folder, fmt)
