"""What the prediction would change: prevalence, number needed to test, detection rates and their significance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlens.config import ESTIMATE, GROUP, OVERALL, TRUTH
from cohortlens.functions.scalars import nan_to_null, p_value_band, pct_label, prefer_adjusted, ratio, ratio_label
from cohortlens.operators.cohort import overall_first
from cohortlens.operators.joins import null_safe_join, settled

# Notes of the comparison table.
ADJUSTED_NOTE = "PPV adjusted"
UNADJUSTED_NOTE = "Unadjusted (no PPV available)"


# ---- prevalence ------------------------------------------------------------------------------------------------


def _prevalence_counts(df: DataFrame, thresholds: Sequence[float], by: list[str], truth: str, estimate: str) -> DataFrame:
    """Counts for all thresholds side by side in one aggregation, then one row per threshold."""
    y, x = nan_to_null(F.col(truth)), nan_to_null(F.col(estimate))

    def at(t: float) -> Column:
        return F.struct(
            F.lit(float(t)).alias("threshold"),
            F.count_if(y > t).alias("measured_elevated_count"),
            F.count_if(x > t).alias("predicted_elevated_count"),
        )

    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count(y).alias("measured_available_count"),
        F.count(x).alias("predicted_available_count"),
        F.array(*[at(t) for t in thresholds]).alias("per_threshold"),
    )
    return _with_shares(counts.select(*by, *_AVAILABLE, F.inline("per_threshold")))


_AVAILABLE = ("total_count", "measured_available_count", "predicted_available_count")
_ELEVATED = ("measured_elevated_count", "predicted_elevated_count")


def _with_shares(long: DataFrame) -> DataFrame:
    return long.withColumns(
        {
            f"{kind}_elevated_pct": F.when(
                F.col("total_count") > 0, F.col(f"{kind}_elevated_count") / F.col("total_count") * 100
            )
            for kind in ("measured", "predicted")
        }
    )


def prevalence_overall(df: DataFrame, thresholds: Sequence[float], truth: str = TRUTH, estimate: str = ESTIMATE) -> DataFrame:
    """Measured and predicted prevalence per threshold, relative to everyone with a prediction."""
    return _prevalence_counts(df, thresholds, [], truth, estimate).withColumn(GROUP, F.lit(OVERALL))


def prevalence_by_group(df: DataFrame, thresholds: Sequence[float], group: str = GROUP, truth: str = TRUTH,
                        estimate: str = ESTIMATE) -> DataFrame:
    """The same per known group."""
    return _prevalence_counts(df.filter(F.col(group).isNotNull()), thresholds, [group], truth, estimate)


def join_ppv_overall(df: DataFrame, ppv: DataFrame) -> DataFrame:
    """Attach the single ppv value of a one-row table to every row; missing if that table is empty."""
    return df.withColumn("ppv", ppv.select("ppv").scalar())


def join_ppv_group(df: DataFrame, ppv: DataFrame, on: Sequence[str] = (GROUP,)) -> DataFrame:
    """Attach ppv by group, null-safely; groups without one keep a missing value."""
    return null_safe_join(df, ppv.select(*on, "ppv"), list(on))


def with_ppv_adjustment(df: DataFrame) -> DataFrame:
    """Predicted counts scaled by ppv where there is one."""
    n, total, ppv = F.col("predicted_elevated_count"), F.col("total_count"), F.col("ppv")
    return df.withColumns(
        {
            "predicted_elevated_unadjusted": n,
            "predicted_elevated_unadjusted_pct": F.when(total > 0, n / total * 100),
            "predicted_elevated_adjusted": n * ppv,
            "predicted_elevated_adjusted_pct": F.when(total > 0, n * ppv / total * 100),
            "has_ppv_adjustment": ppv.isNotNull(),
        }
    )


def union_prevalence(overall: DataFrame, by_group: DataFrame) -> DataFrame:
    """Overall rows above the group rows."""
    return overall.unionByName(by_group.select(*overall.columns))


def prevalence_table(df: DataFrame, class_metrics: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Prevalence overall and per group at all thresholds, with the ppv adjustment.

    ``class_metrics`` is the long metric table; its ppv rows carry their group and threshold, Overall included.
    """
    ppv = class_metrics.filter(F.col("metric") == "ppv").select(GROUP, "threshold", F.col("estimate").alias("ppv"))
    # One pass over the cohort: groups are counted, rows without one among them, and added up to the overall rows. They
    # are settled first, since the optimizer would otherwise push the filter below into a second scan.
    groups, _ = settled(
        _prevalence_counts(df, thresholds, [GROUP], TRUTH, ESTIMATE).drop("measured_elevated_pct", "predicted_elevated_pct")
    )
    grid = df.sparkSession.createDataFrame([(float(t),) for t in thresholds], "threshold double")
    added = groups.groupBy("threshold").agg(*[F.sum(c).alias(c) for c in (*_AVAILABLE, *_ELEVATED)])
    overall = grid.join(added, "threshold", "left").fillna(0).withColumn(GROUP, F.lit(OVERALL))
    counts = _with_shares(overall.unionByName(groups.filter(F.col(GROUP).isNotNull())))
    return with_ppv_adjustment(join_ppv_group(counts, ppv, [GROUP, "threshold"]))


# ---- number needed to test -------------------------------------------------------------------------------------


def nnt(metrics: DataFrame, threshold: float = 150.0) -> DataFrame:
    """Number needed to test: reciprocal of ppv at one threshold; the interval bounds change places."""
    one = F.lit(1.0)
    at = metrics.filter((F.col("threshold") == threshold) & (F.col("metric") == "ppv"))
    return at.select(
        GROUP,
        F.lit("nnt").alias("metric"),
        ratio(one, F.col("estimate")).alias("estimate"),
        ratio(one, F.col("upper_ci")).alias("lower_ci"),
        ratio(one, F.col("lower_ci")).alias("upper_ci"),
        F.lit("Classification").alias("metric_type"),
    )


# ---- detection rates and significance --------------------------------------------------------------------------


def detection_rates(prevalence: DataFrame) -> DataFrame:
    """Detections per 1000 by measurement and by prediction, and their ratios."""
    total = F.col("total_count")

    def per_1000(c: str) -> Column:
        return F.when(total > 0, F.col(c) / total * 1000)

    rates = prevalence.withColumns(
        {
            "clinical_rate_per_1000": per_1000("measured_elevated_count"),
            "genetic_rate_unadjusted_per_1000": per_1000("predicted_elevated_unadjusted"),
            "genetic_rate_per_1000": per_1000("predicted_elevated_adjusted"),
        }
    )
    clinical = F.col("clinical_rate_per_1000")
    return rates.withColumns(
        {
            "improvement_factor_unadjusted": ratio(F.col("genetic_rate_unadjusted_per_1000"), clinical),
            "improvement_factor": ratio(F.col("genetic_rate_per_1000"), clinical),
        }
    )


def fisher_exact(df: DataFrame, keys: Sequence[str], a: str, n1: str, c: str, n2: str) -> DataFrame:
    """Two-sided exact p of the table [[a, n1-a], [c, n2-c]] per key; adds ``p_value``.

    With the margins fixed, the probability of each possible upper-left count follows from its neighbour by a ratio,
    so log probabilities are running sums of log ratios. Counts further from the mean than Bernstein's inequality
    allows for a probability above the smallest positive double are left out, which bounds the work per table by
    about the square root of its total. Tables with a missing count, or margins of zero, get no p value here.
    """
    keys = list(keys)

    def count(name: str, out: str) -> Column:
        return F.col(name).cast("bigint").alias(out)

    tables = df.select(*keys, count(a, "__a"), count(n1, "__n1"), count(c, "__c"), count(n2, "__n2")).filter(
        "__a is not null and __c is not null and __n1 is not null and __n2 is not null and __n1 + __n2 > 0"
    )
    seen, first, second = F.col("__a"), F.col("__n1"), F.col("__n2")
    column = F.col("__a") + F.col("__c")
    mean = column * first / (first + second)
    # log of the smallest positive double is about -745: deviations beyond this reach contribute exactly zero.
    reach = F.lit(500.0) + 39 * F.sqrt(mean)
    least = F.greatest(F.lit(0).cast("bigint"), column - second, F.floor(mean - reach))
    most = F.least(column, first, F.ceil(mean + reach))
    # A stated number of partitions keeps the tables apart although they are one small row each before the explode.
    tasks = df.sparkSession.sparkContext.defaultParallelism
    support = (
        tables.withColumns({"__least": least, "__most": most})
        .repartition(tasks, *keys)
        .withColumn("__v", F.explode(F.sequence("__least", "__most")))
    )
    v = F.col("__v")
    up = (column - v + 1).cast("double") * (first - v + 1)
    down = v.cast("double") * (second - column + v)
    running = Window.partitionBy(*keys).orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.when(v > F.col("__least"), F.log(up / down)).otherwise(F.lit(0.0))
    logs = support.select(*keys, "__v", "__a", F.sum(step).over(running).alias("__log"))
    summary = logs.groupBy(*keys).agg(
        F.max("__log").alias("__top"), F.max(F.when(v == seen, F.col("__log"))).alias("__seen")
    )
    weight = F.exp(F.col("__log") - F.col("__top"))
    as_extreme = weight <= F.exp(F.col("__seen") - F.col("__top")) * (1 + 1e-7)
    share = F.coalesce(F.sum(F.when(as_extreme, weight)), F.lit(0.0)) / F.sum(weight)
    p = null_safe_join(logs, summary, keys, "inner").groupBy(*keys).agg(F.least(F.lit(1.0), share).alias("p_value"))
    return null_safe_join(df, p, keys)


def detection_improvement(prevalence: DataFrame) -> DataFrame:
    """Detection rates with the exact test of predicted against measured counts, and which count was used.

    The adjusted count is used where a ppv exists, rounded half to even; no test if either count is zero or missing.
    """
    rates = detection_rates(prevalence)
    used = F.when(F.col("has_ppv_adjustment"), F.col("predicted_elevated_adjusted")).otherwise(
        F.col("predicted_elevated_unadjusted").cast("double")
    )
    testable = (used > 0) & (F.col("measured_elevated_count") > 0)
    prepared = rates.withColumns(
        {
            "__predicted": F.when(testable, F.bround(used, 0)).cast("bigint"),
            "__measured": F.when(testable, F.col("measured_elevated_count")),
        }
    )
    tested = fisher_exact(prepared, [GROUP, "threshold"], "__predicted", "total_count", "__measured", "total_count")
    note = F.when(F.col("has_ppv_adjustment"), F.lit(ADJUSTED_NOTE)).otherwise(F.lit(UNADJUSTED_NOTE))
    return tested.drop("__predicted", "__measured").withColumn("rate_note", note)


def detection_comparison(improvement: DataFrame, order: DataFrame, threshold: float = 150.0) -> DataFrame:
    """The comparison table at one threshold, Overall first; numbers with their report texts beside them."""
    at = improvement.filter(F.col("threshold") == threshold).select(
        GROUP,
        "total_count",
        F.col("measured_elevated_count").alias("clinical_count"),
        F.col("measured_elevated_pct").alias("clinical_pct"),
        prefer_adjusted(
            F.col("predicted_elevated_adjusted"), F.col("predicted_elevated_unadjusted").cast("double")
        ).alias("genetic_count"),
        prefer_adjusted(
            F.col("predicted_elevated_adjusted_pct"), F.col("predicted_elevated_unadjusted_pct")
        ).alias("genetic_pct"),
        prefer_adjusted(F.col("improvement_factor"), F.col("improvement_factor_unadjusted")).alias("improvement"),
        "p_value",
        "rate_note",
    )
    shown = at.withColumns(
        {
            "clinical_pct_text": pct_label(F.col("clinical_pct")),
            "genetic_pct_text": pct_label(F.col("genetic_pct")),
            "improvement_text": ratio_label(F.col("improvement")),
            "p_value_text": p_value_band(F.col("p_value")),
        }
    )
    return overall_first(shown, order)
