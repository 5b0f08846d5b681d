"""The statistics behind the usual figures, as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.config import ESTIMATE, GROUP, OVERALL, TRUTH
from cohortlens.functions.scalars import group_label, measurement_type, overall_or
from cohortlens.operators.cohort import order_join
from cohortlens.operators.joins import attach, null_safe_join, settled
from cohortlens.operators.quantiles import exact_quantiles

# Grid sizes, bandwidth constants and whisker length of the usual plotting defaults.
FIT_POINTS = 80
DENSITY_POINTS = 512
BANDWIDTH_FACTOR = 0.9
IQR_TO_SD = 1.34
WHISKER = 1.5


def scatter_points(valid: DataFrame, group: str = GROUP, truth: str = TRUTH, estimate: str = ESTIMATE) -> DataFrame:
    """Rows behind the scatter plot with their panel label (``valid`` carries the group size ``n``)."""
    return valid.select(
        group, group_label(F.col(group), F.col("n")).alias("label"), F.col(estimate).alias("predicted"),
        F.col(truth).alias("measured"),
    )


def fit_line(df: DataFrame, group: str = GROUP, truth: str = TRUTH, estimate: str = ESTIMATE) -> DataFrame:
    """Least-squares line of measured on predicted, per group and overall."""
    y, x = F.col(truth), F.col(estimate)
    fits = df.groupingSets([[group], []], group).agg(
        overall_or(group).alias("__name"),
        F.regr_count(y, x).alias("n"),
        F.regr_sxx(y, x).alias("sxx"),
        F.regr_syy(y, x).alias("syy"),
        F.regr_sxy(y, x).alias("sxy"),
        F.avg(x).alias("mean_x"),
        F.avg(y).alias("mean_y"),
        F.min(x).alias("min_x"),
        F.max(x).alias("max_x"),
    )
    slope = F.when(F.col("sxx") > 0, F.col("sxy") / F.col("sxx"))
    sse = F.greatest(F.col("syy") - slope * F.col("sxy"), F.lit(0.0))
    return fits.select(
        F.col("__name").alias(group), "n", slope.alias("slope"),
        (F.col("mean_y") - slope * F.col("mean_x")).alias("intercept"),
        F.when((F.col("n") > 2) & (F.col("sxx") > 0), F.sqrt(sse / (F.col("n") - 2))).alias("residual_se"),
        "sxx", "mean_x", "min_x", "max_x",
    )


def fit_band(lines: DataFrame, group: str = GROUP, points: int = FIT_POINTS) -> DataFrame:
    """Fitted value and its standard error on an even grid over each line's range."""
    grid = lines.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("min_x") + F.col("i") * (F.col("max_x") - F.col("min_x")) / (points - 1)
    placed = grid.withColumn("x", x)
    off = F.col("x") - F.col("mean_x")
    return placed.select(
        group,
        F.col("i").cast("bigint").alias("i"),
        "x",
        (F.col("intercept") + F.col("slope") * F.col("x")).alias("fitted"),
        F.when(
            F.col("sxx") > 0, F.col("residual_se") * F.sqrt(1 / F.col("n") + off * off / F.col("sxx"))
        ).alias("se"),
    )


def _panels(df: DataFrame, group: str, values: Sequence[str]) -> DataFrame:
    """One row per value, tagged with its panel (the group, and Overall) and kind of measurement."""
    panels = F.explode(F.array(F.struct(F.col(group).alias("panel")), F.struct(F.lit(OVERALL).alias("panel"))))
    wide = df.select(panels.alias("p"), *[F.col(v).cast("double").alias(v) for v in values]).select("p.panel", *values)
    long = wide.unpivot(["panel"], list(values), "measurement", "value")
    return long.withColumn("measurement", measurement_type(F.col("measurement")))


def _kernel_density(long: DataFrame, keys: list[str], adjust: float, shared_range: bool, points: int) -> DataFrame:
    """Gaussian kernel density of ``value`` on an even grid.

    Values are first spread over the grid nodes (linear binning), so the kernel sum runs over at most ``points``
    node weights per panel whatever the row count. The bandwidth is the usual rule of thumb from sd and IQR.
    """
    spread = {"sd": F.stddev_samp("x"), "lo": F.min("x"), "hi": F.max("x")}
    basis = exact_quantiles(long, keys, "value", {"q1": 0.25, "q3": 0.75}, spread)
    basis, small = settled(basis)
    if shared_range:
        limits = basis.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        basis = basis.withColumns({"lo": limits.select("lo").scalar(), "hi": limits.select("hi").scalar()})
    by_iqr = (F.col("q3") - F.col("q1")) / IQR_TO_SD
    scale = F.when(F.least(F.col("sd"), by_iqr) > 0, F.least(F.col("sd"), by_iqr)).when(F.col("sd") > 0, F.col("sd")).when(
        F.col("q1") != 0, F.abs("q1")
    ).otherwise(F.lit(1.0))
    basis = basis.select(
        *keys, "n", "lo", "hi", (BANDWIDTH_FACTOR * adjust * scale * F.pow(F.col("n"), F.lit(-0.2))).alias("bw")
    ).filter(F.col("hi") > F.col("lo"))
    step = (F.col("hi") - F.col("lo")) / (points - 1)
    at = (F.col("value") - F.col("lo")) / step
    node = F.least(F.floor(at), F.lit(points - 2).cast("bigint"))
    placed = attach(long.filter(F.col("value").isNotNull()), basis, keys, "inner", small).select(
        *keys, node.alias("node"), (at - node).alias("part")
    )
    binned = placed.groupBy(*keys, "node").agg(
        F.sum(1 - F.col("part")).alias("left"), F.sum("part").alias("right")
    )
    nodes = binned.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.col("node").alias("node"), F.col("left").alias("w")),
                F.struct((F.col("node") + 1).alias("node"), F.col("right").alias("w")),
            )
        ),
    )
    weights = nodes.groupBy(*keys, "node").agg(F.sum("w").alias("w"))
    grid = null_safe_join(weights, basis, keys, "inner").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    z = (F.col("i") - F.col("node")) * step / F.col("bw")
    kernel = F.col("w") * F.exp(-0.5 * z * z)
    norm = F.col("n") * F.col("bw") * F.sqrt(2 * F.pi())
    return grid.groupBy(*keys, "i", "n", "bw", "lo", "hi").agg(F.sum(kernel).alias("mass")).select(
        *keys,
        F.col("i").cast("bigint").alias("i"),
        (F.col("lo") + F.col("i") * step).alias("x"),
        (F.col("mass") / norm).alias("density"),
        F.col("bw").alias("bandwidth"),
    )


def density(df: DataFrame, group: str = GROUP, truth: str = TRUTH, estimate: str = ESTIMATE, adjust: float = 2.0,
            points: int = DENSITY_POINTS) -> DataFrame:
    """Densities of predicted and measured values per group and overall on one grid common to all panels."""
    return _kernel_density(_panels(df, group, [estimate, truth]), ["panel", "measurement"], adjust, True, points)


def _log_values(df: DataFrame, group: str, value: str) -> DataFrame:
    """Base-10 logarithms per group; non-positive values have none."""
    v = F.col(value).cast("double")
    return df.filter(v > 0).select(group, F.log10(v).alias("value"))


def violin_density(df: DataFrame, group: str = GROUP, value: str = TRUTH, points: int = DENSITY_POINTS) -> DataFrame:
    """Density of log10 values per group over the group's own range."""
    return _kernel_density(_log_values(df, group, value), [group], 1.0, False, points)


def box_stats(df: DataFrame, group: str = GROUP, value: str = TRUTH) -> DataFrame:
    """Five-number summary with whiskers on the log10 scale, and the number of points beyond them."""
    logs = _log_values(df, group, value)
    quartiles = exact_quantiles(logs, [group], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = WHISKER * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    with_quartiles = attach(logs, quartiles, [group], "inner")
    return with_quartiles.groupBy(group, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def join_group_sizes(metrics: DataFrame, sizes: DataFrame, group: str = GROUP) -> DataFrame:
    """Attach ``pop_size`` to metric rows."""
    return null_safe_join(metrics, sizes, [group])


def performance_points(metrics: DataFrame, sizes: DataFrame, order: DataFrame, threshold: float = 150.0,
                       group: str = GROUP) -> DataFrame:
    """Numeric metrics, and classification metrics at one threshold, with group size and order."""
    chosen = metrics.filter((F.col("metric_type") == "Numeric") | (F.col("threshold") == threshold))
    return order_join(join_group_sizes(chosen, sizes, group), order, group)


def nnt_points(nnt_table: DataFrame, sizes: DataFrame, order: DataFrame, group: str = GROUP) -> DataFrame:
    """Numbers needed to test with group size and order."""
    return order_join(join_group_sizes(nnt_table, sizes, group), order, group)
