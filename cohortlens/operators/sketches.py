"""Quantiles of large cohorts from stored sketches: one per part of the data, merged when asked.

A part (for example a day of intake) is read once. Its sketches, a few KB per group and variable, lie in a table partitioned
by part; a new or corrected part replaces its own partition, and no other part is read or written. A summary reads sketches
only. Any number of parts merges without a loss of accuracy.

The sketches keep randomly chosen values, so two builds differ within the error bound; use ``summary_continuous`` where
results must be exact. Defined cases: NULL and NaN are left out; a group without values has no sketch; NULL parts and
groups are kept as such; up to ``size`` values the quantiles are values of exact rank.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.config import OVERALL
from cohortlens.operators.joins import attach

#: Values a sketch keeps, about; the error bound falls almost in proportion.
SIZE = 2000
# The published error of such a sketch (99 % of all quantiles) is FACTOR / size ** POWER of the rows.
FACTOR, POWER = 2.296, 0.9021
#: The stated bound is this many times the 99 % error, more than six standard deviations.
SAFETY = 2.5
QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def rank_error(size: int = SIZE) -> float:
    """Bound of the rank error as a share of the rows, missed with a probability below one in a billion."""
    return SAFETY * FACTOR / size**POWER


def _long(df: DataFrame, cols: Sequence[str], keep: Sequence[str], group: str | None) -> DataFrame:
    """(keep, stratum, variable, value) of all values that are numbers."""
    stratum = F.col(group) if group else F.lit(OVERALL)
    wide = df.select(*keep, stratum.alias("stratum"), *[F.col(c).cast("double").alias(c) for c in cols])
    long = wide.unpivot([*keep, "stratum"], list(cols), "variable", "value")
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def sketch_parts(df: DataFrame, cols: Sequence[str], part: str, group: str | None = None, size: int = SIZE) -> DataFrame:
    """(part, stratum, variable, n, sketch): one sketch per part, group and variable, combined before the shuffle."""
    rows = _long(df.withColumnRenamed(part, "part"), cols, ["part"], "part" if group == part else group)
    return rows.groupBy("part", "stratum", "variable").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", size).alias("sketch")
    )


def store_sketches(sketches: DataFrame, folder: str) -> None:
    """Add the parts of ``sketches`` to the table in ``folder``; parts that are there already are replaced, others untouched."""
    table = sketches.repartition("part").write.partitionBy("part").mode("overwrite")
    table.option("partitionOverwriteMode", "dynamic").parquet(folder)


def stored_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """The table of all parts; a filter on ``part`` reads only those."""
    return spark.read.parquet(folder)


def approx_summary(sketches: DataFrame, size: int = SIZE, probs: Mapping[str, float] = QUARTILES) -> DataFrame:
    """(stratum, variable, n, one column per probability, rank_error) over all parts of ``sketches``."""
    merged = sketches.groupBy("stratum", "variable").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", size).alias("sketch")
    )
    quantiles = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(name) for name, p in probs.items()]
    return merged.select("stratum", "variable", "n", *quantiles, F.lit(rank_error(size)).alias("rank_error"))


def summary_continuous_approx(df: DataFrame, cols: Sequence[str], group: str | None = None, size: int = SIZE) -> DataFrame:
    """The columns of ``summary_continuous`` with a ``rank_error``, from one pass and sketches of ``size``."""
    whole = df.withColumn("__part", F.lit(0))
    return approx_summary(sketch_parts(whole, cols, "__part", group, size), size)


def rank_check(
    summary: DataFrame, df: DataFrame, cols: Sequence[str], group: str | None = None, probs: Mapping[str, float] = QUARTILES
) -> DataFrame:
    """(stratum, variable, n, p, below, upto, within): the exact shares of rows below and up to each estimate.

    ``within`` holds if a row within the bound of rank ``p * n`` has that value. One pass over the rows counts all estimates.
    """
    rows = attach(_long(df, cols, [], group), summary.drop("n"), ["stratum", "variable"], "inner")
    x = F.col("value")
    counts = rows.groupBy("stratum", "variable", "rank_error").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(x < F.col(name)).alias(f"below_{name}") for name in probs],
        *[F.count_if(x <= F.col(name)).alias(f"upto_{name}") for name in probs],
    )
    each = F.inline(F.array(*[
        F.struct(F.lit(float(p)).alias("p"), (F.col(f"below_{name}") / F.col("n")).alias("below"), (F.col(f"upto_{name}") / F.col("n")).alias("upto"))
        for name, p in probs.items()
    ]))
    # A rank is a whole number of rows: one row more on both sides.
    slack = F.col("rank_error") + 1 / F.col("n")
    checked = counts.select("stratum", "variable", "n", "rank_error", each)
    return checked.select(
        "stratum", "variable", "n", "p", "below", "upto",
        ((F.col("below") <= F.col("p") + slack) & (F.col("upto") >= F.col("p") - slack)).alias("within"),
    )
