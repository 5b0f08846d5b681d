"""Bounded, reproducible samples per group: the k rows with the smallest draws.

A row's draw is a hash of its content, so the sample does not depend on partitioning or order, and samples of parts merge:
the k smallest draws of all parts are among the k smallest of each. No window runs over a group: draws are uniform, so a bound
that about k + 8 sqrt(k) rows of a group lie below is known from its size, and only those rows are ordered.

Defined cases: groups of at most k rows are kept whole; NULL keys are a group; equal rows have equal draws, are counted
before they are ordered, and stay as often as they fit; ``k`` must be positive; an empty table gives an empty sample.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cohortlens.config import ESTIMATE, GROUP, ID, TRUTH
from cohortlens.functions.draws import draw60
from cohortlens.functions.scalars import group_label
from cohortlens.operators.joins import attach, settled
from cohortlens.sources.scratch import written

POINTS = 2000
_DRAWS = 2**60
_WIDER = 8


def _text(c: str, data_type: T.DataType) -> Column:
    """Text of a value, the same on every engine."""
    value = F.col(c)
    if isinstance(data_type, T.NumericType):
        value = value.try_cast("decimal(38,6)")
    return F.coalesce(value.cast("string"), F.lit("NA"))


def _smallest(counted: DataFrame, keys: Sequence[str], content: Sequence[str], k: int) -> DataFrame:
    """The k rows with the smallest draws of each group, from distinct rows with their number of ``copies``."""
    order = Window.partitionBy(*keys).orderBy("draw", *content).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("copies").over(order), F.lit(0))
    placed = counted.withColumn("room", F.lit(k) - before).filter(F.col("room") > 0)
    copies = F.least(F.col("copies"), F.col("room")).cast("int")
    return placed.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("room", "copies", "copy")


def _weighted(sample: DataFrame, k: int) -> DataFrame:
    """Every row of a group stands for the same number of rows; they add up to the group's size."""
    return sample.withColumn("weight", F.col("group_rows") / F.least(F.col("group_rows"), F.lit(k)))


def bottom_k(df: DataFrame, keys: Sequence[str], columns: Sequence[str], k: int = POINTS, seed: int = 0) -> DataFrame:
    """(keys, columns, draw, group_rows, weight) of at most ``k`` rows per group.

    Group sizes and the candidates are counted while the plan is built; if a group has too few candidates (about never,
    unless few distinct rows make it up) the bound is widened, so the result is always that of the whole group.
    """
    if k < 1:
        raise ValueError("k must be positive")
    keys, columns = list(keys), list(columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    draw = draw60(seed, "sample", *[_text(c, types[c]) for c in columns])
    rows = df.select(*keys, *columns).withColumn("draw", draw)
    sizes, small = settled(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows")))
    wanted, factor = k + 8 * math.sqrt(k) + 8, 1.0
    while True:
        share = F.lit(wanted * factor) / F.col("group_rows")
        bounds = sizes.withColumn("bound", F.when(share >= 1, F.lit(_DRAWS)).otherwise((share * _DRAWS).cast("bigint")))
        near = attach(rows, bounds, keys, "inner", small).filter(F.col("draw") < F.col("bound"))
        counted = near.groupBy(*keys, *columns, "draw", "group_rows", "bound").agg(F.count(F.lit(1)).alias("copies"))
        counted = written(counted, "sample-candidates")
        found = counted.groupBy(*keys, "group_rows", "bound").agg(F.sum("copies").alias("c"))
        # Groups that no candidate is left of are short, too.
        complete = found.filter((F.col("c") >= k) | (F.col("bound") == _DRAWS)).count()
        if complete == sizes.count():
            return _weighted(_smallest(counted.drop("bound"), keys, columns, k), k).select(
                *keys, *columns, "draw", "group_rows", "weight"
            )
        factor *= _WIDER


def merge_samples(parts: Sequence[DataFrame], keys: Sequence[str], columns: Sequence[str], k: int = POINTS) -> DataFrame:
    """The sample of all rows from the samples of parts that share no row; all must have been drawn with one seed and ``k``."""
    keys, columns = list(keys), list(columns)
    rows = reduce(DataFrame.unionByName, [p.select(*keys, *columns, "draw") for p in parts])
    sizes = reduce(DataFrame.unionByName, [p.select(*keys, "group_rows").distinct() for p in parts])
    total = sizes.groupBy(*keys).agg(F.sum("group_rows").alias("group_rows"))
    counted = rows.groupBy(*keys, *columns, "draw").agg(F.count(F.lit(1)).alias("copies"))
    return _weighted(attach(_smallest(counted, keys, columns, k), total, keys), k)


def scatter_sample(
    valid: DataFrame, points: int = POINTS, seed: int = 0, group: str = GROUP, truth: str = TRUTH, estimate: str = ESTIMATE,
    id_col: str = ID,
) -> DataFrame:
    """Rows behind the scatter plot of a large cohort: at most ``points`` per panel, with the rows each stands for."""
    sample = bottom_k(valid, [group], [id_col, truth, estimate], points, seed)
    return sample.select(
        group, group_label(F.col(group), F.col("group_rows")).alias("label"), F.col(estimate).alias("predicted"),
        F.col(truth).alias("measured"), "weight",
    )
