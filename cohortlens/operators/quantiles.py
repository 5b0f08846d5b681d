"""Exact quantiles of groups of any size.

Spark's ``percentile`` keeps all distinct values of a group in one task. Here a sketch first gives, per group, a
narrow interval around each wanted rank; one further aggregation counts the rows between the intervals and keeps
single values only inside them. In large groups these are ordered in slices, so no window grows with the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlens.operators.joins import attach, null_safe_join, settled
from cohortlens.sources.scratch import written

#: Relative rank error of the sketch is 1 / ACCURACY.
ACCURACY = 20_000
_MARGIN = 4.0 / ACCURACY


#: From this size of the largest group on, what its last window would hold is ordered slice by slice.
SPLIT_ROWS = 20_000_000
_SLICES = 4096


def _ranked(counted: DataFrame, keys: list[str], split: bool) -> DataFrame:
    """Add ``upto``, the rows of the group up to each value.

    The values inside the intervals are about 0.04 % of a group per quantile. In large groups they are ordered within
    slices of the intervals, and the rows of the slices before are added from a table of at most a few thousand rows per
    group, so no window grows with the group.
    """
    value = F.asc_nulls_last("x")
    if not split:
        return counted.withColumn("upto", F.sum("c").over(_up_to_here(keys, "region", value)))
    counted = written(counted, "quantile-values")
    cut = [*keys, "region", "slice"]
    sums = counted.groupBy(*cut).agg(F.sum("c").alias("s"))
    sums = sums.select(*cut, (F.sum("s").over(_up_to_here(keys, "region", "slice")) - F.col("s")).alias("before"))
    placed = null_safe_join(counted, sums, cut, "inner")
    return placed.withColumn("upto", F.col("before") + F.sum("c").over(_up_to_here(cut, value)))


def _up_to_here(keys: list[str], *order):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], also: dict[str, Column] | None = None
) -> DataFrame:
    """Linearly interpolated sample quantiles (type 7) per group, NULL and NaN ignored.

    ``probs`` maps output column to probability. ``also`` maps output column to a further aggregate of column ``x``
    (the value), taken in the pass of the sketch. Result: ``keys``, ``n``, and one column per entry.
    """
    keys, also = list(keys), also or {}
    if not keys:
        return exact_quantiles(df.withColumn("__all", F.lit(True)), ["__all"], value, probs, also).drop("__all")
    rows = df.select(*keys, F.col(value).cast("double").alias("x")).filter(
        F.col("x").isNotNull() & ~F.isnan("x")
    )
    wanted = sorted(set(probs.values()))
    edges = sorted({min(max(p + s, 0.0), 1.0) for p in wanted for s in (-_MARGIN, _MARGIN)})
    # Region 2i+1 lies around the i-th wanted quantile; the even regions are only counted.
    lows = [max(p - _MARGIN, 0.0) for p in wanted]
    highs = [min(p + _MARGIN, 1.0) for p in wanted]
    sketch = rows.groupBy(*keys).agg(
        F.percentile_approx("x", F.array(*[F.lit(e) for e in edges]), F.lit(ACCURACY)).alias("edge"),
        F.count(F.lit(1)).alias("n"),
        *[c.alias(name) for name, c in also.items()],
    )

    def edge(p: float) -> Column:
        return F.col("edge").getItem(edges.index(p))

    # Up to ACCURACY rows the whole group is kept; beyond, the margin exceeds the sketch error by three ranks or more.
    small = F.col("n") <= ACCURACY
    sketch = sketch.select(
        *keys,
        "n",
        *[F.when(small, F.lit(float("-inf"))).otherwise(edge(p)).alias(f"lo{i}") for i, p in enumerate(lows)],
        *[F.when(small, F.lit(float("inf"))).otherwise(edge(p)).alias(f"hi{i}") for i, p in enumerate(highs)],
        *also,
    )
    sketch, is_small = settled(sketch)
    placed = attach(rows, sketch.drop(*also), keys, small=is_small)
    x = F.col("x")
    inside = F.lit(False)
    region = F.lit(0)
    for i in range(len(wanted)):
        inside = inside | x.between(F.col(f"lo{i}"), F.col(f"hi{i}"))
        region = region + (x >= F.col(f"lo{i}")).cast("int") + (x > F.col(f"hi{i}")).cast("int")
    # Where the interval lies that holds x, cut into equal slices; 0 for rows that are only counted.
    slices = [
        F.least(F.lit(_SLICES - 1), F.floor(F.coalesce(F.try_divide(x - F.col(f"lo{i}"), F.col(f"hi{i}") - F.col(f"lo{i}")), F.lit(0.0)) * _SLICES).cast("int"))
        for i in range(len(wanted))
    ]
    slice_ = F.coalesce(*[F.when(x.between(F.col(f"lo{i}"), F.col(f"hi{i}")), slices[i]) for i in range(len(wanted))], F.lit(0))
    slice_ = F.when(F.col("n") <= ACCURACY, F.lit(0)).otherwise(F.when(inside, slice_).otherwise(F.lit(0)))
    counted = (
        placed.select(*keys, "n", region.alias("region"), slice_.alias("slice"), F.when(inside, x).alias("x"))
        .groupBy(*keys, "n", "region", "slice", "x")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    ranked = _ranked(counted, keys, (sketch.agg(F.max("n")).first()[0] or 0) > SPLIT_ROWS)

    def at_rank(rank: Column) -> Column:
        """Value at a 1-based rank; a collapsed region there would mean the sketch broke its bound."""
        hit = F.min(F.when(F.col("upto") >= rank, F.struct("upto", "x")))
        return F.coalesce(
            hit.getField("x"), F.raise_error(F.lit("quantile outside its sketch interval")).cast("double")
        )

    outs = []
    for name, p in probs.items():
        h = (F.col("n") - 1) * F.lit(p)
        lo, frac = F.floor(h), h - F.floor(h)
        low, high = at_rank(lo + 1), at_rank(lo + 1 + (frac > 0).cast("int"))
        outs.append((name, low, high, frac))
    result = ranked.groupBy(*keys, "n").agg(
        *[low.alias(f"{name}__l") for name, low, _, _ in outs],
        *[high.alias(f"{name}__h") for name, _, high, _ in outs],
    )
    result = result.select(
        *keys,
        "n",
        *[
            (F.col(f"{name}__l") + frac * (F.col(f"{name}__h") - F.col(f"{name}__l"))).alias(name)
            for name, _, _, frac in outs
        ],
    )
    return null_safe_join(result, sketch.select(*keys, *also), keys) if also else result
