"""Join helpers whose strategy depends on sizes and key frequencies that were looked up first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

#: A lookup table is broadcast only when it is known to hold at most this many rows.
BROADCAST_ROWS = 10_000
#: A join key is handled apart when it is estimated to occur more often than this on the looked-up side.
HOT_ROWS = 1_000_000
_HOT_KEYS = 100
_TRACKED_KEYS = 10_000


def settled(lookup: DataFrame) -> tuple[DataFrame, bool]:
    """Evaluate an aggregated table once: as a local table if it has at most ``BROADCAST_ROWS`` rows.

    Returns the table and whether it fitted; a larger one is returned as it came.
    """
    first_rows = lookup.limit(BROADCAST_ROWS + 1).toArrow()
    if first_rows.num_rows > BROADCAST_ROWS:
        return lookup, False
    return lookup.sparkSession.createDataFrame(first_rows, schema=lookup.schema), True


def attach(
    df: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", small: bool | None = None
) -> DataFrame:
    """Null-safe join of a large table with an aggregated one.

    A lookup of proven small size is broadcast, so ``df`` is not shuffled; a larger one takes a shuffled join,
    whose skewed ``df`` partitions adaptive execution may split. ``small`` is the answer of ``settled`` for a lookup
    that went through it already.
    """
    if small is None:
        lookup, small = settled(lookup)
    return null_safe_join(df, F.broadcast(lookup) if small else lookup, on, how)


def null_safe_join(df: DataFrame, other: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join under which NULL keys match each other; the keys appear once, from ``df``.

    Used as it is for result tables, where both sides are aggregates and Spark picks the strategy from their sizes.
    """
    renamed = other.select(*[F.col(k).alias(f"__key_{k}") for k in on], *[c for c in other.columns if c not in on])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in on])
    return df.join(renamed, condition, how).drop(*[f"__key_{k}" for k in on])


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> tuple[list, bool]:
    """At most ``_HOT_KEYS`` values that a frequent-items sketch puts above ``min_rows`` rows; whether NULL occurs."""
    found = df.agg(
        F.expr(f"approx_top_k(`{key}`, {_HOT_KEYS}, {_TRACKED_KEYS})").alias("top"),
        F.count_if(F.col(key).isNull()).alias("nulls"),
    ).first()
    hot = [row["item"] for row in found["top"] or [] if row["count"] > min_rows and row["item"] is not None]
    return hot, found["nulls"] > 0


def left_join_skewed(
    left: DataFrame, right: DataFrame, key: str, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Null-safe LEFT join on ``key`` with ``left`` unique in ``key`` and ``right`` possibly dominated by few keys.

    Spark cannot split a skewed right side of a left join. Keys that dominate ``right`` (a bounded list), and NULL
    where it occurs there, are therefore joined apart with the few matching ``left`` rows broadcast; every such key
    occurs in ``right``, so an inner join loses nothing. All other keys take an ordinary equality join, which reuses
    a partitioning of ``left`` by ``key``. ``hot_rows=None`` skips the look-up and joins null-safely.
    """
    if hot_rows is None:
        return null_safe_join(left, right, [key])
    hot, nulls = hot_keys(right, key, hot_rows)
    if not hot and not nulls:
        return left.join(right, key, "left")
    apart = F.coalesce(F.col(key).isin(hot), F.lit(False)) if hot else F.lit(False)
    if nulls:
        apart = apart | F.col(key).isNull()
    # Few if ``left`` is unique in the key, as it should be; that is looked up, and otherwise the join is shuffled.
    few, small = settled(left.filter(apart))
    joined_hot = null_safe_join(right.filter(apart), F.broadcast(few) if small else few, [key], "inner")
    rest = left.filter(~apart).join(right.filter(~apart), key, "left")
    return rest.unionByName(joined_hot.select(*rest.columns))
