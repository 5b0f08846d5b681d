"""What several corpus operators share: the word pattern, column shields, joins of checked size, distributed prefix sums."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cohortlens.operators.joins import null_safe_join

#: Words are separated by ASCII white space only.
WORD = r"[^\x20\x09-\x0D]+"
#: A table of ids or of bounded values is broadcast only after it was counted and holds at most this many rows.
BROADCAST_IDS = 200_000
#: Rows that one window partition of a prefix sum orders, on average.
_RUN_ROWS = 512
#: Bits of ``hash_key``.
KEY_BITS = 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_key(seed: str, *values: Column) -> Column:
    """A uniform 60-bit number that other SQL engines can compute too."""
    parts = [F.lit(seed), *[F.coalesce(v.cast("string"), F.lit("")) for v in values]]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, KEY_BITS // 4), 16, 10).cast("long")


def semi_join_ids(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` occurs in ``ids`` (one column, distinct): broadcast if counted small, else shuffled."""
    small = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if small else ids, on, "left_semi")


def prefix_sums(df: DataFrame, groups: list[str], key: str, order: list[str], values: dict[str, str]) -> DataFrame:
    """Add, per output name in ``values``, the sum of the named column over all earlier rows of the group.

    ``key`` is a ``hash_key``; rows are ordered by it, then by ``order``. Groups are cut into key ranges, ranges are
    summed first and their offsets added, so a group of any size is spread over many small windows. NULL group values
    form a group. The input is read twice: pass a written table.
    """
    bits = 0
    rows = df.count()
    while rows >> bits > _RUN_ROWS and bits < KEY_BITS - 1:
        bits += 1
    ranged = df.withColumn("__range", F.shiftright(key, KEY_BITS - bits))
    cut = [*groups, "__range"]
    earlier_ranges = Window.partitionBy(*groups).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(*cut).agg(*[F.sum(v).alias(f"__sum_{n}") for n, v in values.items()])
    offsets = offsets.select(
        *cut, *[F.coalesce(F.sum(f"__sum_{n}").over(earlier_ranges), F.lit(0)).alias(f"__offset_{n}") for n in values]
    )
    earlier_rows = Window.partitionBy(*cut).orderBy(key, *order).rowsBetween(Window.unboundedPreceding, -1)
    joined = null_safe_join(ranged, offsets, cut, "inner")
    for n, v in values.items():
        joined = joined.withColumn(n, F.col(f"__offset_{n}") + F.coalesce(F.sum(v).over(earlier_rows), F.lit(0)))
    return joined.drop("__range", *[f"__offset_{n}" for n in values])


_kept_by: dict[str, Callable[[], None]] = {}


def keeps(operator: str, forget: Callable[[], None]) -> None:
    """An operator keeps something in its worker processes between tasks; ``forget`` drops it."""
    _kept_by[operator] = forget


def at_work(operator: str) -> None:
    """Called by an operator's tasks: a worker that several operators share holds what one of them keeps, not all."""
    others = [name for name in _kept_by if name != operator]
    for name in others:
        _kept_by.pop(name)()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)
