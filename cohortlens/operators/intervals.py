"""Records that overlap many regions, over a table laid out by chromosome and position.

A record spans ``pos .. last``. It lies in one bin, that of its first base; a region is listed in every bin where a record
that reaches it may begin, which the longest record decides. So records are not multiplied, a pair meets in one bin only, and
the number of a region's bins is its length over ``bin_bases``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortlens.operators.joins import settled

BIN_BASES = 16_384
#: Rows of one laid out file as they are held in memory, where a task sorts them; shuffled and stored they are far smaller.
FILE_BYTES = 96 << 20
#: Bounds of at most this many chromosomes are pushed one by one, else the outermost ones.
_CHROMOSOMES = 200


def with_last(calls: DataFrame) -> DataFrame:
    """The calls with the last base of their reference allele."""
    return calls.withColumn("last", F.col("pos") + F.greatest(F.length("ref"), F.lit(1)) - 1)


def _held_bytes(rows: DataFrame) -> int:
    """About how many bytes the rows take while they are sorted: their texts, and some words per row and column."""
    texts = [F.coalesce(F.octet_length(f"`{n}`"), F.lit(0)) for n, t in rows.dtypes if t == "string"]
    words = F.lit(8 * (6 + 2 * len(rows.columns))).cast("bigint")
    return rows.agg(F.sum(reduce(lambda a, b: a + b, texts, words))).first()[0] or 0


def lay_out(calls: DataFrame, folder: str, files: int | None = None) -> None:
    """Write ``calls`` with their ``last`` base, in files of neighbouring positions.

    Row groups then span short stretches of one chromosome, and the scan skips those that no region reaches. ``files``
    is the number of position ranges, by default one per ``FILE_BYTES`` of rows in memory and at least one per core: long
    alleles shrink so much when they are shuffled that ranges of a given shuffled size would be too large to sort. The calls
    are read three times (size, bounds of the ranges, rows), so they should come from a table.
    """
    spans = with_last(calls)
    if not files:
        files = max(math.ceil(_held_bytes(spans) / FILE_BYTES), spans.sparkSession.sparkContext.defaultParallelism)
    ranged = spans.repartitionByRange(files, "chrom", "pos")
    ranged.sortWithinPartitions("chrom", "pos").write.parquet(folder)


def read_laid_out(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)


def _reach(regions: DataFrame) -> Column | None:
    """A filter on stored columns: per chromosome, records that end behind its first and begin before its last region."""
    outer = regions.groupBy("chrom").agg(F.min("first").alias("first"), F.max("region_last").alias("last"))
    found = outer.limit(_CHROMOSOMES + 1).collect()
    if not found:
        return None
    if len(found) > _CHROMOSOMES:
        ends = outer.agg(F.min("first").alias("first"), F.max("last").alias("last")).first()
        return (F.col("pos") <= ends["last"]) & (F.col("last") >= ends["first"])
    each = [(F.col("chrom") == r["chrom"]) & (F.col("pos") <= r["last"]) & (F.col("last") >= r["first"]) for r in found]
    return reduce(lambda a, b: a | b, each)


def overlaps(records: DataFrame, regions: DataFrame, how: str = "inner", bin_bases: int = BIN_BASES) -> DataFrame:
    """Records joined with the regions (``region``, chrom, first, last; inclusive) that they overlap.

    ``how`` is ``inner`` for every pair once (the record with the region's name, ``region``), ``left_semi`` for every record
    once that overlaps some region, ``left_anti`` for the others. Both bounds reach the scan of a table laid out by
    ``lay_out``; calls without a ``last`` get one. Two looks at the inputs are taken while the plan is built: the
    regions' bounds and the longest record that they admit. Regions are broadcast only if they are seen to be few.

    Defined cases: regions that end before they begin, and NULL in a chromosome or bound, match nothing; repeated records
    and regions count each; a record without reference text spans one base.
    """
    if how not in ("inner", "left_semi", "left_anti"):
        raise ValueError(f"unknown kind of join: {how}")
    spans = records if "last" in records.columns else with_last(records)
    known = regions.select("region", "chrom", "first", F.col("last").alias("region_last")).filter("first <= region_last and chrom is not null")
    reach = _reach(known)
    near = spans if reach is None else spans.filter(reach)
    longest = near.agg(F.max(F.col("last") - F.col("pos"))).first()[0] or 0 if reach is not None else 0
    bins = F.sequence(
        F.floor((F.col("first") - longest) / bin_bases), F.floor(F.col("region_last") / bin_bases)
    )
    listed = known.select(
        F.col("region").alias("__region"), F.col("chrom").alias("__chrom"), "first", "region_last", F.explode(bins).alias("__bin")
    )
    listed, small = settled(listed)
    binned = (near if how != "left_anti" else spans).withColumn("__at", F.floor(F.col("pos") / bin_bases))
    meet = (
        (F.col("chrom") == F.col("__chrom")) & (F.col("__at") == F.col("__bin"))
        & (F.col("pos") <= F.col("region_last")) & (F.col("last") >= F.col("first"))
    )
    joined = binned.join(F.broadcast(listed) if small else listed, meet, how)
    extra = [F.col("__region").alias("region")] if how == "inner" else []
    return joined.select(*[F.col(f"`{c}`") for c in records.columns], *extra)
