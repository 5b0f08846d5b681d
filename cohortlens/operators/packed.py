"""Genotypes as bits: one row per variant and block of samples instead of one per variant and sample.

A block holds a few thousand samples, chosen by a hash of their name; in it a sample has a place, that is a bit of a 64-bit
word. A row keeps, for each word that holds a call and each slot (first, second ... allele of the genotype), masks:

- ``at``: slot * ``SLOT`` + word; the masks below have one entry for each of these.
- ``seen``: the sample's genotype has this slot. ``called``: its allele is known. ``planes``: bit k of the allele's number,
  as many planes as the variant's alleles need.
- ``missing``, ``unphased`` (in the first slot, else 0): some allele is missing, the alleles are separated by ``/``.

Counts are masks and ``bit_count``: 64 genotypes a step, no text, and a scan that reads the masks it needs.

Defined cases: any ploidy, also mixed; a NULL genotype is seen, but neither called nor missing; a NULL sample is a sample
of its own. Rows that repeat a sample at a variant are kept in further ``layer`` s. An allele number beyond the variant's
alternatives is an error. No calls give no rows. Further columns of the calls are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlens.operators.calls import VARIANT
from cohortlens.operators.joins import null_safe_join
from cohortlens.sources.scratch import written

#: Samples in a block, on average.
BLOCK_SAMPLES = 4096
#: Sample lists of at most this many rows (some 40 bytes each) are broadcast, larger ones joined by a shuffle.
BROADCAST_SAMPLES = 1_000_000
SLOT = 1 << 16
WORD_BITS = 64
_ENTRY = ["seen", "missing", "unphased", "called"]


def sample_places(calls: DataFrame, block_samples: int = BLOCK_SAMPLES) -> DataFrame:
    """(sample, block, place) of every sample, written once. A window sees one block, never all samples."""
    names = written(calls.select("sample").distinct(), "samples")
    blocks = max(1, math.ceil(names.count() / block_samples))
    placed = names.withColumn("block", F.pmod(F.xxhash64("sample"), F.lit(blocks)).cast("int"))
    within = Window.partitionBy("block").orderBy("sample")
    return written(placed.withColumn("place", F.row_number().over(within) - 1), "sample-places")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(WORD_BITS)).cast("int"))


def _mask(flag: Column) -> Column:
    """The bits of the rows with ``flag``."""
    return F.coalesce(F.bit_or(F.when(flag, F.col("bit"))), F.lit(0).cast("bigint"))


def _words(placed: DataFrame, width: int) -> DataFrame:
    """One row per (variant, layer, block, at) with its masks."""
    number = F.when(F.col("allele") != ".", F.col("allele").cast("int"))
    slots = placed.select(
        *VARIANT, "layer", "block", "place", "gt", F.posexplode_outer(F.split("gt", "[|/]")).alias("slot", "allele")
    )
    beyond = F.raise_error(F.lit("allele number beyond the variant's alternatives")).cast("int")
    checked = F.when(number > F.size(F.split("alt", ",")), beyond).otherwise(number)
    first = F.coalesce(F.col("slot"), F.lit(0)) == 0
    entries = slots.select(
        *VARIANT, "layer", "block",
        (F.coalesce(F.col("slot"), F.lit(0)) * SLOT + F.floor(F.col("place") / WORD_BITS)).cast("int").alias("at"),
        _bit(F.col("place")).alias("bit"), first.alias("first"), F.col("gt").contains(".").alias("holes"),
        F.col("gt").contains("/").alias("split"), checked.alias("number"),
    )
    planes = [
        _mask(F.getbit(F.col("number").cast("bigint"), F.lit(k)) == 1).alias(f"p{k}") for k in range(width)
    ]
    return entries.groupBy(*VARIANT, "layer", "block", "at").agg(
        F.bit_or("bit").alias("seen"), _mask(F.col("first") & F.col("holes")).alias("missing"),
        _mask(F.col("first") & F.col("split")).alias("unphased"), _mask(F.col("number").isNotNull()).alias("called"),
        F.count(F.lit(1)).alias("rows"), *planes,
    )


def _repeated(placed: DataFrame) -> DataFrame:
    """The calls with the number of earlier rows of their sample and variant as their layer."""
    same = Window.partitionBy(*VARIANT, "block", "place").orderBy("gt")
    return placed.withColumn("layer", F.row_number().over(same) - 1)


def pack_calls(calls: DataFrame, samples: DataFrame) -> DataFrame:
    """Packed form of a long ``calls`` table; ``samples`` comes from ``sample_places``.

    Masks are built by a partial ``bit_or`` in the tasks that read the calls, so a shuffle carries words and not calls.
    Runs one look at ``alt`` (for the number of planes) and one count of the samples while the plan is built.
    """
    most = calls.agg(F.max(F.size(F.split("alt", ",")))).first()[0] or 1
    width = max(1, int(most).bit_length())
    small = samples.limit(BROADCAST_SAMPLES + 1).count() <= BROADCAST_SAMPLES
    placed = null_safe_join(
        calls.select(*VARIANT, "sample", "gt"), F.broadcast(samples) if small else samples, ["sample"], "inner"
    ).drop("sample").withColumn("layer", F.lit(0))
    words = written(_words(placed, width), "genotype-words")
    twice = words.filter(F.col("rows") > F.bit_count("seen")).select(*VARIANT, "block").distinct()
    if not twice.isEmpty():
        # Only blocks that repeat a sample are ordered, sample by sample.
        keys = [*VARIANT, "block"]
        again = _words(_repeated(null_safe_join(placed, twice, keys, "left_semi")), width)
        words = null_safe_join(words, twice, keys, "left_anti").unionByName(again)
    keys = [*VARIANT, "layer", "block"]
    planes = [f"p{k}" for k in range(width)]
    rows = words.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", *_ENTRY, *planes))).alias("w"))

    def column(name: str) -> Column:
        return F.transform("w", lambda e: e[name])

    needed = F.length(F.bin(F.size(F.split("alt", ",")).cast("bigint")))
    return rows.select(
        *keys, column("at").alias("at"), *[column(c).alias(c) for c in _ENTRY],
        F.slice(F.array(*[column(p) for p in planes]), F.lit(1), needed).alias("planes"),
    )


# ---- counts ----------------------------------------------------------------------------------------------------


def _ones(masks: Column) -> Column:
    return F.aggregate(masks, F.lit(0).cast("bigint"), lambda n, m: n + F.bit_count(m))


def _carriers(allele: Column) -> Column:
    """Masks of the called alleles with this number: planes that are set where it has a bit, and not where it has none."""
    def narrowed(masks: Column, plane: Column, k: Column) -> Column:
        wanted = F.call_function("shiftright", allele, k).bitwiseAND(F.lit(1)) == 1
        return F.when(wanted, F.zip_with(masks, plane, lambda m, p: m.bitwiseAND(p))).otherwise(
            F.zip_with(masks, plane, lambda m, p: m.bitwiseAND(F.bitwise_not(p)))
        )

    numbered = F.transform("planes", lambda p, k: F.struct(p.alias("p"), k.alias("k")))
    return F.aggregate(numbered, F.col("called"), lambda masks, e: narrowed(masks, e["p"], e["k"]))


def packed_an_ac(packed: DataFrame) -> DataFrame:
    """AN and AC per variant, the same rows as ``calls.an_ac``; blocks are counted apart and added up."""
    alleles = F.sequence(F.lit(0), F.size(F.split("alt", ",")))
    counts = F.transform(
        alleles, lambda a: F.struct(a.alias("allele"), F.when(a == 0, _ones(F.col("called"))).otherwise(_ones(_carriers(a))).alias("c"))
    )
    per_block = packed.select(*VARIANT, F.inline(counts))
    summed = per_block.groupBy(*VARIANT, "allele").agg(F.sum("c").alias("c"))
    # One entry per allele of the variant.
    per_variant = summed.groupBy(*VARIANT).agg(
        F.max(F.when(F.col("allele") == 0, F.col("c"))).alias("an"),
        F.array_sort(F.collect_list(F.when(F.col("allele") > 0, F.struct("allele", "c")))).alias("each"),
    )
    return per_variant.select(
        *VARIANT, "an", F.array_join(F.transform("each", lambda e: e["c"].cast("string")), ",").alias("ac")
    )


def packed_sample_missingness(packed: DataFrame, samples: DataFrame) -> DataFrame:
    """Samples with missing genotypes and how many, the same rows as ``calls.sample_missingness``.

    The 64 bits of a word are 64 sums, so the words of all variants add up without a row per genotype.
    """
    words = packed.select("block", F.inline(F.arrays_zip("at", "missing"))).filter(F.col("missing") != 0)
    sums = words.groupBy("block", "at").agg(
        *[F.sum(F.getbit("missing", F.lit(b)).cast("bigint")).alias(f"b{b}") for b in range(WORD_BITS)]
    )
    each = sums.select(
        "block", "at", F.posexplode(F.array(*[f"b{b}" for b in range(WORD_BITS)])).alias("b", "n_missing")
    ).filter(F.col("n_missing") > 0)
    placed = each.select(F.col("block").alias("k"), (F.col("at") * WORD_BITS + F.col("b")).alias("p"), "n_missing")
    return samples.join(placed, (F.col("block") == F.col("k")) & (F.col("place") == F.col("p"))).select("sample", "n_missing")


def packed_multiallelic_count(packed: DataFrame) -> DataFrame:
    """One row: number of variants with more than one alternative allele."""
    several = packed.filter(F.col("alt").contains(",")).select(*VARIANT).distinct()
    return several.agg(F.count(F.lit(1)).alias("n_multiallelic"))


def packed_is_phased(packed: DataFrame) -> DataFrame:
    """One row: number of unphased calls, and whether there is none."""
    counted = packed.agg(F.coalesce(F.sum(_ones(F.col("unphased"))), F.lit(0).cast("bigint")).alias("n_unphased"))
    return counted.select("n_unphased", (F.col("n_unphased") == 0).alias("phased"))


def unpack_calls(packed: DataFrame, samples: DataFrame) -> DataFrame:
    """The long table again; a genotype with both separators gets ``/`` throughout."""
    slots = packed.select(
        *VARIANT, "layer", "block",
        F.posexplode("at").alias("i", "at"), *_ENTRY, "planes",
    )
    entry = [F.col(c)[F.col("i")].alias(c) for c in _ENTRY]
    bits = slots.select(
        *VARIANT, "layer", "block", F.floor(F.col("at") / SLOT).alias("slot"),
        (F.col("at") % SLOT).alias("word"), *entry,
        F.transform("planes", lambda p: p[F.col("i")]).alias("planes"),
        F.explode(F.sequence(F.lit(0), F.lit(WORD_BITS - 1))).alias("b"),
    )
    def at_bit(c: Column) -> Column:
        return F.call_function("getbit", c, F.col("b"))

    number = F.aggregate(
        F.transform("planes", lambda p, k: F.call_function("shiftleft", at_bit(p).cast("int"), k)), F.lit(0), lambda n, v: n + v
    )
    alleles = bits.select(
        *VARIANT, "layer", "block", "slot", (F.col("word") * WORD_BITS + F.col("b")).alias("place"),
        at_bit(F.col("seen")).alias("seen"), at_bit(F.col("unphased")).alias("unphased"),
        at_bit(F.col("missing")).alias("missing"),
        F.when(at_bit(F.col("called")) == 1, number.cast("string")).alias("allele"),
    )
    genotype = alleles.filter("seen = 1").groupBy(*VARIANT, "layer", "block", "place").agg(
        F.max("unphased").alias("unphased"), F.max("missing").alias("missing"),
        F.array_sort(F.collect_list(F.struct("slot", "allele"))).alias("a"),
    )
    shown = F.transform("a", lambda e: F.coalesce(e["allele"], F.lit(".")))
    text = F.when(F.col("unphased") == 1, F.array_join(shown, "/")).otherwise(F.array_join(shown, "|"))
    known = (F.col("missing") == 1) | F.col("a")[0]["allele"].isNotNull()
    named = null_safe_join(genotype, samples, ["block", "place"], "inner")
    return named.select(*VARIANT, "sample", F.when(known, text).alias("gt"))
