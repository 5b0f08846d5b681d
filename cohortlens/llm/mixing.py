"""Mixing sources to target weights.

Documents get hash-random keys, are ordered by them within their source, and distributed prefix sums of their word
counts tell where each source's budget is used up. Budgets beyond a source's size repeat it in whole epochs; the
document at the cut is taken in part, so every source meets its budget to the word.

Defined cases: a null text has size 0 and takes nothing; a null source is a source of its own, ordered last; rows that
are equal in id and size are taken one after the other; an empty table gives an empty result. Columns besides the three
that are read do not matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlens.llm.common import hash_key, n_words, prefix_sums
from cohortlens.operators.joins import attach, null_safe_join
from cohortlens.sources.scratch import written

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: The mix has this many words for each word of the corpus.
SHARE = 1.5
#: A source is repeated at most this many times.
MOST_EPOCHS = 2
_SEED = "mix"
_LEADING_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """One row per source: source, source_size, target.

    Sharing a total by weight with a ceiling per source, the excess going to the others, sets every target to the
    smaller of its ceiling and one level times its weight. With sources ordered by ceiling per weight, that level is
    the largest of the levels that result from filling the first k. The two windows see one row per source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("weight", weight)
    filled = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = filled.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (share * F.sum("source_size").over(everything) - MOST_EPOCHS * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    levels = ranked.withColumn("__level", level).withColumn("__level", F.max("__level").over(everything))
    target = F.least((MOST_EPOCHS * F.col("source_size")).cast("double"), F.col("__level") * F.col("weight"))
    return levels.select("source", "source_size", target.alias("target"))


def sized(docs: DataFrame, seed: str = _SEED) -> DataFrame:
    """doc_id, source, size and the random key of every document."""
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), hash_key(seed, F.col("doc_id")).alias("key"))


def _epochs(budget: Column) -> Column:
    return F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)


def placed(docs: DataFrame, seed: str = _SEED) -> DataFrame:
    """Every document with its source's target, whole epochs, rest of the budget, and the words before it."""
    words = written(sized(docs, seed), "mix-sizes")
    budget = F.floor("target")
    targets = source_targets(words).withColumn("epochs", _epochs(budget)).withColumn(
        "room", budget - F.col("epochs") * F.col("source_size")
    )
    summed = prefix_sums(words, ["source"], "key", ["doc_id", "size"], {"before": "size"})
    return attach(summed, targets, ["source"], "inner")


def mix(docs: DataFrame, seed: str = _SEED) -> DataFrame:
    """Words that the mix takes of every document (doc_id, size, source, source_size, target, taken)."""
    extra = F.least(F.col("size"), F.greatest(F.lit(0), F.col("room") - F.col("before")))
    taken = (F.col("epochs") * F.col("size") + extra).cast("long")
    return placed(docs, seed).select("doc_id", "size", "source", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, seed: str = _SEED) -> DataFrame:
    """The documents of the mix: one row per repetition, the one at a source's cut shortened to the words left.

    Only each source's cut is looked up; the texts themselves are not shuffled.
    """
    at = placed(docs, seed)
    last = F.max(F.when(F.col("before") < F.col("room"), F.struct("key", "doc_id", "size", "before")))
    cuts = written(
        at.groupBy("source").agg(F.max("epochs").cast("int").alias("__epochs"), F.max("room").alias("__room"), last.alias("__cut")),
        "mix-cuts",
    )
    keyed = docs.withColumn("__key", hash_key(seed, F.col("doc_id")))
    keyed = attach(keyed, cuts, ["source"], "inner").withColumn("__cut_key", F.col("__cut.key"))
    near = F.coalesce(F.col("__key") == F.col("__cut_key"), F.lit(False))
    whole = keyed.filter(~near).withColumn(
        "__times", F.col("__epochs") + F.coalesce((F.col("__key") < F.col("__cut_key")).cast("int"), F.lit(0))
    )
    tie = keyed.filter(near).withColumn("__size", n_words(F.col("text")))
    order = Window.partitionBy("source").orderBy(F.col("doc_id"), F.col("__size"), F.xxhash64("text"))
    tie = tie.withColumn("__upto", F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    first_room = F.col("__room") - F.col("__first")
    firsts = at.join(F.broadcast(cuts.select(F.col("source").alias("__s"), F.col("__cut.key").alias("__k"))),
                     F.col("source").eqNullSafe(F.col("__s")) & (F.col("key") == F.col("__k")))
    firsts = firsts.groupBy("source").agg(F.min("before").alias("__first"))
    tie = null_safe_join(tie, firsts, ["source"], "inner")
    extra = F.least(F.col("__size"), F.greatest(F.lit(0), first_room - F.coalesce("__upto", F.lit(0))))
    tie = tie.withColumn("__extra", extra)
    columns = docs.columns
    kept = whole.filter("__times > 0").withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*columns)
    again = tie.filter("__epochs > 0").withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__epochs")))).select(*columns)
    words = F.slice(F.regexp_extract_all("text", F.lit(_LEADING_WORD), 0), 1, F.col("__extra").cast("int"))
    shortened = F.when(F.col("__extra") == F.col("__size"), F.col("text")).otherwise(F.array_join(words, ""))
    part = tie.filter("__extra > 0").withColumn("text", shortened)
    if "n_chars" in columns:
        part = part.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.unionByName(again).unionByName(part.select(*columns))
