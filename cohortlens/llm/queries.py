"""The registered queries: each reads its whole table and derives the contract's columns from its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.llm import alignment, collocations, decontamination, minhash, mixing, neighbours, packing, quality, secrets, surrogates, toxicity, warc, wrappers
from cohortlens.llm.common import table

#: The registered query's key; its results are compared between runs, so it is no secret. A run on real data brings its own.
SURROGATE_KEY = "registered query"


def op1_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extracted(table(spark, sf_dir, "pages"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secrets(table(spark, sf_dir, "documents"))
    count = lambda keep: F.size(F.filter("spans", keep)).cast("long")
    of_kind = lambda kind: count(lambda s: s["kind"] == kind).alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[of_kind(kind) for kind in secrets.KINDS[:3]],
        F.sha2(secrets.digest(F.filter("spans", lambda s: s["rank"] < 3)), 256).alias("base_sha256"),
        secrets.digest(F.col("spans")).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_copied"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, F.col("vec_id") % 100 == 0)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    counts = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()
    return rows.select(
        "doc_id", *[F.col(f"__stats.{c}").alias(c) for c in counts], quality.base_failed().alias("base_failed"),
        F.col("__kept").alias("kept"), F.col("__rule").alias("rule"),
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replaced(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op11_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    found = decontamination.matched(docs, benchmark, keep_text=False)
    hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id", F.col("__n_words").alias("n_words"), hit.alias("n_hit"), F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.cross_tokenized(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_wrappers, op2_secrets, op3_toxicity, op4_mix, op5_neighbours, op6_quality_rules, op7_packing, op8_minhash, op9_warc, op10_surrogates, op11_suffix_arrays, op12_alignment, op13_collocations)
}
