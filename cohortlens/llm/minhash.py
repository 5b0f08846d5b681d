"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

A shingle's position is a first permutation of its hash on a circle of ``CIRCLE`` places. A second, fixed permutation of
the circle, shifted by k places, gives signature coordinate k, so all coordinates of one shingle are a run of
neighbouring values and a signature is the element-wise minimum of such runs. ``BANDS`` bands of ``BAND_ROWS``
coordinates miss a pair at the lowest similarity that counts with a probability of about 5e-6.

Documents with equal shingle sets form one class first. In each band, class representatives with equal values form a
bucket:

1. Every member is compared with a pivot of its bucket (two rounds with different random pivots); confirmed links are
   joined into components.
2. Buckets that still hold several components are compared exhaustively between components, in blocks: counts of
   shingles per cell give an upper bound of the similarity that no linked pair can miss, and only pairs that pass it
   are kept, each once, by the first band they share. They are confirmed on their full sets like all others.

So no two members of one component are compared again, and no link between different texts is lost.

Defined cases: null texts and texts without words have an empty set, size 0, and are linked with nothing; a text with
fewer words than a shingle is one shingle; repeated rows and equal texts share a class; rows of one id with different
texts are one node; a null id names a component only if all documents of the class have none; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
import xxhash

from cohortlens.llm.common import BROADCAST_IDS, at_work, keeps, semi_join_ids
from cohortlens.llm.components import components, joined_components
from cohortlens.sources.scratch import written

#: Words per shingle and least similarity in hundredths, unless a caller asks for others.
SHINGLE_WORDS = 5
SIMILARITY = 80
BANDS, BAND_ROWS = 40, 6
#: Places on the circle, a power of two.
CIRCLE = 1 << 20
#: Cells of the shingle counts that bound a similarity from above.
_CELLS = 256
#: Members of a bucket that are compared as one block.
_BLOCK = 1024
#: Words whose hashes a worker remembers.
_REMEMBERED = 200_000
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

_runs: np.ndarray | None = None
_hashes: dict[bytes, int] = {}


def _circle() -> np.ndarray:
    """Row p holds the second permutation at p, p+1, ... (a view, no copies)."""
    global _runs
    if _runs is None:
        values = np.random.Generator(np.random.PCG64(20240)).permutation(CIRCLE).astype(np.uint32)
        ring = np.concatenate([values, values[: BANDS * BAND_ROWS]])
        _runs = np.lib.stride_tricks.sliding_window_view(ring, BANDS * BAND_ROWS)
    return _runs


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_ODD[0])
    x = (x ^ (x >> np.uint64(29))) * np.uint64(_ODD[1])
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a UTF-8 text, A-Z in lower case."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(_hashes) > _REMEMBERED:
        _hashes.clear()
    keeps("minhash", _hashes.clear)
    known, own = _hashes.get, []
    for w in words:
        h = known(w)
        if h is None:
            h = _hashes[w] = xxhash.xxh3_64_intdigest(w)
        own.append(h)
    hashes = np.array(own, np.uint64)
    taken = min(width, len(words))
    rolled = np.full(len(words) - taken + 1, taken, np.uint64)
    for i in range(taken):
        rolled = _mixed(rolled + hashes[i : i + len(rolled)] + np.uint64(i))
    return np.unique(rolled)


def _signature(shingles: np.ndarray) -> np.ndarray:
    positions = (_mixed(shingles) & np.uint64(CIRCLE - 1)).astype(np.int64)
    runs = _circle()
    least = runs[positions[:512]].min(axis=0)
    for i in range(512, len(positions), 512):
        np.minimum(least, runs[positions[i : i + 512]].min(axis=0), out=least)
    return least


def _band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    rows = signature.astype(np.uint64).reshape(BANDS, BAND_ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(BAND_ROWS):
        key = _mixed(key * np.uint64(_ODD[1]) + rows[:, i])
    return key.view(np.int64)


def _cells(shingles: np.ndarray) -> bytes:
    """Shingles per cell. Counts stop at 255: a cut count would lower the bound, so such sets carry none."""
    counts = np.bincount((shingles >> np.uint64(56)).astype(np.int64), minlength=_CELLS)
    return counts.astype(np.uint8).tobytes() if counts.max() <= 255 else b""


_SIGNED = "doc_id long, n_shingles long, class binary, bands array<long>, cells binary"


def signed(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """Per document: set size, a 128-bit digest of the set (null if empty), band keys, shingles per cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("minhash")
        for batch in batches:
            sizes, classes, bands, cells = [], [], [], []
            for text in batch.column(1).cast(pa.binary()):
                own = shingle_set(text.as_py(), width)
                sizes.append(len(own))
                classes.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                bands.append(_band_keys(_signature(own)) if len(own) else None)
                cells.append(_cells(own) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(cells, pa.binary())],
                names=["doc_id", "n_shingles", "class", "bands", "cells"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _SIGNED)


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(id, shingles): the sorted set as packed 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("minhash")
        for batch in batches:
            sets = [shingle_set(t.as_py(), width).tobytes() for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["id", "shingles"])

    return docs.select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(run, "id long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Those of the distinct pairs (a, b) whose full sets are similar enough, with both set sizes and the overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, overlaps = [], []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                if 100 * len(small) < similarity * len(large):
                    continue
                at = np.searchsorted(large, small)
                at[at == len(large)] = 0
                both = int((large[at] == small).sum())
                if 100 * both >= similarity * (len(x) + len(y) - both):
                    keep.append(i)
                    overlaps.append(both)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64())),
                 pa.array(overlaps, pa.int64())],
                names=["a", "b", "overlap"],
            )

    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(run, "a long, b long, overlap long")


def pivot_pairs(members: DataFrame, seed: int) -> DataFrame:
    """Distinct pairs of a member with its bucket's pivot, the member whose random number is smallest.

    The number depends on the member only, so the many buckets that a group of near copies shares have few different
    pivots. ``members`` has (band, id, component); buckets of one component are left out.
    """
    drawn = F.struct(F.xxhash64("id", F.lit(seed)).alias("draw"), F.col("id"))
    buckets = (
        members.groupBy("band")
        .agg(F.min(drawn).alias("pivot"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("band", F.col("pivot.id").alias("pivot"))
    )
    met = members.join(buckets, "band").where("id <> pivot")
    return met.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()


def _block_rows(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of buckets with several components, once for every block they are compared in.

    The members of a bucket's most frequent component form its core, which is never compared with itself.
    """
    per = members.groupBy("band", "component").agg(F.count("*").alias("n"))
    buckets = per.groupBy("band").agg(
        F.count("*").alias("parts"), F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("core")
    ).where("parts > 1")
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / F.lit(float(_BLOCK)))).cast("int")
    buckets = buckets.select(
        "band", F.col("core.component").alias("core"), blocks(F.col("core.n")).alias("cores"),
        blocks(F.col("all") - F.col("core.n")).alias("others"),
    )
    met = members.join(buckets, "band").withColumn("inner", F.col("component") == F.col("core"))
    slot = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    # A core member meets every block of others; another member meets every core block and every block of others.
    others, cores = F.sequence(F.lit(0), F.col("others") - 1), F.sequence(F.lit(0), F.col("cores") - 1)
    tile = lambda x, y: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"))
    own = slot(F.col("others"))
    with_core = F.transform(cores, lambda c: tile(c, own))
    among = F.transform(others, lambda o: tile(-1 - F.least(o, own), F.greatest(o, own)))
    tiles = F.when(F.col("inner"), F.transform(others, lambda o: tile(slot(F.col("cores")), o))).otherwise(
        F.array_distinct(F.concat(with_core, among))
    )
    placed = met.select("band", "id", "component", F.explode(tiles).alias("tile"))
    return placed.join(classes.select("id", "n_shingles", "bands", "cells"), "id").select(
        "band", F.col("tile.x").alias("x"), F.col("tile.y").alias("y"), "id", "component", "n_shingles", "bands", "cells"
    )


def _cross_pairs(rows: dict[str, np.ndarray], bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one tile between different components whose first shared band is the tile's and that pass the bound."""
    ids, part, sizes, bands, cells, full = (rows[k] for k in ("id", "component", "n", "bands", "cells", "full"))
    left, right = [], []
    for i in range(len(ids) - 1):
        rest = np.arange(i + 1, len(ids))
        rest = rest[(part[rest] != part[i]) & (ids[rest] != ids[i])]
        low, high = np.minimum(sizes[i], sizes[rest]), np.maximum(sizes[i], sizes[rest])
        rest = rest[100 * low >= bound * high]
        if not len(rest):
            continue
        rest = rest[np.argmax(bands[rest] == bands[i], axis=1) == rows["column"]]
        both = np.minimum(cells[i], cells[rest]).sum(axis=1, dtype=np.int64)
        rest = rest[~(full[i] & full[rest]) | (100 * both >= bound * (sizes[i] + sizes[rest] - both))]
        left.append(np.full(len(rest), ids[i]))
        right.append(ids[rest])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def remaining_pairs(members: DataFrame, classes: DataFrame, similarity: int) -> DataFrame:
    """Distinct pairs (a, b) of equal band and different component that may be similar enough."""

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            keys = np.stack([held.column(c).to_numpy().astype(np.int64) for c in ("band", "x", "y")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            if len(cuts):
                yield from _of_table(held.slice(0, int(cuts[-1])), np.concatenate([[0], cuts]))
                held = held.slice(int(cuts[-1]))
        if held is not None and held.num_rows:
            yield from _of_table(held, np.array([0, held.num_rows]))

    def _of_table(table: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        ids, part, sizes, band, x = (table.column(c).to_numpy() for c in ("id", "component", "n_shingles", "band", "x"))
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        raw = table.column("cells").to_pylist()
        full = np.array([len(c) == _CELLS for c in raw])
        cells = np.frombuffer(b"".join(c or bytes(_CELLS) for c in raw), np.uint8).reshape(-1, _CELLS)
        for start, end in zip(cuts[:-1], cuts[1:]):
            if end - start < 2:
                continue
            own = slice(start, end)
            column = int(np.argmax(bands[start] == band[start]))
            a, b = _cross_pairs(
                {"id": ids[own], "component": part[own], "n": sizes[own], "bands": bands[own], "cells": cells[own],
                 "full": full[own], "column": column}, similarity,
            )
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    rows = _block_rows(members, classes)
    sorted_rows = rows.repartition("band", "x", "y").sortWithinPartitions("band", "x", "y")
    return sorted_rows.mapInArrow(tiles, "a long, b long").distinct()


def linked_classes(docs: DataFrame, width: int = SHINGLE_WORDS, similarity: int = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(document signatures with their class's representative ``id``, components of the representatives)."""
    signatures = written(signed(docs, width), "signatures")
    classes = signatures.where("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("id"), F.min(F.struct("doc_id", "n_shingles", "bands", "cells")).alias("own")
    )
    classes = written(classes.where("id is not null").select("class", "id", "own.n_shingles", "own.bands", "own.cells"), "classes")
    bands = classes.select("id", F.explode("bands").alias("band"))
    crowded = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    met = written(bands.join(crowded, "band", "left_semi"), "crowded")
    involved = met.select("id").distinct()
    texts = semi_join_ids(docs.withColumn("__id", F.col("doc_id").cast("long")), involved.withColumnRenamed("id", "__id"), "__id")
    sets = written(shingle_sets(texts, width), "sets")
    labels = None
    for step in range(3):
        members = _labelled(met, labels)
        pairs = pivot_pairs(members, step) if step < 2 else remaining_pairs(members, classes, similarity)
        found = confirmed(pairs, sets, similarity).select("a", "b")
        labels = written(components(found) if labels is None else joined_components(labels, found), "labels")
    named = signatures.where("class is not null").join(classes.select("class", "id"), "class", "left")
    # Documents without shingles have no class; they take no join, where they would all meet.
    return named.unionByName(signatures.where("class is null").withColumn("id", F.col("doc_id"))), labels


def _labelled(met: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return met.withColumn("component", F.col("id"))
    known = met.join(labels.withColumnRenamed("node", "id"), "id", "left")
    return known.select("band", "id", F.coalesce("component", "id").alias("component"))


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest reachable id), kept (is that id)."""
    members, labels = linked_classes(docs, width, similarity)
    linked = F.col("n_shingles") > 0
    named = members.where(linked).join(labels.withColumnRenamed("node", "id"), "id", "left")
    named = named.unionByName(members.where(~linked).withColumn("component", F.col("id")))
    component = F.coalesce("component", "id", "doc_id")
    return named.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def without_copies(docs: DataFrame, width: int = SHINGLE_WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """The documents without all but one of each group of near-duplicates (the one with the smallest id).

    Only ids to remove are looked up, and texts are not shuffled while those are few. Rows that repeat a document whole
    are reduced to one.
    """
    found = written(near_duplicates(docs, width, similarity), "groups")
    gone = found.where("not kept and doc_id is not null").select("doc_id").distinct()
    few = gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    left = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = found.where("kept").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    return left.distinct() if repeated else left
