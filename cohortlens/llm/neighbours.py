"""Nearest neighbours by a block matrix join over int8 tiles, exact after refinement.

Queries and candidates are dealt into blocks; every pair of blocks is one tile in one task. In a tile, vectors are
quantised to int8 with a scale of their own, and one integer matrix product gives all distances between the quantised
vectors. A true distance differs by no more than the two quantisation errors, so a candidate whose lower bound exceeds
the k-th smallest upper bound of its query cannot be among the nearest. The others are recomputed on the original
vectors in double precision, the tile keeps k per query in a heap, and the heaps of all tiles are merged.

Defined cases: vectors that are null, empty, all zero or hold null or non-finite components take no part; only vectors
of equal length are compared; ties go to the smaller id; rows that repeat an id and its vector count once, rows of one id
with different vectors are separate candidates that ask together, and rows of a query's own id are no candidates; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

NEAREST = 10
#: Vectors of a tile's two sides.
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 8192
_TILE = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Holds only finite components, one of them not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, and the length of what the codes leave out, per row."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    error = np.sqrt(((x - codes * scale[:, None]) ** 2).sum(axis=1))
    return codes, scale, error


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows, as doubles: sums of up to 1024 terms fit a float's 24 bits."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], 1024):
        part = slice(at, at + 1024)
        out += a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
    return out


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distance of rows in double precision, components added in order."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        d = x[:, j] - y[:, j]
        total += d * d
    return np.sqrt(total)


def tile_neighbours(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query id, id, distance) of every query's k nearest candidates of other ids."""
    qk, qs, qe = quantised(q)
    ck, cs, ce = quantised(c)
    squares = lambda codes, s: (codes.astype(np.int64) ** 2).sum(axis=1) * s * s
    between = squares(qk, qs)[:, None] + squares(ck, cs)[None, :] - 2 * (qs[:, None] * cs[None, :]) * _product(qk, ck)
    between = np.sqrt(np.maximum(between, 0))
    # Rounding of the sums above: far below 1e-6 of the lengths that take part.
    slack = qe[:, None] + ce[None, :] + 1e-6 * (np.sqrt(squares(qk, qs))[:, None] + np.sqrt(squares(ck, cs))[None, :])
    other = qid[:, None] != cid[None, :]
    out: list[tuple[int, int, float]] = []
    for i in range(len(q)):
        upper = (between[i] + slack[i])[other[i]]
        if not len(upper):
            continue
        bar = np.partition(upper, k - 1)[k - 1] if len(upper) > k else np.inf
        near = np.flatnonzero(other[i] & (between[i] - slack[i] <= bar))
        exact = distance(np.broadcast_to(q[i], (len(near), q.shape[1])), c[near])
        out += [(int(qid[i]), int(v), float(d)) for d, v in heapq.nsmallest(k, zip(exact.tolist(), cid[near].tolist()))]
    return out


def _rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    vectors = table.column("vector").combine_chunks()
    ids, x = table.column("vec_id").to_numpy(), vectors.flatten().to_numpy().reshape(len(vectors), -1)
    seen = {(int(i), row.tobytes()): at for at, (i, row) in reversed(list(enumerate(zip(ids, x))))}
    if len(seen) < len(ids):  # equal rows have equal ids, so they all lie in this block
        once = sorted(seen.values())
        ids, x = ids[once], x[once]
    return ids, x


def nearest(vectors: DataFrame, queries: Column, k: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other vectors of every vector that ``queries`` selects."""
    valid = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"),
        F.size("embedding").alias("dimensions"), queries.alias("asks"),
    )
    sizes = valid.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    blocks = max(1, -(-sizes["n"] // CANDIDATE_BLOCK))
    query_blocks = max(1, -(-sizes["q"] // QUERY_BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    asked = valid.where("asks").withColumn("qb", own(query_blocks)).withColumn("cb", every(blocks))
    candidates = valid.withColumn("cb", own(blocks)).withColumn("qb", every(query_blocks))

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            found = tile_neighbours(*_rows(left), *_rows(right), k)
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
            names=["query_id", "vec_id", "score"],
        )

    keys = ["dimensions", "qb", "cb"]
    heaps = asked.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(tile, _TILE)
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return heaps.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
