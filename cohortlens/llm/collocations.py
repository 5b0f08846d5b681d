"""Phrase collocations from count streams kept in prefix and in suffix order.

Counting. A phrase can only be frequent if the two phrases one word shorter in it are. Occurrences of two-word phrases
are first counted in a table of cells, then those of three-word phrases whose parts may be frequent; a phrase
whose cell has too few is skipped. Whatever the tables let through, also by chance, is counted as it is and dropped by
its count: the streams of frequent phrases are exact, and a crowded table costs time only. So that it does not crowd, a
table has cells in proportion to the bytes of the texts, up to ``MOST_CELLS``. A task hands on the cells it met, and the
tables go to the tasks as bits.

Estimation. The stream of all phrases, sorted by (language, last word, last but one, ...), is read once: a phrase's
endings lie on the path above it, so one stack of at most ``LONGEST`` entries hands it the counts of all its endings
(the right parts), and the largest count of the phrases that add a word to its left. Sorted by (language, first word,
second, ...) it is read again for its beginnings (the left parts) and for words added to its right. These are lockstep
merges of sorted streams: no table of phrases is kept or looked up. A longer phrase around a phrase contains one that
adds a single word and is at least as frequent, so words added on either side decide whether a phrase is dropped.

The sorted streams are cut at sampled bounds, and the few phrases above a bound go to both sides of it, so a word that
starts a third of all phrases is spread over many tasks. The best of each language are cut off in every task first.

Words are what spaces and tabs separate within pieces of a text, A-Z in lower case.

Defined cases: null and empty texts have no words; a null language is ``und``, like the language of that name; repeated
rows count as often as they occur; equal scores are ordered by count, then by the phrase's UTF-8 bytes; a very long text
is counted at once; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
import xxhash

from cohortlens.llm.common import at_work, hash_key
from cohortlens.operators.joins import attach
from cohortlens.sources.scratch import written

LONGEST = 4
LEAST_COUNT = 30
#: A longer phrase with this share of a phrase's occurrences, in hundredths, replaces it.
CONTAINED = 80
SCALE = 2_000_000
BEST = 2000
#: Cells of a table at least and at most (a bit each in every task), bytes of text per cell, and cells that are added up as one row.
CELLS = 1 << 23
MOST_CELLS = 1 << 29
BYTES_PER_CELL = 40
_CELL_ROW = 1 << 16
#: Met cells that a task holds before it hands them on.
_HELD_CELLS = 1 << 22
#: Words that a task counts at once, and rows of a batch it hands on.
CHUNK_WORDS = 1 << 20
_BATCH_ROWS = 1 << 16
#: Phrases between two bounds of a sorted stream, and bounds at most.
BOUND_ROWS = 100_000
MOST_BOUNDS = 2_000
_SAMPLED = 16

#: Signs that end a piece become full stops, which no word holds.
_PIECE_BYTES = bytes(46 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_and_stops(texts: list[bytes]) -> pa.DictionaryArray:
    """The words of UTF-8 texts by number, with a full stop, which has the number 0, around every piece."""
    marked = b".".join([b"", *texts, b""]).translate(_PIECE_BYTES).replace(b".", b" . ").strip()
    whole = pa.LargeStringArray.from_buffers(1, pa.py_buffer(np.array([0, len(marked)], np.int64)), pa.py_buffer(marked))
    return pc.ascii_split_whitespace(whole).values.dictionary_encode()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD
    return x ^ (x >> np.uint64(29))


def _counted(ids: np.ndarray, length: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A position and the number of every distinct phrase among those that start at the given positions."""
    if not len(at):
        return at, at
    key, bits = ids[at].astype(np.uint64), int(ids.max()).bit_length()
    used = bits
    for k in range(1, length):
        if used + bits > 64:
            key = np.unique(key, return_inverse=True)[1].ravel().astype(np.uint64)
            used = len(at).bit_length()
        key, used = key << np.uint64(bits) | ids[at + k].astype(np.uint64), used + bits
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return at[order[new]], np.diff(np.append(new, len(key)))


class _Chunk:
    """Words of one language's texts, as numbers."""

    def __init__(self):
        self.texts, self.size = [], 0

    def add(self, text: bytes) -> int:
        """Take a text; about how many words it has."""
        own = text.count(b" ") + 1
        self.texts.append(text)
        self.size += own
        return own

    def settle(self, lang: str, cells: int) -> None:
        found = words_and_stops(self.texts)
        self.ids, self.words, self.texts = found.indices.to_numpy(), found.dictionary, []
        self.lang, self.cells = lang, np.uint64(cells)
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words.cast(pa.large_binary()).to_pylist()], np.uint64)
        self.hashes = hashes[self.ids]
        stops = np.flatnonzero(self.ids == 0)
        self.left = np.repeat(stops, np.diff(stops, prepend=-1)) - np.arange(len(self.ids))

    def at_cells(self, length: int, at: np.ndarray) -> np.ndarray:
        out = np.full(len(at), xxhash.xxh3_64_intdigest(self.lang), np.uint64)
        for k in range(length):
            out = _mixed(out * np.uint64(5) + self.hashes[at + k])
        return (out % self.cells).astype(np.int64)

    def starts(self, length: int, tables: list[np.ndarray]) -> np.ndarray:
        """Where phrases start that may be frequent by the tables of two words, three words, ..."""
        if length == 1:
            return np.flatnonzero(self.left > 0)
        if length > 2:
            shorter = np.zeros(len(self.ids) + 1, bool)
            shorter[self.starts(length - 1, tables)] = True
            at = np.flatnonzero(shorter[:-1] & shorter[1:])
        else:
            at = np.flatnonzero(self.left >= length)
        return at[_has(tables[length - 2], self.at_cells(length, at))] if length - 2 < len(tables) else at

    def rows(self, lengths: tuple[int, ...], tables: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for length in lengths:
            first, n = _counted(self.ids, length, self.starts(length, tables))
            for i in range(0, len(first), _BATCH_ROWS):
                own = first[i : i + _BATCH_ROWS]
                parts = [self.words.take(pa.array(self.ids[own + k])) for k in range(length)]
                phrases = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if length > 1 else parts[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(self.lang, len(own)), phrases.cast(pa.string()), pa.array(n[i : i + _BATCH_ROWS])],
                    names=["lang", "phrase", "n"],
                )


def _chunks(batches: Iterator[pa.RecordBatch], cells: int, chunk_words: int) -> Iterator[_Chunk]:
    """A task's texts by language, in chunks; a very long text is a chunk of its own."""
    held: dict[str, _Chunk] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            size += held.setdefault(lang, _Chunk()).add(text.as_py())
            if size >= chunk_words:
                largest = max(held, key=lambda k: held[k].size)
                chunk = held.pop(largest)
                size -= chunk.size
                chunk.settle(largest, cells)
                yield chunk
    for lang in list(held):
        chunk = held.pop(lang)
        chunk.settle(lang, cells)
        yield chunk


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("length(text) > 0")


def cells_for(docs: DataFrame) -> int:
    """Cells of a table for these texts: few phrases share one unless the texts are many times ``MOST_CELLS``."""
    size = _texts(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(MOST_CELLS, max(CELLS, 1 << (size // BYTES_PER_CELL).bit_length()))


class _Tables:
    """Bits of the cells with enough occurrences, for two words, three words, ..."""

    def __init__(self, spark: SparkSession, tables: list[np.ndarray]):
        self.shared = [spark.sparkContext.broadcast(t.tobytes()) for t in tables]

    def read(self) -> list[np.ndarray]:
        return [np.frombuffer(b.value, np.uint8) for b in self.shared]


def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return bits[at >> 3] << (at & 7).astype(np.uint8) & 128 > 0


def _added(found: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Cells in order, each once, with their counts added up, to 255 at most."""
    cell, n = np.concatenate(found), np.concatenate(counts)
    order = np.argsort(cell, kind="stable")
    cell, n = cell[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    return cell[new], np.minimum(np.add.reduceat(n, new, dtype=np.int64), 255).astype(np.uint8)


def _cell_rows(cell: np.ndarray, n: np.ndarray, row: int) -> Iterator[pa.RecordBatch]:
    """Met cells in order as rows: the first cell of each run of ``row`` cells, places of two bytes in it, their counts."""
    which = cell // row
    first = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]]))
    ends = np.append(first, len(cell)).astype(np.int32)
    places = pa.py_buffer((cell - which * row).astype(np.uint16))
    at = pa.array(which[first] * row)
    where = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends * 2), places])
    counts = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(n)])
    yield from pa.table([at, where, counts], names=["row", "places", "counts"]).to_batches(_BATCH_ROWS)


def cell_table(docs: DataFrame, length: int, tables: list[np.ndarray], least: int, cells: int = CELLS, chunk_words: int = CHUNK_WORDS) -> np.ndarray:
    """Bits of the cells that hold at least ``least`` occurrences of phrases of that length."""
    known = _Tables(docs.sparkSession, tables)
    enough, row = min(least, 255), min(_CELL_ROW, cells)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("collocations")
        own, found, counts = known.read(), [], []
        for chunk in _chunks(batches, cells, chunk_words):
            cell, n = np.unique(chunk.at_cells(length, chunk.starts(length, own)), return_counts=True)
            found.append(cell)
            counts.append(np.minimum(n, 255).astype(np.uint8))
            if sum(map(len, found)) >= _HELD_CELLS:
                yield from _cell_rows(*_added(found, counts), row)
                found, counts = [], []
        if sum(map(len, found)):
            yield from _cell_rows(*_added(found, counts), row)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches:
            for i, places, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if i != now:
                    if now is not None:
                        yield said(now, total)
                    now, total = i, np.zeros(row, np.int64)
                total[np.frombuffer(places.as_buffer(), np.uint16)] += np.frombuffer(counts.as_buffer(), np.uint8)
        if now is not None:
            yield said(now, total)

    def said(i: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([i]), pa.array([np.packbits(total >= enough).tobytes()])], names=["row", "bits"])

    parts = _texts(docs).mapInArrow(count, "row long, places binary, counts binary")
    added = parts.repartition("row").sortWithinPartitions("row").mapInArrow(add, "row long, bits binary")
    table = np.zeros(-(-cells // 8), np.uint8)
    for i, bits in added.collect():
        table[i // 8 : i // 8 + len(bits)] = np.frombuffer(bits, np.uint8)
    return table


def phrase_counts(docs: DataFrame, lengths: tuple[int, ...], tables: list[np.ndarray], cells: int = CELLS, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """(lang, phrase, n): numbers of the phrases of these lengths that may be frequent by the tables."""
    known = _Tables(docs.sparkSession, tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("collocations")
        own = known.read()
        for chunk in _chunks(batches, cells, chunk_words):
            yield from chunk.rows(lengths, own)

    return _texts(docs).mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, least: int = LEAST_COUNT, cells: int | None = None, chunk_words: int = CHUNK_WORDS) -> tuple[DataFrame, DataFrame]:
    """((lang, words, n) of all phrases with at least so many occurrences, (lang, total) words of each language)."""
    cells = cells or cells_for(docs)
    tables: list[np.ndarray] = []
    for length in range(2, LONGEST):
        tables.append(cell_table(docs, length, tables, least, cells, chunk_words))
    is_single = ~F.contains("phrase", F.lit(" "))
    counted = phrase_counts(docs, tuple(range(1, LONGEST + 1)), tables, cells, chunk_words)
    # All words stay, for the languages' totals; rare longer phrases are of no use.
    counted = written(counted.where(is_single | (F.col("n") >= least)), "phrases")
    single = counted.where(is_single)
    stream = counted.where(F.col("n") >= least).select("lang", F.split("phrase", " ").alias("words"), "n")
    return stream, single.groupBy("lang").agg(F.sum("n").alias("total"))


class _Last:
    """Comes after every word."""

    def __lt__(self, other) -> bool:
        return False

    def __gt__(self, other) -> bool:
        return True


def _bounds(stream: DataFrame, bound_rows: int) -> list[tuple[str, tuple[str, ...]]]:
    """Bounds that cut the stream into parts of about equal size, from a sample of bounded size."""
    parts = min(MOST_BOUNDS, stream.count() // bound_rows + 1)
    if parts == 1:
        return []
    sample = stream.select("lang", "path").orderBy(hash_key("bound", F.col("lang"), F.array_join("path", " "))).limit(_SAMPLED * parts)
    found = sorted((r["lang"], tuple(r["path"])) for r in sample.collect())
    return sorted(set(found[_SAMPLED::_SAMPLED]))


def sorted_stream(stream: DataFrame, path: Column, bound_rows: int = BOUND_ROWS) -> DataFrame:
    """The stream in order of (lang, path), in parts; a row whose longer phrases a bound divides stands in each of those."""
    rows = stream.withColumn("path", path)
    bounds = _bounds(rows, bound_rows)

    @F.arrow_udf("array<int>")
    def parts(langs: pa.Array, paths: pa.Array) -> pa.Array:
        out = []
        for lang, own in zip(langs.to_pylist(), paths.to_pylist()):
            first = bisect_right(bounds, (lang, tuple(own)))
            out.append(list(range(first, bisect_right(bounds, (lang, (*own, _Last()))) + 1)))
        return pa.array(out, pa.list_(pa.int32()))

    placed = rows.withColumn("part", F.explode(parts("lang", "path")) if bounds else F.lit(0))
    return placed.repartition("part").sortWithinPartitions("part", "lang", "path")


def _lockstep(batches: Iterator[pa.RecordBatch], carried: int) -> Iterator[tuple]:
    """(lang, path, n, counts of the path's beginnings, largest count of a phrase one word longer, carried values) of
    every row of sorted batches; equal rows are one, with the largest of their last carried values."""
    stack: list[list] = []  # path, n, largest longer count, carried values
    where: tuple | None = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("part", "lang", "path", "n")]
        extra = [batch.column(batch.num_columns - carried + c).to_pylist() for c in range(carried)]
        for part, lang, path, n, *values in zip(*columns, *extra):
            while stack and (where != (part, lang) or path[: len(stack[-1][0])] != stack[-1][0]):
                own = stack.pop()
                yield where[1], own[0], own[1], [e[1] for e in stack], own[2], own[3]
            where = part, lang
            if stack and stack[-1][0] == path:
                if carried:
                    stack[-1][3][-1] = max(stack[-1][3][-1], values[-1])
                continue
            if stack:
                stack[-1][2] = max(stack[-1][2], n)
            stack.append([path, n, 0, values])
    while stack:
        own = stack.pop()
        yield where[1], own[0], own[1], [e[1] for e in stack], own[2], own[3]


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, 10_000)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


_ENDED = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("n", pa.int64()), ("rights", pa.list_(pa.int64())), ("longer", pa.int64())])
_RATED = pa.schema([(c, pa.string() if c in ("lang", "phrase") else pa.int64()) for c in ("lang", "phrase", "a", "l", "r", "score", "longer")])


def _suffix_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((lang, path[::-1], n, counts, longer) for lang, path, n, counts, longer, _ in _lockstep(batches, 0))
    return _batched(rows, _ENDED)


def _prefix_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for lang, words, a, lefts, longer, (rights, longer_left) in _lockstep(batches, 2):
            if len(words) > 1:
                cuts = [(SCALE * a // (x + y), k, x, y) for k, (x, y) in enumerate(zip(lefts, reversed(rights)))]
                score, _, x, y = min(cuts)
                yield lang, " ".join(words), a, x, y, score, max(longer, longer_left)

    return _batched(rows(), _RATED)


def rated_phrases(stream: DataFrame, bound_rows: int = BOUND_ROWS) -> DataFrame:
    """(lang, phrase, a, l, r, score, longer) of all phrases of two words or more in a complete stream."""
    ended = sorted_stream(stream, F.reverse("words"), bound_rows).mapInArrow(
        _suffix_pass, "lang string, words array<string>, n long, rights array<long>, longer long"
    )
    ended = written(ended, "suffix-stream")
    begun = sorted_stream(ended, F.col("words"), bound_rows).select("part", "lang", "path", "n", "rights", "longer")
    rated = begun.mapInArrow(_prefix_pass, "lang string, phrase string, a long, l long, r long, score long, longer long")
    # A phrase above a bound comes from several parts, each of which saw some of the longer phrases.
    return rated.groupBy("lang", "phrase", "a", "l", "r", "score").agg(F.max("longer").alias("longer"))


def collocations(docs: DataFrame, least: int = LEAST_COUNT, best: int = BEST, bound_rows: int = BOUND_ROWS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first phrases."""
    stream, totals = frequent_phrases(docs, least)
    kept = rated_phrases(stream, bound_rows).where(100 * F.col("longer") < CONTAINED * F.col("a"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    named = attach(ranked, totals, ["lang"])
    return named.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
