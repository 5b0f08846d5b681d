"""Best-fit packing of tokenised documents into sequences of fixed length, by linear grouping.

Pieces longer than ``CAPACITY / SMALL_PART`` are large. Ordered by length they are cut into groups of equal cardinality
and rounded up to their group's longest. For these few sizes, configurations (how many of each share a sequence) are
optimised by column generation on the fractional problem, rounded down, and the rest is filled greedily. Documents then
take the slots of their group by rank, and small pieces go best-fit, longest first, into the space really left.

Only the counts per length (at most ``CAPACITY`` numbers) reach the driver, and the plan that returns is a table of rank
ranges whose size depends on the number of lengths, not of documents. Ranks are distributed prefix sums, so a length
that a third of all documents share is spread like any other.

Defined cases: a null or empty text is the end token alone; repeated rows and ids are separate documents; an empty
table gives an empty result. Columns other than doc_id and text do not matter.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cohortlens.llm.common import at_work, hash_key, keeps, prefix_sums
from cohortlens.sources.scratch import written

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k.json"
#: The same vocabulary as ranks, by which single words are encoded several times faster; None uses the tokenizer alone.
RANKS = "byte_bpe_50k.tiktoken"
END_ID = 0
#: Pieces up to this part of a sequence are small.
SMALL_PART = 8
#: Groups that the large pieces are rounded in.
GROUPS = 192
_REMEMBERED = 200_000
#: A space next to other white space; its tokens depend on more than the word that follows.
_WIDE_SPACE = re.compile(r" \s|\s ")

class _Words:
    """A tokenizer for texts, and for many words at once by its ranks."""

    def __init__(self, name: str, ranks: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        place = lambda n: n if os.path.isabs(n) else public_tokenizers.path(n)
        self.whole = Tokenizer.from_file(place(name))
        #: Special tokens whose strings the tokenizer finds in texts; none holds white space.
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.by_rank = None
        if ranks:
            with open(place(ranks), "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.by_rank = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
            self.starts = np.zeros(max(table.values()) + 1, bool)
            self.starts[[i for t, i in table.items() if t.startswith(b" ")]] = True

    def text(self, text: str) -> bytes:
        return _packed(self.whole.encode(text, add_special_tokens=False).ids)

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of words that begin with a space and hold no other; joined, every word starts with such a token."""
        if self.by_rank is None:
            return [_packed(e.ids) for e in self.whole.encode_batch(words, add_special_tokens=False)]
        out: list[bytes] = []
        for at in range(0, len(words), 2000):
            part = words[at : at + 2000]
            ids = np.array(self.by_rank.encode_ordinary("".join(part)), "<u4")
            first = np.flatnonzero(self.starts[ids])
            if len(first) == len(part):
                data, cuts = ids.tobytes(), [*(4 * first).tolist(), 4 * len(ids)]
                out += [data[a:b] for a, b in zip(cuts, cuts[1:])]
            else:
                out += [self.text(w) for w in part]
        return out


_tokenizers: dict[tuple[str, str | None], _Words] = {}


def _tokenizer(name: str, ranks: str | None) -> _Words:
    if (name, ranks) not in _tokenizers:
        _tokenizers[name, ranks] = _Words(name, ranks)
    keeps("packing", _tokenizers.clear)
    return _tokenizers[name, ranks]


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def encode(texts: list[str | None], name: str = TOKENIZER, ranks: str | None = RANKS) -> list[bytes]:
    """Token ids of whole texts as little-endian 32-bit numbers, the end id last.

    The tokenizer starts a new piece at every space before a word, so ids of a text are those of its space-separated
    words, each with its space; words are looked up and only unknown ones are encoded. Texts with wider white space or
    the string of a special token, which becomes that token, are encoded as they are.
    """
    own = _tokenizer(name, ranks)
    known = own.known
    if len(known) > _REMEMBERED:
        known.clear()
    split = [t.split(" ") if t and not _WIDE_SPACE.search(t) and not any(s in t for s in own.special) else None for t in texts]
    unknown = set().union(*[s[1:] for s in split if s]).difference(known)
    new = list(unknown)
    known.update(zip(new, own.words([" " + w for w in new])))
    end, out = _packed([END_ID]), []
    for text, words in zip(texts, split):
        if words is None:
            out.append(own.text(text) + end if text else end)
        else:
            first = own.text(words[0]) if words[0] else b""
            out.append(first + b"".join(map(known.__getitem__, words[1:])) + end)
    for w in new:
        if len(w) > 64:
            del known[w]
    return out


def pieces(
    docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, with_ids: bool = False, ranks: str | None = RANKS
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and the ids): documents longer than a sequence are cut, the first piece
    being the shorter one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("packing")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows: list[tuple] = []
                for i, ids in enumerate(encode(part.column(1).to_pylist(), tokenizer, ranks)):
                    n = len(ids) // 4
                    first = n % capacity or min(n, capacity)
                    for k, start in enumerate([0, *range(first, n, capacity)]):
                        own = ids[4 * start : 4 * (start + (capacity if k else first))]
                        rows.append((i, k, start, len(own) // 4, zlib.crc32(own), own if with_ids else None))
                at_row, *columns = zip(*rows)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 4 + with_ids]
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at_row)), *arrays],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids],
                )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _best_configuration(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, list[int]]:
    """The most valuable multiset of sizes that fits (unbounded knapsack, one item at a time)."""
    best = np.zeros(capacity + 1)
    choices = []
    while True:
        more, choice = best.copy(), np.full(capacity + 1, -1)
        for i, s in enumerate(sizes):
            if values[i] > 0:
                gained = best[: capacity + 1 - s] + values[i]
                better = gained > more[s:] + 1e-12
                more[s:][better] = gained[better]
                choice[s:][better] = i
        if (choice < 0).all():
            break
        choices.append(choice)
        best = more
    left, counts = capacity, [0] * len(sizes)
    for choice in reversed(choices):
        if choice[left] >= 0:
            counts[choice[left]] += 1
            left -= sizes[choice[left]]
    return float(best[capacity]), counts


def configurations(sizes: list[int], demand: list[int], capacity: int, most_rounds: int = 400) -> list[tuple[tuple[int, ...], int]]:
    """Configurations with how often each is used, covering the demand: column generation, then greedy filling."""
    k = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, float)
    for _ in range(most_rounds):
        prices = np.linalg.solve(basis.T, np.ones(k))
        value, counts = _best_configuration(sizes, prices, capacity)
        if value <= 1 + 1e-7:
            break
        direction = np.linalg.solve(basis, np.array(counts, float))
        level = np.linalg.solve(basis, need)
        steps = np.where(direction > 1e-9, np.maximum(level, 0) / np.where(direction > 1e-9, direction, 1), np.inf)
        basis[:, int(np.argmin(steps))] = counts
    level = np.floor(np.maximum(np.linalg.solve(basis, need), 0) + 1e-9).astype(int)
    used: dict[tuple[int, ...], int] = defaultdict(int)
    left = list(demand)
    for column, times in zip(basis.T.round().astype(int), level):
        if times:
            used[tuple(int(c) for c in column)] += int(times)
            left = [max(0, a - int(c) * int(times)) for a, c in zip(left, column)]
    while any(left):
        space, counts = capacity, [0] * k
        for i in sorted(range(k), key=lambda i: -sizes[i]):
            counts[i] = min(left[i], space // sizes[i])
            space -= counts[i] * sizes[i]
        times = min(a // c for a, c in zip(left, counts) if c)
        used[tuple(counts)] += times
        left = [a - c * times for a, c in zip(left, counts)]
    return list(used.items())


@dataclass
class Ranges:
    """Where ranks of a class go: ranks from ``low`` on fill bins from ``first`` on, ``each`` of them per bin."""

    cls: list[int]
    low: list[int]
    space: list[int]
    first: list[int]
    each: list[int]

    @staticmethod
    def empty() -> Ranges:
        return Ranges([], [], [], [], [])

    def add(self, cls: int, low: int, space: int, first: int, each: int) -> None:
        for column, v in zip((self.cls, self.low, self.space, self.first, self.each), (cls, low, space, first, each)):
            column.append(v)

    def lookup(self):
        """A function from arrays of classes and ranks to arrays of spaces and bins."""
        order = np.lexsort((self.low, self.cls))
        c, low, space, first, each = (np.array(x, np.int64)[order] for x in (self.cls, self.low, self.space, self.first, self.each))
        starts = np.searchsorted(c, np.arange(int(c.max()) + 2))

        def find(classes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = np.empty(len(classes), np.int64)
            for one in np.unique(classes):
                rows, a, b = classes == one, starts[one], starts[one + 1]
                at[rows] = a + np.searchsorted(low[a:b], ranks[rows], side="right") - 1
            return space[at], first[at] + (ranks - low[at]) // each[at]

        return find


def large_plan(lengths: dict[int, int], capacity: int, groups: int = GROUPS):
    """Slots for large pieces: a function from lengths and ranks within the length to sequences, and their number."""
    total = sum(lengths.values())
    per = max(1, -(-total // groups))
    sizes, demand, seen = [], [], 0
    for length in sorted(lengths, reverse=True):
        while len(sizes) * per < seen + lengths[length]:
            sizes.append(length)
            demand.append(min(per, total - (len(sizes) - 1) * per))
        seen += lengths[length]
    out, base = Ranges.empty(), 0
    filled = [0] * len(sizes)
    merged: dict[int, list[int]] = defaultdict(list)
    for i, s in enumerate(sizes):
        merged[s].append(i)
    distinct = sorted(merged, reverse=True)
    used = configurations(distinct, [sum(demand[i] for i in merged[s]) for s in distinct], capacity) if sizes else []
    # Groups of one rounded size share their slots: they count as one class, numbered by their first group.
    for counts, times in used:
        for s, c in zip(distinct, counts):
            if c:
                first = merged[s][0]
                out.add(first, filled[first], 0, base, c)
                filled[first] += c * times
        base += times
    class_of = np.repeat([merged[s][0] for s in distinct], [len(merged[s]) for s in distinct])
    longer = np.zeros(capacity + 1, np.int64)
    for n, c in lengths.items():
        longer[:n] += c
    find = out.lookup()

    def sequence(own: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        overall = longer[own] + ranks
        classes = class_of[overall // per]
        return find(classes, overall - classes * per)[1]

    return sequence, base


def small_plan(lengths: dict[int, int], spaces: dict[int, int], capacity: int) :
    """Best fit, longest first, over counts: a function from lengths and ranks to bins (space, ordinal), space -1 meaning
    a new sequence, and the number of new ones."""
    out, opened = Ranges.empty(), 0
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # space left -> (space at first, first bin, end)
    for space, n in spaces.items():
        runs[space].append((space, 0, n))
    for length in sorted(lengths, reverse=True):
        left, rank = lengths[length], 0
        space = length
        while left:
            while space <= capacity and not runs.get(space):
                space += 1
            if space > capacity:
                n = -(-left // (capacity // length))
                runs[capacity].append((-1, opened, opened + n))
                opened += n
                space = capacity
            origin, first, end = runs[space].pop()
            n = min(left, end - first)
            if first + n < end:
                runs[space].append((origin, first + n, end))
            out.add(length, rank, origin, first, 1)
            rank, left = rank + n, left - n
            runs[space - length].append((origin, first, first + n))
            space = space - length if space - length >= length else space
    return out.lookup(), opened


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to the table of ``pieces``."""
    columns = cut.columns
    keyed = written(cut.withColumn("__key", hash_key("pack", F.col("doc_id"), F.col("piece"))), "pieces")
    counts = {r["length"]: r["count"] for r in keyed.groupBy("length").count().collect()}
    large = {n: c for n, c in counts.items() if n > capacity // SMALL_PART}
    small = {n: c for n, c in counts.items() if n not in large}
    ranked = prefix_sums(keyed.withColumn("__one", F.lit(1)), ["length"], "__key", ["doc_id", "piece"], {"__rank": "__one"})
    ranked = ranked.drop("__one")
    done, sequences = None, 0
    if large:
        sequence, sequences = large_plan(large, capacity)

        @F.arrow_udf("long")
        def slot(own: pa.Array, ranks: pa.Array) -> pa.Array:
            return pa.array(sequence(own.to_numpy(), ranks.to_numpy()))

        done = ranked.where(F.col("length") > capacity // SMALL_PART).withColumn("sequence_id", slot("length", "__rank"))
        done = written(done.select(*columns, "sequence_id", "__key"), "large")
    if small:
        spaces: dict[int, int] = {}
        bins = None
        if done is not None:
            bins = done.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).alias("space")).where("space > 0")
            bins = written(bins.withColumn("__key", hash_key("bins", F.col("sequence_id"))).withColumn("__one", F.lit(1)), "bins")
            spaces = {r["space"]: r["count"] for r in bins.groupBy("space").count().collect()}
        find, _ = small_plan(small, spaces, capacity)

        @F.arrow_udf("space long, bin long")
        def fit(own: pa.Array, ranks: pa.Array) -> pa.Array:
            return pa.StructArray.from_arrays([pa.array(x) for x in find(own.to_numpy(), ranks.to_numpy())], names=["space", "bin"])

        to = ranked.where(F.col("length") <= capacity // SMALL_PART).withColumn("__to", fit("length", "__rank"))
        to = written(to.select(*columns, "__key", "__to.*"), "small")
        new = to.where("space = -1").withColumn("sequence_id", F.col("bin") + sequences).select(*columns, "sequence_id", "__key")
        parts = [new]
        if bins is not None:
            ordinal = prefix_sums(bins, ["space"], "__key", ["sequence_id"], {"bin": "__one"}).select("space", "bin", "sequence_id")
            parts.append(to.where("space <> -1").join(ordinal, ["space", "bin"]).select(*columns, "sequence_id", "__key"))
        for part in parts:
            done = part if done is None else done.unionByName(part)
    if done is None:
        return keyed.select(*columns, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    inside = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "__key", "doc_id", "piece")
    before = F.coalesce(F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return done.withColumn("offset", before.cast("long")).select(*columns, "sequence_id", "offset")


def packed(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, tokenizer, capacity), capacity)


def sequences(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """The packed token sequences themselves: sequence_id, ids (little-endian 32-bit numbers), doc_ids in order."""
    whole = pack(pieces(docs, tokenizer, capacity, with_ids=True), capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return whole.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(b""), lambda joined, p: F.concat(joined, p["ids"])).alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"),
    )
