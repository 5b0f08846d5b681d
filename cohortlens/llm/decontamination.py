"""Benchmark decontamination by suffix arrays over the training documents.

Documents are read in shards of about ``SHARD_WORDS`` words. A shard's words become numbers (0 for a word that no
benchmark text holds, and after each document), and its suffix array orders all positions of known words by what follows
them: by as many first words as fit into one 64-bit key, then by prefix doubling among those still equal. Every suffix
of every benchmark text is binary-searched in it, one word deeper at a time, until no position is left. That gives its
longest verbatim match with all locations, and on the way the locations of its window: the positions that share
``WINDOW`` words with it. A text of fewer words, but not none, is one window.

The benchmark goes to the tasks in blocks of at most ``BLOCK_WORDS`` words (or one text, if longer); each block is one
pass over the documents, whose rows carry what earlier passes found. Nothing is shuffled.

Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case.

Defined cases: a null or empty text, of a document or of the benchmark, has no words and matches nothing; repeated rows
are documents of their own and get equal results; repeated benchmark rows count by their ``item_id``, those without id
mark words but are not listed; of equally long matches the one with the smallest place in the document is named, then
that with the smallest id; a very long text is one shard of its own; an empty table gives an empty result, an empty
benchmark no matches. Other columns are passed on and do not matter.
"""

from __future__ import annotations

import array
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from cohortlens.llm.common import at_work, keeps
from cohortlens.sources.scratch import written

#: Words of a window.
WINDOW = 10
#: Words after which a shard is closed, and words of the benchmark that are searched in one pass.
SHARD_WORDS = 1 << 19
BLOCK_WORDS = 1 << 21

_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 0x80 or chr(c).isdigit() or 97 <= c <= 122 else 32 for c in range(256)
)
#: What a pass adds to a document.
_FOUND = {
    "__n_words": "long",
    "__spans": "array<struct<start: int, stop: int>>",
    "__items": "array<string>",
    "__longest": "struct<words: int, start: int, item: string, item_start: int>",
}


def words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text."""
    return text.translate(_WORD_BYTES).split() if text else []


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions of all numbers but 0, ordered by the up to ``depth`` numbers from there to the next 0."""
    n = len(ids)
    bits = max(1, int(ids.max(initial=0)).bit_length())
    h = max(1, min(depth, 62 // bits))
    padded = np.concatenate([ids, np.zeros(h, ids.dtype)])
    at = np.flatnonzero(ids)
    if not len(at):
        return at
    key, going = np.zeros(len(at), np.int64), np.ones(len(at), bool)
    for d in range(h):
        word = padded[at + d]
        going &= word > 0
        key = key << bits | np.where(going, word, 0)
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    ends = np.flatnonzero(np.concatenate([ids, [0]]) == 0)
    run = ends[np.searchsorted(ends, at)] - at
    place = np.arange(len(at))
    rank = np.zeros(n + 1, np.int64)
    while True:
        group = np.maximum.accumulate(np.where(first, place, 0))
        alone = first & np.concatenate([first[1:], [True]])
        tied = np.flatnonzero(~alone & (run >= h))
        if h >= depth or not len(tied):
            return at
        rank[at] = group + 1
        own = at[tied]
        pair = group[tied] * (n + 2) + rank[own + h]
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        at[tied], run[tied] = own[order], run[tied][order]
        first[tied[1:]] |= pair[1:] != pair[:-1]
        h *= 2


class Block:
    """Benchmark texts as numbers, with a row per suffix: where it starts, how long it is, which window it begins."""

    def __init__(self, texts: list[tuple[str | None, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        number, ids, start, room = self.vocabulary, [], [], []
        self.names = [name for name, _ in texts]
        owner: list[int] = []
        for item, (_, own) in enumerate(texts):
            start += range(len(ids), len(ids) + len(own))
            room += range(len(own), 0, -1)
            owner += [item] * len(own)
            ids += [number.setdefault(w, len(number) + 1) for w in own]
            ids.append(0)
        self.ids = np.array(ids, np.int32)
        self.start, self.room = np.array(start, np.int64), np.array(room, np.int64)
        self.owner = np.array(owner, np.int64)
        whole = np.zeros(len(texts), np.int64)
        np.maximum.at(whole, self.owner, self.room)
        size = np.minimum(whole, window)[self.owner] if len(owner) else self.room
        self.size = np.where(self.room >= size, size, 0)
        self.depth = int(self.room.max(initial=1))

    def search(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per suffix: range of the suffix array (low, high) and length of its longest match, and range of its window."""
        n = len(self.start)
        padded = np.concatenate([ids, np.zeros(self.depth + 1, ids.dtype)])
        low, high, length = np.zeros(n, np.int64), np.full(n, len(at), np.int64), np.zeros(n, np.int64)
        window_low, window_high = np.zeros(n, np.int64), np.zeros(n, np.int64)
        live = np.arange(n) if len(at) else np.empty(0, np.int64)
        depth = 0
        while len(live):
            word = self.ids[self.start[live] + depth]
            a = _bound(padded, at, depth, low[live], high[live], word)
            b = _bound(padded, at, depth, a, high[live], word + 1)
            met = a < b
            live, depth = live[met], depth + 1
            low[live], high[live], length[live] = a[met], b[met], depth
            full = live[self.size[live] == depth]
            window_low[full], window_high[full] = low[full], high[full]
            live = live[self.room[live] > depth]
        return low, high, length, window_low, window_high


def _bound(ids: np.ndarray, at: np.ndarray, depth: int, low: np.ndarray, high: np.ndarray, word: np.ndarray) -> np.ndarray:
    """First place of each range whose number at ``depth`` is not below ``word``."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) >> 1
        below = ids[at[middle] + depth] < word[open_]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges, and the range of each."""
    sizes = high - low
    which = np.repeat(np.arange(len(low)), sizes)
    return np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes - low, sizes), which


class _Found:
    """What a block's search finds in the documents of one shard."""

    def __init__(self, block: Block, ids: np.ndarray, first: np.ndarray, window: int):
        at = suffix_array(ids, block.depth)
        low, high, length, window_low, window_high = block.search(ids, at)
        # Equal windows have one range: it is read once, for all texts that hold the window.
        occurring = np.flatnonzero(window_low < window_high)
        ranges, which = np.unique(np.stack([window_low, window_high, block.size])[:, occurring], axis=1, return_inverse=True)
        place, of = _spread(ranges[0], ranges[1])
        position = at[place]
        edges = np.zeros(len(ids) + 1, np.int64)
        np.add.at(edges, position, 1)
        np.add.at(edges, position + ranges[2][of], -1)
        self.hit = np.cumsum(edges)[:-1] > 0
        self.first = first
        owners = np.unique(np.stack([which.ravel(), block.owner[occurring]]), axis=1)
        cuts = np.searchsorted(owners[0], np.arange(ranges.shape[1] + 1))
        document = np.searchsorted(first, position, "right") - 1
        pairs = np.unique(document * max(1, ranges.shape[1]) + of)
        self.items: dict[int, list[str]] = {}
        by_document = pairs // max(1, ranges.shape[1])
        known: dict[bytes, list[str]] = {}
        for document_pairs in np.split(pairs, np.flatnonzero(np.diff(by_document)) + 1) if len(pairs) else []:
            held = document_pairs % ranges.shape[1]
            if held.tobytes() not in known:
                items = np.unique(np.concatenate([owners[1, cuts[r] : cuts[r + 1]] for r in held]))
                known[held.tobytes()] = sorted({block.names[i] for i in items if block.names[i] is not None})
            self.items[int(document_pairs[0]) // ranges.shape[1]] = known[held.tobytes()]
        self.longest = self._longest(block, at, low, high, length, window)

    def _longest(self, block, at, low, high, length, window) -> dict[int, tuple[int, int, str | None, int]]:
        long = np.flatnonzero(length >= np.minimum(window, np.where(block.size > 0, block.size, window)))
        # Of suffixes with the same longest match, the one of the smallest id speaks.
        names = ["" if n is None else n for n in block.names]
        order = np.array(sorted(long.tolist(), key=lambda i: (low[i], high[i], -length[i], names[block.owner[i]], block.start[i])), np.int64)
        if not len(order):
            return {}
        keep = np.concatenate([[True], (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])])
        order = order[keep]
        place, of = _spread(low[order], high[order])
        position, suffix = at[place], order[of]
        document = np.searchsorted(self.first, position, "right") - 1
        best = np.lexsort([position, -length[suffix], document])
        best = best[np.concatenate([[True], np.diff(document[best]) > 0])]
        out = {}
        for d, p, s in zip(document[best].tolist(), position[best].tolist(), suffix[best].tolist()):
            item_start = int(block.start[s] - block.start[np.searchsorted(block.owner, block.owner[s])])
            out[d] = (int(length[s]), int(p - self.first[d]), block.names[block.owner[s]], item_start)
        return out

    def spans(self, d: int) -> list[dict[str, int]]:
        own = self.hit[self.first[d] : self.first[d + 1] - 1].astype(np.int8)
        change = np.flatnonzero(np.diff(own, prepend=0, append=0)).tolist()
        return [{"start": a, "stop": b} for a, b in zip(change[::2], change[1::2])]


def _merged(a: list[dict] | None, b: list[dict]) -> list[dict[str, int]]:
    """Spans that at least one of two passes found."""
    out: list[dict[str, int]] = []
    for span in sorted([*(a or []), *b], key=lambda s: s["start"]):
        if out and span["start"] <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], span["stop"])
        else:
            out.append(dict(span))
    return out


_blocks: dict[str, Block] = {}


def _pass(rows: DataFrame, block: Block, window: int, shard_words: int, dropped: list[str]) -> DataFrame:
    """One pass: ``rows`` (a column text and those of ``_FOUND``) with what the block adds, without the dropped columns."""
    shared, name = rows.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex
    kept = [c for c in rows.columns if c not in dropped]
    out = to_arrow_schema(rows.select(*kept).schema)
    found = [out.field(c) for c in _FOUND]
    plain = [c for c in kept if c not in _FOUND]

    def shard(held: list[pa.RecordBatch], ids: array.array, sizes: list[int], own: Block) -> list[pa.RecordBatch]:
        first = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) + 1)])
        result = _Found(own, np.frombuffer(ids, np.int32), first, window)
        table = pa.Table.from_batches(held)
        spans, items, longest = (table.column(c).to_pylist() for c in ("__spans", "__items", "__longest"))
        for d in range(table.num_rows):
            spans[d] = _merged(spans[d], result.spans(d)) if d in result.items else spans[d] or []
            items[d] = sorted({*(items[d] or []), *result.items.get(d, [])})
            old, new = longest[d], result.longest.get(d)
            if new and (not old or (-new[0], new[1], new[2] or "") < (-old["words"], old["start"], old["item"] or "")):
                longest[d] = dict(zip(("words", "start", "item", "item_start"), new))
        added = [pa.array(v, f.type) for v, f in zip((sizes, spans, items, longest), found)]
        return pa.table([*[table.column(c) for c in plain], *added], names=[*plain, *_FOUND]).select(kept).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("decontamination")
        keeps("decontamination", _blocks.clear)
        if name not in _blocks:
            _blocks.clear()
            _blocks[name] = shared.value
        own = _blocks[name]
        number = own.vocabulary.get
        held, ids, sizes = [], array.array("i"), []
        for batch in batches:
            texts, from_row = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()), 0
            for i, text in enumerate(texts):
                before = len(ids)
                ids.extend(map(number, words(text.as_py()), repeat(0)))
                sizes.append(len(ids) - before)
                ids.append(0)
                if len(ids) >= shard_words:
                    held.append(batch.slice(from_row, i + 1 - from_row))
                    yield from shard(held, ids, sizes, own)
                    held, ids, sizes, from_row = [], array.array("i"), [], i + 1
            if from_row < batch.num_rows:
                held.append(batch.slice(from_row))
        if sizes:
            yield from shard(held, ids, sizes, own)

    return rows.mapInArrow(run, rows.select(*kept).schema)


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS, window: int = WINDOW) -> Iterator[Block]:
    """The benchmark's texts with words, in blocks of bounded size."""
    held, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text")).where("text is not null")
    for item_id, text in rows.toLocalIterator(prefetchPartitions=True):
        own = words(text.encode())
        if not own:
            continue
        if held and size + len(own) > block_words:
            yield Block(held, window)
            held, size = [], 0
        held.append((item_id, own))
        size += len(own)
    if held:
        yield Block(held, window)


def matched(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    keep_text: bool = True,
    shard_words: int = SHARD_WORDS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents with ``__n_words``, ``__spans`` (word ranges inside windows), ``__items`` (ids as sorted strings of
    the benchmark texts with a window in the document) and ``__longest`` (the longest verbatim match)."""
    rows = docs.selectExpr("*", *[f"cast(null as {kind}) as {name}" for name, kind in _FOUND.items()])
    pending: Block | None = None
    for block in blocks(benchmark, block_words, window):
        if pending is not None:
            rows = written(_pass(rows, pending, window, shard_words, []), "decontamination")
        pending = block
    return _pass(rows, pending or Block([], window), window, shard_words, [] if keep_text else ["text"])


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that share no window with the benchmark, with their own columns."""
    return matched(docs, benchmark, window).where(F.size("__items") + F.size("__spans") == 0).select(*docs.columns)
