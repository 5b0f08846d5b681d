"""Alignment of two tokenizers' tokens over a corpus, as Arrow columns from end to end.

A batch's texts become two list columns of token ids. Flattened, with parent indices, the tokens' byte lengths give the
byte offset each token ends at, by cumulative sums per document. A hash join on (document, end) finds the links: pairs
of tokens whose byte ranges end together; they cut a document into groups. Group-by counts of id pairs, per document and
then per task, are merged by Spark.

Every text is tokenised once; what later steps need (distinct linked pairs per document, with their number) is written
to the shared folder. Of two tokens that end together the shorter one's bytes end the longer one's, so at most
``pair_bound`` id pairs can ever be linked, however large the corpus: the table of pair counts is broadcast on that
ground, and the bound is checked.

First tokenizer: byte-level BPE, over a space and the text; strings of special tokens are plain text. Second: a
sentencepiece model, which puts the space before the text itself.

Defined cases: a text that is null or empty, or whose tokens do not spell the space and the text byte by byte in both
tokenizers, has no tokens, no groups and no links; repeated rows are documents of their own; ties for the highest count
all count as best; very long texts are batches of their own; an empty table gives an empty result. Columns other than
doc_id and text are not read.
"""

from __future__ import annotations

import array
import base64
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from cohortlens.llm.common import at_work, keeps
from cohortlens.sources.scratch import written

BYTE_TOKENIZER = "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
PIECE_MODEL = "piece_bpe_32k.model"
#: Characters after which a batch of texts is closed.
BATCH_CHARS = 1 << 20
#: Words a worker remembers, and characters of a word that goes through the tokenizer itself, which takes linear time.
_REMEMBERED = 300_000
_LONG_WORD = 200
#: A space that does not stand between two words; its tokens depend on more than the word that follows.
_WIDE_SPACE = re.compile(r" \s|\s | \Z")
_SPACE_PIECE = "▁"


class Vocabularies:
    """Both tokenizers, the bytes and byte lengths of their tokens, and the decimal ids that spell groups."""

    def __init__(self, byte_tokenizer: str = BYTE_TOKENIZER, byte_ranks: str | None = BYTE_RANKS, piece_model: str = PIECE_MODEL):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        place = lambda n: n if os.path.isabs(n) else public_tokenizers.path(n)
        self.whole = Tokenizer.from_file(place(byte_tokenizer))
        self.whole.encode_special_tokens = True
        self.by_rank = None
        if byte_ranks:
            with open(place(byte_ranks), "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.by_rank = tiktoken.Encoding("texts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=place(piece_model))
        letters = _byte_letters()
        spelled = self.whole.get_vocab(with_added_tokens=True)
        a = [b""] * (max(spelled.values()) + 1)
        for token, i in spelled.items():
            known = all(c in letters for c in token)
            a[i] = bytes(letters[c] for c in token) if known else token.encode()
        b = []
        for i in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(i)
            b.append(bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace(_SPACE_PIECE, " ").encode())
        #: Whether a piece has its space at its start only, so that words have tokens of their own.
        self.by_words = not any(_SPACE_PIECE in self.pieces.id_to_piece(i).lstrip(_SPACE_PIECE) for i in range(len(b)))
        self.spaced = np.array([t.startswith(b" ") for t in a])
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.bytes = [pa.array(a, pa.binary()), pa.array(b, pa.binary())]
        self.lengths = [pa.array([len(t) for t in side], pa.int64()) for side in (a, b)]
        #: Id i of the first tokenizer is said at 2i inside a group and at 2i + 1 as its last, that of the second likewise.
        self.said = pa.array(
            [f"{i}{end}".encode() for i in range(len(a)) for end in ",|"] + [f"{i}{end}".encode() for i in range(len(b)) for end in ",;"],
            pa.binary(),
        )
        self.second_said = 2 * len(a)

    def pair_bound(self) -> int:
        """Most id pairs that can be linked: each token with all that spell one of its endings."""
        same = [max(np.unique(np.array(side.to_pylist(), object), return_counts=True)[1]) for side in self.bytes]
        sums = [int(pc.sum(n).as_py()) for n in self.lengths]
        return int(sums[0] * same[1] + sums[1] * same[0])

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Both tokenizers' ids. They start a token at every single space before a word, so a text's ids are those of its
        words, each with its space; words are looked up and only unknown ones are encoded."""
        known = self.known
        if len(known) > _REMEMBERED:
            known.clear()
        split = [None if not self.by_words or _WIDE_SPACE.search(" " + t) else t.split(" ") for t in texts]
        new = list(set().union(*filter(None, split)).difference(known))
        known.update(zip(new, zip(self._first_words(new), map(_packed, self.pieces.encode(new, num_threads=1)))))
        a, b = [], []
        for text, words in zip(texts, split):
            if words is None:
                a.append(_packed(self.whole.encode(" " + text, add_special_tokens=False).ids))
                b.append(_packed(self.pieces.encode(text)))
            else:
                both = [known[w] for w in words]
                a.append(b"".join([x for x, _ in both]))
                b.append(b"".join([y for _, y in both]))
        for w in new:
            if len(w) > _LONG_WORD:
                del known[w]
        return _lists(a), _lists(b)

    def _first_words(self, words: list[str]) -> list[bytes]:
        """The first tokenizer's ids of words behind a space. Joined, every word starts with a token that has one."""
        out: list[bytes] = []
        for at in range(0, len(words), 2000):
            part = [" " + w for w in words[at : at + 2000]]
            if self.by_rank is not None and max(map(len, part)) <= _LONG_WORD:
                ids = self.by_rank.encode_to_numpy("".join(part), disallowed_special=()).astype(np.int32)
                first = np.flatnonzero(self.spaced[ids])
                if len(first) == len(part):
                    data, cuts = ids.tobytes(), [*(4 * first).tolist(), 4 * len(ids)]
                    out += [data[x:y] for x, y in zip(cuts, cuts[1:])]
                    continue
            out += [_packed(e.ids) for e in self.whole.encode_batch(part, add_special_tokens=False)]
        return out


def _packed(ids: list[int]) -> bytes:
    return array.array("i", ids).tobytes()


def _lists(parts: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts], dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level tokenizers write bytes: printable ones stand for themselves, others follow 255."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{chr(b): b for b in printable}, **{chr(256 + n): b for n, b in enumerate(others)}}


def _cuts(values: pa.Array, offsets: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """Joined bytes of a binary column, and where each list of it begins there."""
    starts = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    return memoryview(values.buffers()[2] or b"").cast("B"), starts[offsets]


def _spelled(lists: pa.ListArray, token_bytes: pa.Array, texts: list[bytes]) -> np.ndarray:
    """Whether each list's tokens, joined, are the text."""
    data, at = _cuts(token_bytes.take(lists.flatten()), np.asarray(lists.offsets))
    return np.array([data[x:y] == t for x, y, t in zip(at[:-1].tolist(), at[1:].tolist(), texts)], bool)


def _ends(lists: pa.ListArray, lengths: pa.Array, name: str) -> pa.Table:
    """One row per token: document, byte offset it ends at, its place among all tokens, its id."""
    flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    running = pc.cumulative_sum(lengths.take(flat))
    before = np.concatenate([[0], np.asarray(running)])[np.asarray(lists.offsets)[:-1]]
    ends = pc.subtract(running, pa.array(before).take(parents))
    return pa.table({"document": parents, "end": ends, f"at_{name}": pa.array(np.arange(len(flat))), name: flat})


def _groups(own: Vocabularies, a: pa.ListArray, b: pa.ListArray, at_a: np.ndarray, at_b: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """All documents' groups as joined text, and where each document begins. The last sign of a document is a semicolon."""
    ids_a, ids_b = np.asarray(a.flatten()), np.asarray(b.flatten())
    last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    last_a[at_a], last_b[at_b] = 1, 1
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    order = np.empty(len(ids_a) + len(ids_b), np.int64)
    # A token stands behind its own side's earlier tokens and the other side's of earlier (or the same) groups.
    order[np.arange(len(ids_a)) + np.concatenate([[0], at_b + 1])[group_a]] = 2 * ids_a + last_a
    order[np.arange(len(ids_b)) + at_a[group_b] + 1] = own.second_said + 2 * ids_b + last_b
    return _cuts(own.said.take(pa.array(order)), np.asarray(a.offsets).astype(np.int64) + np.asarray(b.offsets))


def align(own: Vocabularies, texts: list[str | None], spell_groups: bool = False) -> pa.Table:
    """Per text: number of tokens of either side, of groups and links; digest of the groups (and their text); distinct
    linked pairs as lists of ids and their number."""
    n = len(texts)
    usable = [i for i, t in enumerate(texts) if t]
    a, b = own.encode([texts[i] for i in usable])
    plain = [b" " + texts[i].encode() for i in usable]
    good = _spelled(a, own.bytes[0], plain) & _spelled(b, own.bytes[1], plain) if usable else np.empty(0, bool)
    rows = np.array(usable, np.int64)[good]
    a, b = a.filter(pa.array(good)), b.filter(pa.array(good))
    counts = np.zeros((4, n), np.int64)
    digests, spelled = [""] * n, [""] * n
    pairs: list[pa.Array] = [pa.array([], pa.int32()), pa.array([], pa.int32()), pa.array([], pa.int64())]
    sizes = np.zeros(n, np.int64)
    if len(rows):
        ends_a, ends_b = _ends(a, own.lengths[0], "a"), _ends(b, own.lengths[1], "b")
        links = ends_a.join(ends_b, ["document", "end"], join_type="inner", use_threads=False)
        at_a, at_b = (np.sort(links.column(c).to_numpy()) for c in ("at_a", "at_b"))
        data, cuts = _groups(own, a, b, at_a, at_b)
        for i, x, y in zip(rows.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
            digests[i] = hashlib.sha256(data[x : y - 1]).hexdigest()
            if spell_groups:
                spelled[i] = str(data[x : y - 1], "ascii")
        of_links = np.bincount(links.column("document").to_numpy(), minlength=len(rows))
        counts[:, rows] = np.stack([np.diff(a.offsets), np.diff(b.offsets), of_links, of_links])
        held = links.group_by(["document", "a", "b"], use_threads=False).aggregate([([], "count_all")]).sort_by("document")
        sizes[rows] = np.bincount(held.column("document").to_numpy(), minlength=len(rows))
        pairs = [held.column(c).combine_chunks() for c in ("a", "b", "count_all")]
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, p) for p in pairs]
    columns = {
        **{name: pa.array(counts[k]) for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
        "groups_sha256": pa.array(digests), "pair_a": lists[0], "pair_b": lists[1], "pair_n": lists[2],
    }
    return pa.table({**columns, "groups": pa.array(spelled)} if spell_groups else columns)


_loaded: dict[tuple, Vocabularies] = {}


def _vocabularies(names: tuple) -> Vocabularies:
    keeps("alignment", _loaded.clear)
    if names not in _loaded:
        _loaded[names] = Vocabularies(*names)
    return _loaded[names]


_ALIGNED = (
    "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pair_a array<int>, pair_b array<int>, pair_n array<long>"
)


def aligned(docs: DataFrame, names: tuple = (BYTE_TOKENIZER, BYTE_RANKS, PIECE_MODEL), spell_groups: bool = False) -> DataFrame:
    """doc_id with the columns of ``align``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("alignment")
        own = _vocabularies(names)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            done, size = 0, 0
            for i, text in enumerate(texts):
                size += len(text or "")
                if size >= BATCH_CHARS or i == len(texts) - 1:
                    found = align(own, texts[done : i + 1], spell_groups)
                    found = found.add_column(0, "doc_id", batch.column(0).slice(done, i + 1 - done))
                    yield from found.combine_chunks().to_batches()
                    done, size = i + 1, 0

    schema = "doc_id long, " + _ALIGNED + (", groups string" if spell_groups else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def pair_counts(found: DataFrame) -> DataFrame:
    """(a, b, n, best): links of every id pair in the whole corpus, and whether no other pair of b has more."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            a, b, n = (batch.column(c).flatten() for c in range(3))
            held.append(pa.table({"a": a, "b": b, "n": n}))
            if sum(t.num_rows for t in held) > 4_000_000:
                held = [_summed(held)]
        if held:
            yield from _summed(held).combine_chunks().to_batches()

    parts = found.select("pair_a", "pair_b", "pair_n").mapInArrow(partial, "a int, b int, n long")
    counts = written(parts.groupBy("a", "b").agg(F.sum("n").alias("n")), "pair-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _summed(tables: list[pa.Table]) -> pa.Table:
    joined = pa.concat_tables(tables).group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")])
    return joined.select(["a", "b", "n_sum"]).rename_columns(["a", "b", "n"])


def rated(found: DataFrame, counts: DataFrame, bound: int) -> DataFrame:
    """``found`` with n_best (links whose pair is its b's most frequent) and count_sum (sum of the links' pair counts).

    The pair table goes to every task; it holds at most ``bound`` rows by the nature of links, which is checked.
    """
    table = counts.limit(bound + 1).toArrow()
    if table.num_rows > bound:
        raise ValueError("more id pairs than two vocabularies can link")
    code = table.column("a").to_numpy().astype(np.int64) << 32 | table.column("b").to_numpy()
    order = np.argsort(code)
    lookup = (code[order], table.column("n").to_numpy()[order], np.asarray(table.column("best"))[order])
    shared = found.sparkSession.sparkContext.broadcast(lookup)
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, total, best = shared.value
        for batch in batches:
            a, b, n = (batch.column(c) for c in ("pair_a", "pair_b", "pair_n"))
            parents = np.asarray(pc.list_parent_indices(a))
            at = np.searchsorted(codes, np.asarray(a.flatten()).astype(np.int64) << 32 | np.asarray(b.flatten()))
            times = np.asarray(n.flatten())
            sums = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(sums[0], parents, times * best[at])
            np.add.at(sums[1], parents, times * total[at])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(sums[0]), pa.array(sums[1])],
                                             names=[*kept, "n_best", "count_sum"])

    return found.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")


def cross_tokenized(docs: DataFrame, names: tuple = (BYTE_TOKENIZER, BYTE_RANKS, PIECE_MODEL)) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum."""
    found = written(aligned(docs, names), "aligned")
    return rated(found, pair_counts(found), Vocabularies(*names).pair_bound())
