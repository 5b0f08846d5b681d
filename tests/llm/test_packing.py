import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortlens.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def valid(rows, capacity):
    """Every sequence is filled from 0 without gaps and not beyond its capacity; returns the number of sequences."""
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_ids_equal_the_tokenizer_on_odd_white_space(tokenizer):
    texts = ["", None, " a", "a ", "a  b", "a   b", "a \n b", "\n\na\n b\t c", "x  y", "it's we'll 's", "a\r\n b", "日本 語 🙂 x",
             "<|endoftext|> x", "a <|endoftext|>b <|endoftext|>", "x<|endoftext|> c d", " ", "  ", "w" * 500 + " v", "a\n\n\nb", "é è z", "tab\tand space"]
    for text, ids in zip(texts, packing.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == (tokenizer.encode(text, add_special_tokens=False).ids if text else []) + [0]


def test_strings_of_special_tokens_become_that_token():
    got = np.frombuffer(packing.encode(["a <|endoftext|> b"])[0], "<u4").tolist()
    assert 50256 in got and len(got) == 5


def best_fit_decreasing(lengths, capacity):
    """Sequences that best fit needs with all lengths in one place, longest first."""
    spaces = [0] * (capacity + 1)
    opened = 0
    for n in sorted(lengths, reverse=True):
        space = next((s for s in range(n, capacity) if spaces[s]), capacity)
        if space == capacity:
            opened += 1
        else:
            spaces[space] -= 1
        spaces[space - n] += 1
    return opened


def test_pieces_and_packing_of_the_test_documents(docs, corpus, tokenizer):
    rows = [(d, t) for d, t, *_ in corpus]
    got = packing.packed(docs(rows, extra=True)).collect()
    pieces = defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == {d for d, _ in rows}
    total = 0
    for doc_id, text in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        total += len(ids)
        at = 0
        own = sorted(pieces[doc_id], key=lambda r: r["piece"])
        assert len(own) == -(-len(ids) // packing.CAPACITY)
        for k, r in enumerate(own):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["length"] == packing.CAPACITY or k == 0
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    assert valid(got, packing.CAPACITY) <= 1.03 * -(-total // packing.CAPACITY) + 1


@pytest.mark.parametrize("seed", [1, 2])
def test_few_sequences_at_any_mix_of_lengths(spark, seed):
    draw = np.random.default_rng(seed)
    lengths = [*draw.integers(1, 2049, 1500), *draw.integers(1, 120, 4000), *[[683], [682]][seed - 1] * 2000, *[1] * 500, *[2048] * 20]
    cut = spark.createDataFrame([(i, 0, 0, int(n), 0) for i, n in enumerate(lengths)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = packing.pack(cut).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(lengths)))
    used, usual = valid(got, 2048), best_fit_decreasing([int(n) for n in lengths], 2048)
    assert used <= 1.01 * usual + 2, (used, usual)


def test_configurations_cover_the_demand():
    sizes, demand = [1000, 700, 500, 340], [40, 33, 71, 18]
    used = packing.configurations(sizes, demand, 2048)
    for i, need in enumerate(demand):
        assert sum(c[i] * n for c, n in used) >= need
    assert all(sum(s * k for s, k in zip(sizes, c)) <= 2048 for c, _ in used)
    assert sum(n for _, n in used) <= -(-sum(s * d for s, d in zip(sizes, demand)) // 2048) + 4


def test_defined_cases(docs):
    assert packing.packed(docs([])).collect() == []
    got = packing.packed(docs([(1, None), (2, ""), (3, "a"), (3, "a"), (None, "b"), (4, "word " * 30000)])).collect()
    assert sorted((r["doc_id"] or -1) for r in got if r["length"] < 3) == [-1, 1, 2, 3, 3]
    assert valid(got, 2048) == -(-sum(r["length"] for r in got) // 2048)


def test_sequences_hold_the_ids(docs, tokenizer):
    out = packing.sequences(docs([(1, "alpha beta"), (2, "gamma"), (3, None)])).collect()
    (row,) = out
    ids = np.frombuffer(bytes(row["ids"]), "<u4").tolist()
    want = {1: tokenizer.encode("alpha beta").ids + [0], 2: tokenizer.encode("gamma").ids + [0], 3: [0]}
    assert ids == [i for d in row["doc_ids"] for i in want[d]]
