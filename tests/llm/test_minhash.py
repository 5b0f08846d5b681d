import random
import re

import numpy as np
import pytest

from cohortlens.llm import minhash
from cohortlens.llm.components import components


def brute(rows, width, similarity=80):
    """doc_id -> (set size, component id) by comparing all pairs."""
    sets = {}
    for doc_id, text in rows:
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        n = min(width, len(words))
        sets[doc_id] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= similarity * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def check(df, rows, width):
    want = brute(rows, width)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}
    assert got == want
    for r in df.collect():
        assert r["kept"] == (r["doc_id"] == r["component_id"])


@pytest.mark.parametrize("width", [2, 5])
def test_equals_all_pairs_on_the_test_documents(docs, corpus, width):
    rows = [(d, t) for d, t, *_ in corpus]
    check(minhash.near_duplicates(docs(rows), width), rows, width)


def test_chains_of_edits_and_large_group(docs):
    """A group whose members drift apart: links go on through neighbours, and stragglers are found."""
    draw = random.Random(3)
    base = [f"w{draw.randrange(10**6)}" for _ in range(80)]
    rows, now = [], list(base)
    for i in range(150):
        if i % 3:
            now[draw.randrange(80)] = f"n{i}"
        else:
            now = [w if draw.random() > 0.07 else f"m{i}{k}" for k, w in enumerate(base)]
        rows.append((1000 - i, " ".join(now)))
    rows += [(2000 + i, " ".join(base)) for i in range(40)] + [(5000, " ".join(base[:30])), (5001, "solo words here")]
    check(minhash.near_duplicates(docs(rows), 2), rows, 2)


def test_defined_cases(docs):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "oNE"), (6, "one two"), (7, "ONE TWO"), (8, "a b c"),
            (9, "x " * 30000), (10, "É é"), (11, "é É")]
    check(minhash.near_duplicates(docs(rows, extra=True), 2), rows, 2)
    again = minhash.near_duplicates(docs(rows[3:5] + rows[3:5] + [(None, "one"), (None, "else")]), 2).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in again) == [
        (-1, -1, True), (-1, 4, False), (4, 4, True), (4, 4, True), (5, 4, False), (5, 4, False)
    ]
    assert minhash.near_duplicates(docs([]), 2).collect() == []


def test_without_copies_keeps_one_row(docs):
    text = " ".join(f"w{i}" for i in range(60))
    df = docs([(3, text), (1, text), (2, text + " more"), (1, text), (9, None), (8, "other words only")])
    left = minhash.without_copies(df)
    assert left.columns == df.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 8, 9]


def test_circulant_signature_estimates_similarity():
    draw = np.random.default_rng(1)
    a = np.unique(draw.integers(0, 2**63, 2000, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:1600], draw.integers(0, 2**63, 400, dtype=np.uint64)]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((minhash._signature(a) == minhash._signature(b)).mean() - true) < 0.12
    assert minhash._signature(a).shape == (minhash.BANDS * minhash.BAND_ROWS,)


def test_bound_never_cuts_a_link():
    draw = np.random.default_rng(5)
    for n in (5, 300, 5000):
        a = np.unique(draw.integers(0, 2**64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: int(n * 0.9)], draw.integers(0, 2**64, n // 20, dtype=np.uint64)]))
        x, y = (np.frombuffer(minhash._cells(s), np.uint8).astype(int) for s in (a, b))
        assert np.minimum(x, y).sum() >= len(np.intersect1d(a, b))


def test_components_of_a_long_chain(spark):
    order = list(range(1, 200))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame([(a, b) for a, b in zip(order, order[1:])] + [(500, 501), (501, 502), (500, 501)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {**dict.fromkeys(order, 1), 500: 500, 501: 500, 502: 500}
    assert components(links.limit(0)).collect() == []
