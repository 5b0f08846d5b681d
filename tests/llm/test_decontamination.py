import hashlib
import random
import re

import numpy as np
import pytest

from cohortlens.llm import decontamination
from cohortlens.llm.queries import op11_suffix_arrays

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, window=10):
    """Per document: words, hit words, item ids."""
    wanted = {}
    for item_id, text in items:
        own = split(text)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            wanted.setdefault(tuple(own[i : i + size]), set()).add(item_id)
    sizes = {len(w) for w in wanted}
    out = []
    for doc_id, text in docs:
        own, hit, found = split(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                if tuple(own[i : i + size]) in wanted:
                    hit |= set(range(i, i + size))
                    found |= wanted[tuple(own[i : i + size])]
        out.append((doc_id, len(own), sorted(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=str)


def got(df):
    rows = df.collect()
    return sorted(
        ((r["doc_id"], r["__n_words"], [i for s in r["__spans"] for i in range(s["start"], s["stop"])], r["__items"]) for r in rows), key=str
    )


def test_suffix_array_orders_all_suffixes():
    draw = np.random.default_rng(4)
    for high, n, depth in ((2, 300, 40), (5, 400, 7), (200_000, 300, 12), (3, 1, 4)):
        ids = draw.integers(0, high + 1, n).astype(np.int32)
        ids[-1] = 0
        at = decontamination.suffix_array(ids, depth)
        assert sorted(at.tolist()) == np.flatnonzero(ids).tolist()
        tails = []
        for p in at:
            end = p + int(np.argmax(ids[p:] == 0))
            tails.append(tuple(ids[p : min(end, p + depth)]))
        assert tails == sorted(tails)
    assert len(decontamination.suffix_array(np.zeros(5, np.int32), 3)) == 0


@pytest.mark.parametrize("shard, block", [(1 << 19, 1 << 21), (50, 60), (1, 1)])
def test_equals_all_windows(spark, docs, shard, block):
    draw = random.Random(5)
    prose = lambda n: " ".join(f"w{draw.randrange(6)}" for _ in range(n))
    items = [(i, prose(draw.randrange(1, 40))) for i in range(20)] + [(3, prose(12)), (77, "short One!"), (78, None), (79, "?"), (None, prose(15))]
    rows = [(i, prose(draw.randrange(0, 60))) for i in range(60)] + [(100, None), (101, ""), (102, "a SHORT, one b"), (102, "a SHORT, one b")]
    rows += [(200 + i, items[i][1] + " tail " + items[i + 1][1]) for i in range(15)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    result = decontamination.matched(docs(rows, extra=True), benchmark, shard_words=shard, block_words=block)
    assert got(result) == brute(rows, items)


def test_equals_all_windows_on_the_test_documents(spark, corpus, sf):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = {r["doc_id"]: r for r in op11_suffix_arrays(spark, sf).collect()}
    want = brute([(d, t) for d, t, *_ in corpus], items)
    assert len(rows) == len(want) and any(w[2] for w in want)
    for doc_id, n, hit, found in want:
        r = rows[doc_id]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, len(hit), len(found), bool(hit))
        assert r["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()


def test_longest_match_and_removal(spark, docs):
    passage = [f"p{i}" for i in range(30)]
    benchmark = spark.createDataFrame([(9, " ".join(passage)), (10, "two words")], "item_id bigint, text string")
    rows = [(1, "intro " + " ".join(passage[4:25]) + " outro"), (2, " ".join(passage[:9]) + " stop"), (3, "Two-words"), (4, "clean text"),
            (5, "x " * 200_000 + " ".join(passage[:12]))]
    found = {r["doc_id"]: r["__longest"] for r in decontamination.matched(docs(rows), benchmark).collect()}
    assert tuple(found[1]) == (21, 1, "9", 4) and found[2] is None and tuple(found[3]) == (2, 0, "10", 0) and found[4] is None
    assert tuple(found[5]) == (12, 200_000, "9", 0)
    left = decontamination.decontaminated(docs(rows, extra=True), benchmark)
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 4] and left.columns == docs(rows, extra=True).columns


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.matched(docs([]), none).collect() == []
    kept = decontamination.matched(docs([(1, "a b"), (None, None)]), none).collect()
    assert sorted((r["__n_words"], r["__spans"], r["__items"], r["__longest"]) for r in kept) == [(0, [], [], None), (2, [], [], None)]
