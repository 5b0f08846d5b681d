import random
import re
from collections import Counter

import numpy as np
import pytest

from cohortlens.llm import collocations
from cohortlens.llm.queries import op13_collocations

COLUMNS = "lang rank phrase a l r n score".split()


def brute(rows, least, best):
    """The contract's rows from counts of all phrases."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                counts.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    dropped = set()
    for (lang, words), n in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                own = lang, words[i : i + size]
                if 100 * n >= 80 * candidates[own]:
                    dropped.add(own)
    out = []
    for lang in totals:
        rated = []
        for (own, words), a in candidates.items():
            if own == lang and (own, words) not in dropped:
                cuts = [(2_000_000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))]
                score, k = min(cuts)
                rated.append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rated)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.fixture(scope="module")
def made():
    draw = random.Random(8)
    words = ["The", "the", "of", "new", "york", "é", "x\x01", "\x00", "a b", "日本", "it's", "-"]
    rows = []
    for i in range(150):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", " ", "\t", "  ", ", ", ". ", "\n", "\x0b"]) for _ in range(draw.randrange(0, 80)))
        rows.append((draw.choice(["en", "en", "und", None, "de"]), text))
    return rows + [("en", "new york city hall " * 40), ("en", None), (None, ""), ("fr", "un deux"), ("en", "New York City Hall. " * 5)] + [rows[0]] * 2


@pytest.mark.parametrize("least, best, bound_rows", [(1, 2000, 10**6), (2, 30, 40), (5, 7, 3), (30, 2000, 100_000)])
def test_equals_counts_of_all_phrases(spark, made, least, best, bound_rows):
    docs = spark.createDataFrame([(i, t, lang, 1, "x") for i, (lang, t) in enumerate(made)], "doc_id long, text string, lang string, n long, phrase string")
    assert got(collocations.collocations(docs, least, best, bound_rows)) == brute(made, least, best)


def test_equals_counts_of_all_phrases_on_the_test_documents(spark, corpus, sf):
    rows = [(lang, t) for _, t, _, lang in corpus]
    want = brute(rows, 30, 2000)
    assert want and got(op13_collocations(spark, sf)) == want


def test_crowded_tables_and_small_chunks_lose_nothing(spark, made):
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(made)], "doc_id long, text string, lang string")
    plain, crowded = (collocations.frequent_phrases(docs, 3, *sizes)[0] for sizes in ((), (64, 100)))
    rows = [sorted((r["lang"], tuple(r["words"]), r["n"]) for r in df.collect()) for df in (plain, crowded)]
    assert rows[0] == rows[1] and len(rows[0]) > 100


def test_tables_grow_with_the_texts(spark, monkeypatch):
    """Texts of many rare phrases: a table of a fixed size lets all of them through, one of the texts' size next to none."""
    monkeypatch.setattr(collocations, "CELLS", 64)
    draw = random.Random(3)
    texts = [" ".join(f"w{draw.randrange(3000)}" for _ in range(200)) + " new york." for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")

    def let_through(cells):
        table = collocations.cell_table(docs, 2, [], 30, cells, 1000)
        return {r["phrase"]: r["n"] for r in collocations.phrase_counts(docs, (2,), [table], cells, 1000).collect()}

    assert len(let_through(64)) > 10_000
    cells = collocations.cells_for(docs)
    assert cells >= 60 * 200 * 5 // 40 and len(few := let_through(cells)) < 600 and few["new york"] == 60
    monkeypatch.setattr(collocations, "MOST_CELLS", 128)
    assert collocations.cells_for(docs) == 128
    # What is written holds no rare phrase but the words, which the languages' totals need.
    kept = {}
    monkeypatch.setattr(collocations, "written", lambda df, name: kept.setdefault(name, df))
    collocations.frequent_phrases(docs, 30)
    assert min(r["n"] for r in kept["phrases"].collect() if " " in r["phrase"]) >= 30


def test_met_cells_as_rows():
    cell, n = collocations._added([np.array([3, 70, 200]), np.array([3, 69, 5000])], [np.array([200, 1, 7], np.uint8), np.array([200, 2, 255], np.uint8)])
    got = {}
    for batch in collocations._cell_rows(cell, n, 64):
        for at, places, counts in zip(*batch.to_pydict().values()):
            got |= {at + p: c for p, c in zip(np.frombuffer(places, np.uint16).tolist(), counts)}
    assert got == {3: 255, 69: 2, 70: 1, 200: 7, 5000: 255}


def test_large_counts_stay_exact(spark):
    """Products beyond 64 bits."""
    n = 9 * 10**15
    stream = spark.createDataFrame([("en", ["a"], n + 7), ("en", ["b"], n + 2), ("en", ["a", "b"], n + 1)], "lang string, words array<string>, n long")
    row = collocations.rated_phrases(stream).collect()[0]
    assert (row["l"], row["r"], row["score"]) == (n + 7, n + 2, 2_000_000 * (n + 1) // (2 * n + 9))


def test_defined_cases(spark, docs):
    assert collocations.collocations(docs([])).collect() == []
    assert collocations.collocations(docs([(1, None), (2, ""), (3, " . ")], extra=True)).collect() == []
    long = docs([(1, "one two " * 100_000)], extra=True)
    rows = {r["phrase"]: r["a"] for r in collocations.collocations(long).collect()}
    assert rows == {"one two one two": 99_999, "two one two one": 99_998}
