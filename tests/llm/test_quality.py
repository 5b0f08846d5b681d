import random
import re

import numpy as np

from cohortlens.llm import quality


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = (text or "").split("\n")
    seen, dup = set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    marked = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            marked.update(range(i, i + 8))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(marked)


def test_statistics_equal_brute_force(corpus):
    draw = random.Random(2)
    texts = [t for _, t, *_ in corpus[:60]] + [None, "", " \n ", "a\n\na\nb\n a\na ", " x y z", "w " * 9, "a b " * 40, "x\r\ny\r\nx"]
    texts += [" ".join(draw.choice("ab") for _ in range(n)) for n in (7, 8, 9, 15, 16, 40, 120)]
    texts += [" ".join(f"w{draw.randrange(4)}" for _ in range(200)) + "\n\n" + "é*|é"]
    for text in texts:
        assert quality.text_statistics(text)[:5] == brute(text)


def test_rules_on_held_out_documents(spark, sf):
    path = sf.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    train = labels.where("doc_id % 2 = 0")
    judged = quality.judged(docs, train).join(labels.where("doc_id % 2 = 1"), "doc_id").select("__kept", "__rule", "quality").collect()
    low = [r for r in judged if r["quality"] == 0]
    good = [r for r in judged if r["quality"] == 1]
    assert sum(not r["__kept"] for r in low) >= 0.8 * len(low)
    assert sum(r["__rule"] is not None for r in good) <= 0.03 * len(good)


def test_list_of_conjunctions_from_statistics():
    draw = np.random.default_rng(1)
    counts = draw.integers(1, 100, (3000, len(quality._COUNTS)))
    counts[:, 0] = 100
    low = (counts[:, 2] > 60) & (counts[:, 8] > 50)
    rules = quality.decision_list(counts, low)
    features = quality._features(counts)
    hit = np.zeros(len(low), bool)
    for rule in rules:
        hit |= quality._covers(rule, features)
    assert (hit & low).sum() > 0.85 * low.sum() and (hit & ~low).sum() < 0.1 * hit.sum()
    assert {c.name for c in rules[0]} >= {"n_symbols_per_word", "n_exclamations_per_word"}


def test_defined_cases(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 0, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    df = docs([(1, "word " * 30), (2, None), (3, ""), (None, "few"), (5, "r s t u v w x y " * 400), (1, "word " * 30)], extra=True)
    got = quality.judged(df, labels)
    assert set(df.columns) <= set(got.columns)
    assert sorted((r["doc_id"] or 0, r["__kept"]) for r in got.collect()) == [(0, False), (1, False), (1, False), (2, False), (3, False), (5, False)]
    assert quality.judged(docs([]), labels.limit(0)).collect() == []
    assert quality.decision_list(np.empty((0, len(quality._COUNTS))), np.empty(0, bool)) == []
    assert quality.judged(docs([(9, " ".join(f"w{i}" for i in range(50)))]), labels).first()["__kept"]
