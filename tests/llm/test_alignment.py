import hashlib
from collections import Counter

import pytest

from cohortlens.llm import alignment
from cohortlens.llm.queries import op12_alignment


@pytest.fixture(scope="module")
def own():
    return alignment.Vocabularies()


def brute(own, rows):
    """Per document the contract's columns and the groups, token by token."""
    byte_of = {v: k for k, v in {i: c for c, i in alignment._byte_letters().items()}.items()}
    found, counts = [], Counter()
    for doc_id, text in rows:
        a = own.whole.encode(" " + text, add_special_tokens=False).ids if text else []
        b = own.pieces.encode(text) if text else []
        bytes_a = [bytes(byte_of[c] for c in own.whole.id_to_token(i)) for i in a]
        pieces = [own.pieces.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if own.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        if not text or b"".join(bytes_a) != b" " + text.encode() or b"".join(bytes_b) != b" " + text.encode():
            found.append((doc_id, 0, 0, [], []))
            continue
        ends_a, ends_b, at = {}, {}, 0
        for i, t in enumerate(bytes_a):
            at += len(t)
            ends_a[at] = i
        at = 0
        for i, t in enumerate(bytes_b):
            at += len(t)
            ends_b[at] = i
        links = [(a[ends_a[e]], b[ends_b[e]]) for e in sorted(ends_a.keys() & ends_b.keys())]
        counts.update(links)
        groups, x, y = [], 0, 0
        for e in sorted(ends_a.keys() & ends_b.keys()):
            groups.append(",".join(map(str, a[x : ends_a[e] + 1])) + "|" + ",".join(map(str, b[y : ends_b[e] + 1])))
            x, y = ends_a[e] + 1, ends_b[e] + 1
        found.append((doc_id, len(a), len(b), groups, links))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for doc_id, n_a, n_b, groups, links in found:
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc_id, n_a, n_b, len(groups), len(links), sha, sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links)))
    return sorted(out, key=str)


COLUMNS = "doc_id n_a n_b n_groups n_links groups_sha256 n_best count_sum".split()


def test_equals_token_by_token_on_the_test_documents(spark, own, corpus, sf):
    got = sorted((tuple(r[c] for c in COLUMNS) for r in op12_alignment(spark, sf).collect()), key=str)
    assert got == brute(own, [(d, t) for d, t, *_ in corpus])


ODD = ["", None, " ", "  two  spaces ", "\n\ttabs\r\n", "a▁b", "<|endoftext|> and <s> </s> <unk> <0x41>", "naïve café", "日本語 text", "🙂🙃",
       "a b", "ﬁ ligature", "nul\x00inside", "x" * 3000, "word " * 20000, " " * 2000, "é", "Ｆｕｌｌ", "▁", "a \u0301b c\u00a0d \x1c e", "It's we'll 12 34th x\u2028y", "end ", "tab\tb c"]


def test_odd_texts_and_repeated_rows(spark, own, docs):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(5, ODD[7]), (5, ODD[7]), (None, "plain text")]
    got = sorted((tuple(r[c] for c in COLUMNS) for r in alignment.cross_tokenized(docs(rows, extra=True)).collect()), key=str)
    assert got == brute(own, rows)
    assert alignment.cross_tokenized(docs([])).collect() == []
    assert alignment.cross_tokenized(docs([(1, None)])).collect()[0]["groups_sha256"] == ""


def test_words_give_the_tokenizers_ids(own, corpus):
    texts = [t for _, t, *_ in corpus if t] + [t for t in ODD if t]
    assert own.by_words
    for _ in range(2):
        a, b = own.encode(texts)
        assert a.to_pylist() == [own.whole.encode(" " + t, add_special_tokens=False).ids for t in texts]
        assert b.to_pylist() == own.pieces.encode(texts)


def test_groups_are_spelled_out(spark, own, docs):
    row = alignment.aligned(docs([(1, "hello tokenizers")]), spell_groups=True).collect()[0]
    assert hashlib.sha256(row["groups"].encode()).hexdigest() == row["groups_sha256"] and row["groups"].count("|") == row["n_groups"]


def test_bound_holds_for_all_pairs(own):
    assert 500_000 < own.pair_bound() < 2_000_000
