import gzip
import hashlib
import os
import random

import pytest

from cohortlens.llm import warc
from cohortlens.sources.scratch import scratch_path

PAGES = "page_id bigint, url string, html string"


def records(data):
    return [(o, h["warc-record-id"], b) for o, h, b in warc.salvage(data) if h is not None]


def gaps(data):
    return [(o, n) for o, h, n in warc.salvage(data) if h is None]


def test_round_trip_through_spark(spark):
    rows = [(1, "http://a/\r\nx", "<p>é</p>"), (5, "u", "same"), (9, "v", "same"), (7, None, "same"), (2, "w", None), (3, "w", ""),
            (4, "long", "x\r\n\r\nWARC/1.1\r\n" * 20000), (5, "u", "same"), (None, "n", "no id")]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS digest", "2 AS keeper", "3 AS refers_to")
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages, path)
    got = warc.read_archives(spark, path).collect()
    assert all(r["kind"] == "record" and r["file"] for r in got)
    want = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        keeper = max(same, default=None)
        refers = keeper if page_id is not None and page_id != keeper else None
        want.append((page_id, "revisit" if refers else "response", refers, len(payload), warc.base32_sha1(payload)))
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted([(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in got], key=key) == sorted(want, key=key)
    for r in got:
        if r["record_type"] == "response":
            assert len(r["payload"]) == r["payload_bytes"]
    assert warc.read_archives(spark, path, with_payload=False).where("payload is not null").count() == 0
    assert warc.archived(pages.limit(0)).collect() == []


def test_any_gzip_reader_reads_the_members():
    one, two = warc.record(1, "u", b"a", None), warc.record(2, "u", b"b", 1)
    data = warc._member(one) + warc.EMPTY_MEMBER + warc._member(two) + warc.EMPTY_MEMBER
    assert gzip.decompress(data) == one + two
    assert [r[1] for r in records(data)] == ["<urn:page:1>", "<urn:page:2>"]
    assert gaps(data) == []


def test_salvage_of_damaged_archives():
    parts = [warc._member(warc.record(i, f"http://h/{i}", f"<p>{i}</p>".encode() * (i + 1), None)) + warc.EMPTY_MEMBER for i in range(20)]
    starts = [sum(map(len, parts[:i])) for i in range(20)]
    whole = b"".join(parts)
    broken = bytearray(whole)
    for i in (0, 7, 8, 19):
        for k in range(20, 30):
            broken[starts[i] + k] ^= 0x5A
    got = [r[1] for r in records(bytes(broken))]
    assert got == [f"<urn:page:{i}>" for i in range(20) if i not in (0, 7, 8, 19)]
    lost = gaps(bytes(broken))
    assert sum(n for _, n in lost) > 0 and lost[0][0] == 0
    assert [r[1] for r in records(b"garbage" + whole[: starts[10] + 9])] == [f"<urn:page:{i}>" for i in range(10)]
    assert gaps(b"garbage" + whole)[0] == (0, 7)
    assert gaps(whole[: starts[3] + 15])[-1][0] <= starts[3]


def test_salvage_of_plain_records_and_noise():
    plain = [warc.record(i, "u", b"body WARC/1.1\r\n" + bytes([i]), None) for i in range(6)]
    data = bytearray(b"".join(plain))
    at = len(plain[0]) + len(plain[1]) - 6
    data[at] ^= 1  # inside the block of the second record: its digest fails
    assert [r[1] for r in records(bytes(data))] == [f"<urn:page:{i}>" for i in (0, 2, 3, 4, 5)]
    noise = random.Random(1).randbytes(5000)
    assert records(noise) == [] and gaps(noise) == [(0, 5000)]
    assert list(warc.salvage(b"")) == []


def test_digest_form():
    import base64

    assert warc.base32_sha1(b"") == base64.b32encode(hashlib.sha1(b"").digest()).decode() == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def test_salvage_inside_members_of_many_records():
    parts = [warc.record(i, f"http://h/{i}", random.Random(i).randbytes(3000), None) for i in range(6)]
    name = lambda *ids: [f"<urn:page:{i}>" for i in ids]
    bad = bytearray(parts[2])
    bad[-20] ^= 1
    member = gzip.compress(b"".join([*parts[:2], bad, *parts[3:]]))
    after = gzip.compress(warc.record(9, "u", b"x", None))
    data = member + after
    assert [r[1] for r in records(data)] == name(0, 1, 3, 4, 5, 9) and gaps(data) == [(0, len(bad))]
    whole = gzip.compress(b"".join(parts))
    cut = whole[: len(whole) // 2]
    assert [r[1] for r in records(cut + after)][:2] == name(0, 1) and records(cut + after)[-1][1] == "<urn:page:9>"
    assert gaps(cut)[-1] == (0, len(cut))
    checksum = whole[:-8] + bytes([whole[-8] ^ 1]) + whole[-7:]
    assert [r[1] for r in records(checksum + after)] == name(0, 1, 2, 3, 4, 5, 9) and gaps(checksum + after) == [(0, len(checksum))]


def test_files_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "ROW_BYTES", 1000)
    monkeypatch.setattr(warc, "FILE_BYTES", 8000)
    noise = random.Random(3)
    rows = [(i, "u", noise.randbytes(size // 2).hex()) for i, size in enumerate([200] * 60 + [40_000, 10, 3_000, 9_000, 10] + [200] * 20)]
    path = scratch_path(spark, "warc-bytes")
    warc.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), path)
    sizes = [os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("part-")]
    assert len(sizes) >= 6 and sorted(sizes)[-2] < 8000 + 9000 and max(sizes) < 8000 + 40_000
    got = warc.intact(warc.read_archives(spark, path)).collect()
    assert sorted((r["page_id"], r["payload"].decode()) for r in got) == sorted((i, html) for i, _, html in rows)


def test_damage_is_an_error(spark):
    path = scratch_path(spark, "warc-damage")
    warc.write_archives(spark.createDataFrame([(i, "u", f"<p>{i}</p>") for i in range(5)], PAGES).coalesce(1), path)
    assert warc.intact(warc.read_archives(spark, path)).count() == 5
    (name,) = [f for f in os.listdir(path) if f.startswith("part-")]
    with open(os.path.join(path, name), "rb") as file:
        data = bytearray(file.read())
    data[60] ^= 0x5A
    broken = scratch_path(spark, "warc-damaged")
    os.makedirs(broken)
    with open(os.path.join(broken, name), "wb") as file:
        file.write(data)
    rows = warc.read_archives(spark, broken)
    assert rows.where("kind = 'gap'").count() >= 1
    with pytest.raises(Exception, match="damaged archive"):
        warc.intact(rows).collect()
