"""Variant files of many samples: lines from the calls there are, and what a record's entries share is read once."""

import os
from types import SimpleNamespace

import pytest

from cohortlens.sources import vcf
from verification import queries
from verification.queries import _variant_lines

CALLS = "chrom string, pos long, ref string, alt string, sample string, gt string"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _inputs(spark, rows):
    return SimpleNamespace(spark=spark, raw_calls=spark.createDataFrame(rows, CALLS))


def test_lines_from_calls_and_gaps(spark, tmp_path):
    held = {(1, "b"): "0|1", (1, "e"): "1|1", (2, "a"): "0|0", (2, "b"): None, (3, "f"): ".|.", (4, "c"): "1|0", (4, "d"): "0|1"}
    header, lines = _variant_lines(_inputs(spark, [("6", p, "A", "G", s, g) for (p, s), g in held.items()]))
    assert header.first()["value"].split("\t")[9:] == list("abcdef")
    # No look-up in a map for every sample of every line.
    assert "map_from_entries" not in _plan(lines)
    for part in (header, lines):
        part.write.mode("append").text(str(tmp_path / "v"))
    got = {(r["pos"], r["sample"]): r["gt"] for r in vcf.read_calls_vcf(spark, str(tmp_path / "v"), 2).collect()}
    assert got == {(p, s): held.get((p, s)) or ".|." for p in (1, 2, 3, 4) for s in "abcdef"}


def test_call_without_a_sample_is_an_error(spark):
    _, lines = _variant_lines(_inputs(spark, [("6", 1, "A", "G", "a", "0|1"), ("6", 1, "A", "G", None, "0|1")]))
    with pytest.raises(Exception, match="without a sample"):
        lines.collect()


def test_shared_fields_are_parsed_once_per_record(spark, tmp_path):
    (tmp_path / "x.vcf").write_text("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\n6\t5\t.\tA\tG\t.\t.\t.\tGT:DS\t0|1:1\t:2\n")
    got = vcf.read_calls_vcf(spark, str(tmp_path / "x.vcf"))
    above, below = _plan(got).split("Generate", 1)
    assert "array_position" in below and "array_position" not in above
    assert sorted((r["sample"], r["gt"]) for r in got.collect()) == [("S1", "0|1"), ("S2", "")]


def test_text_of_many_samples_takes_little_disk(spark, tmp_path, monkeypatch):
    """2000 records of 300 samples are 3.7 MB of text, from 2000 calls."""
    rows = [("6", p, "A", "G", f"s{p % 300:03d}", "0|1") for p in range(2000)]
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(queries, "Inputs", lambda spark, sf_dir: _inputs(spark, rows))
    got = queries.QUERIES["read_calls_vcf"](spark, "")
    assert got.count() == 600_000 and got.filter("gt = '0|1'").count() == 2000
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(tmp_path / "calls-vcf") for f in files)
    assert size < 300_000


def test_text_in_enough_tasks_is_not_shuffled(spark, tmp_path):
    header = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\n"
    for i in range(6):
        (tmp_path / f"{i}.vcf").write_text(header + f"6\t{i}\t.\tA\tG\t.\t.\t.\tGT\t0|1\n" * 200_000)
    assert "Repartition" not in _plan(vcf.read_calls_vcf(spark, str(tmp_path), 2))
    one = vcf.read_calls_vcf(spark, str(tmp_path / "0.vcf"), 64)
    assert "Repartition" in _plan(one) and one.rdd.getNumPartitions() == 64 and one.count() == 200_000
