"""Packed genotypes against the long form."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from cohortlens.operators import calls as c, packed as p

CALL = "chrom string, pos bigint, ref string, alt string, sample string, gt string, extra int"


def rows_of(df):
    return sorted(df.collect(), key=str)


def agree(spark, rows, block_samples=100):
    calls = spark.createDataFrame([(*r, 1) for r in rows], CALL)
    samples = p.sample_places(calls, block_samples)
    bits = p.pack_calls(calls, samples)
    assert rows_of(p.packed_an_ac(bits)) == rows_of(c.an_ac(calls))
    assert rows_of(p.packed_sample_missingness(bits, samples)) == rows_of(c.sample_missingness(calls))
    assert rows_of(p.packed_multiallelic_count(bits)) == rows_of(c.multiallelic_count(calls))
    assert rows_of(p.packed_is_phased(bits)) == rows_of(c.is_phased(calls))
    assert rows_of(p.unpack_calls(bits, samples)) == rows_of(calls.drop("extra"))
    return bits, samples


GT = ["0|0", "0|1", "1/1", ".|.", ".", "1", "0|.", "./1", "2|1", "3|0", None, "0|1|2", ".|.|1"]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.sampled_from([1, 2, None]), st.sampled_from(["G,T,C", "G,T,C,AA,AC,AG,AT"]),
    st.sampled_from(["S1", "S2", "S3", None, ""]), st.sampled_from(GT),
), max_size=25))
def test_same_as_the_long_form(spark, rows):
    agree(spark, [("6", pos, "A", alt, sample, gt) for pos, alt, sample, gt in rows], 2)


def test_many_samples_blocks_and_alleles(spark):
    rng = random.Random(1)
    alts = {1: "G", 2: "G,T", 3: ",".join("G" * k for k in range(1, 131))}
    rows = [
        ("6", pos, "A", alt, f"S{s}", "|".join(rng.choice([".", "0", str(rng.randint(0, alt.count(",") + 1))]) for _ in "ab"))
        for pos, alt in alts.items() for s in range(700) if rng.random() < 0.9
    ]
    bits, samples = agree(spark, rows, 150)
    assert samples.select("block").distinct().count() == 5 and samples.count() == 700
    assert bits.count() <= 15
    widths = {r["pos"]: len(r["planes"]) for r in bits.collect()}
    assert widths == {1: 1, 2: 2, 3: 8}


def test_repeated_rows_and_every_bit_of_a_word(spark):
    rows = [("6", 1, "A", "G", f"S{s}", "1|1") for s in range(130)] + [("6", 1, "A", "G", "S5", g) for g in ("1|1", ".|0", None)]
    bits, _ = agree(spark, rows)
    assert {r["layer"] for r in bits.collect()} == {0, 1, 2, 3}


def test_empty_and_malformed(spark):
    agree(spark, [])
    calls = spark.createDataFrame([("6", 1, "A", "G", "S1", "0|2", 1)], CALL)
    with pytest.raises(Exception, match="beyond the variant"):
        p.pack_calls(calls, p.sample_places(calls)).collect()
