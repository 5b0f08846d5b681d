import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import agreement, exactsums

SCHEMA = "id bigint, g string, a double, b double"


def numbers(n, seed=3):
    """Doubles over the whole range, subnormal ones among them, with much cancellation."""
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        kind = len(out) % 4
        if kind == 0:
            v = struct.unpack("d", rng.randbytes(8))[0]
            v = v if math.isfinite(v) and abs(v) < 1e300 else 5e-324
        elif kind == 1:
            v = -out[rng.randrange(len(out))]
        else:
            v = rng.gauss(0, 1) * 10.0 ** rng.randrange(-12, 12)
        out.append(v)
    return out


def bits(rows):
    return sorted((tuple(None if v is None else struct.pack("d", v) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def wide_range(spark):
    a, b = numbers(3000), [v if abs(v) < 1e150 else 1.5 for v in numbers(3000, 4)]
    rows = [(i, None if i % 5 == 0 else "ab"[i % 2], None if i % 11 == 0 else x, y) for i, (x, y) in enumerate(zip(a, b))]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_sums_are_the_nearest_doubles(wide_range):
    rows, df = wide_range
    terms = {"a": F.col("a"), "b": F.col("b"), "bb": (F.col("b"), F.col("b")), "ab": (F.col("a"), F.col("b"))}
    got = {r["g"]: r for r in exactsums.exact_sums(df, ["g"], terms).collect()}
    assert set(got) == {None, "a", "b"}
    for g, row in got.items():
        own = [(x, y) for _, k, x, y in rows if k == g]
        assert row["a"] == math.fsum(x for x, _ in own if x is not None)
        assert row["b"] == math.fsum(y for _, y in own)
        assert row["bb"] == exactsums.nearest(sum(Fraction(y) ** 2 for _, y in own))
        assert row["ab"] == exactsums.nearest(sum(Fraction(x) * Fraction(y) for x, y in own if x is not None))


def test_same_bits_for_any_partitioning(wide_range):
    rows, df = wide_range
    terms = {"a": F.col("a"), "bb": (F.col("b"), F.col("b"))}
    seen = [bits(exactsums.exact_sums(df.repartition(n, F.xxhash64("id", F.lit(n))), ["g"], terms).collect()) for n in (1, 7, 200)]
    assert seen[0] == seen[1] == seen[2]


def test_metrics_have_the_same_bits_and_agree(pairs):
    rng = random.Random(5)
    data = [("AB"[i % 3 == 0], y, y * 0.8 + rng.gauss(0, 9)) for i, y in enumerate(rng.uniform(1, 300) for _ in range(2000))]
    df = pairs(data)
    seen = [bits(exactsums.metrics_numeric_exact(df.repartition(n)).collect()) for n in (1, 7, 200)]
    assert seen[0] == seen[1] == seen[2]
    plain = {r["GIA"]: r for r in agreement.metrics_numeric(df).collect()}
    exact = {r["GIA"]: r for r in exactsums.metrics_numeric_exact(df).collect()}
    assert set(exact) == set(plain) == {"A", "B", "Overall"}
    for name, row in exact.items():
        assert row[1:] == pytest.approx(plain[name][1:], rel=1e-11)


def test_metrics_keep_digits_far_from_zero(pairs):
    rng = random.Random(6)
    data = [("A", 1e9 + rng.random(), 1e9 + rng.random()) for _ in range(500)]
    y, x = [Fraction(r[1]) for r in data], [Fraction(r[2]) for r in data]
    my, mx = sum(y) / 500, sum(x) / 500
    cov = sum((a - my) * (b - mx) for a, b in zip(y, x))
    rsq = cov**2 / (sum((a - my) ** 2 for a in y) * sum((b - mx) ** 2 for b in x))
    got = {r["GIA"]: r for r in exactsums.metrics_numeric_exact(pairs(data)).collect()}
    assert got["A"]["rsq"] == got["Overall"]["rsq"] == float(rsq)


def test_metrics_edge_rules(pairs):
    rows = [("const", 1, 5), ("const", 2, 5), ("zero", 0, 1), ("zero", 2, 3), ("und", 0, 0), ("und", 1, 2), (None, 1, 1), ("gap", None, 3), ("gap", float("nan"), 1)]
    got = {r["GIA"]: r for r in exactsums.metrics_numeric_exact(pairs(rows)).collect()}
    assert set(got) == {"const", "zero", "und", None, "Overall"}
    assert got["const"]["rsq"] is None and got["const"]["rmse"] == math.sqrt(12.5)
    assert got["zero"]["mape"] == math.inf and got["und"]["mape"] is None
    assert got[None]["mape"] == got[None]["rmse"] == 0.0
    infinite = {r["GIA"]: r for r in exactsums.metrics_numeric_exact(pairs([("A", math.inf, 1), ("A", 1, 1)])).collect()}["A"]
    assert infinite["rsq"] is None and infinite["rmse"] is None


def test_odd_values_empty_tables_and_clashing_columns(spark):
    inf, nan = math.inf, math.nan
    rows = [(1, "nan", nan, 1.0), (2, "nan", 1.0, 1.0), (3, "up", inf, 1.0), (4, "up", 1.0, 1.0), (5, "both", inf, 1.0), (6, "both", -inf, 1.0),
            (7, "down", -inf, 0.0), (8, "none", None, None), (9, "huge", 1.7e308, 1.7e308), (10, "huge", 1.7e308, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"term": F.lit("x"), "limb": F.lit(1), "part": F.lit(2)})
    terms = {"a": F.col("a"), "ab": (F.col("a"), F.col("b"))}
    got = {r["g"]: (r["a"], r["ab"]) for r in exactsums.exact_sums(df, ["g"], terms).collect()}
    assert got["up"][0] == inf and got["none"] == (None, None) and got["huge"] == (inf, inf)
    assert math.isnan(got["nan"][0]) and math.isnan(got["both"][0])
    assert got["down"][0] == -inf and math.isnan(got["down"][1])
    assert exactsums.exact_sums(df.limit(0), ["g"], terms).count() == 0
    assert exactsums.metrics_numeric_exact(df.limit(0), "g", "a", "b").count() == 0
    with pytest.raises(ValueError):
        exactsums.accumulated(df, ["term"], terms)


def test_several_keys_and_merged_parts(wide_range):
    rows, df = wide_range
    keyed = df.withColumns({"day": F.to_date(F.lit("2024-01-01")) + (F.col("id") % 3).cast("int"), "even": F.col("id") % 2 == 0})
    terms = {"a": F.col("a")}
    whole = exactsums.exact_sums(keyed, ["day", "even", "g"], terms).collect()
    assert len(whole) == len({(i % 3, i % 2, g) for i, g, _, _ in rows})
    parts = [exactsums.accumulated(keyed.filter(F.col("id") % 4 == k), ["g"], terms) for k in range(4)]
    joined = exactsums.evaluated(exactsums.merged(*parts), ["g"], ["a"], lambda t: [t["a"].rounded()])
    assert bits(joined.collect()) == bits(exactsums.exact_sums(df, ["g"], terms).collect())
