import math

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import cohort, impact

TABLE = "k string, a bigint, n1 bigint, c bigint, n2 bigint"


def brute_fisher(a, n1, c, n2):
    k = a + c
    lo, hi = max(0, k - n2), min(k, n1)
    p = {v: math.comb(n1, v) * math.comb(n2, k - v) for v in range(lo, hi + 1)}
    total = sum(p.values())
    return float(sum(x for x in p.values() if x <= p[a] * (1 + 1e-7)) / total)


def fisher(spark, tables):
    df = spark.createDataFrame([(str(i), *t) for i, t in enumerate(tables)], TABLE)
    got = impact.fisher_exact(df, ["k"], "a", "n1", "c", "n2")
    return [r["p_value"] for r in got.orderBy(F.col("k").cast("int")).collect()]


def test_fisher_known_values(spark):
    # rows (3,1),(1,3) and (2,10),(15,3)
    got = fisher(spark, [(3, 4, 1, 4), (2, 12, 15, 18)])
    assert got[0] == pytest.approx(0.4857142857, abs=1e-10) and got[1] == pytest.approx(5.367241e-4, abs=1e-9)


def test_fisher_brute_force_and_symmetry(spark):
    tables = [(a, 30, c, n2) for a in (0, 1, 7, 29, 30) for c, n2 in ((0, 5), (3, 40), (25, 25), (11, 60))]
    got = fisher(spark, tables)
    for t, p in zip(tables, got):
        assert p == pytest.approx(brute_fisher(*t), rel=1e-9), t
    swapped = fisher(spark, [(c, n2, a, n1) for a, n1, c, n2 in tables])
    assert swapped == pytest.approx(got, rel=1e-9)


def test_fisher_large_margins_and_far_tail(spark):
    got = fisher(spark, [(500, 100_000, 620, 100_000), (50_000, 100_000, 50_000, 100_000), (90_000, 100_000, 10, 100_000), (60, 10_000_000, 0, 10_000_000)])
    assert 1e-4 < got[0] < 1e-3 and got[1] == pytest.approx(1.0) and got[2] == 0.0
    assert got[3] == pytest.approx(2 * 0.5**60, rel=1e-3)


def test_fisher_missing_counts(spark):
    assert fisher(spark, [(None, 5, 1, 5), (1, 5, None, 5), (1, 5, 1, 5)]) == [None, None, 1.0]


def test_nnt_flips_the_bounds_and_guards_zero(spark):
    metrics = spark.createDataFrame(
        [("A", 150.0, "ppv", 0.5, 0.25, 0.8), ("B", 150.0, "ppv", 0.0, 0.0, 0.1), ("C", 150.0, "ppv", None, None, 0.5),
         ("A", 125.0, "ppv", 0.9, 0.9, 0.9), ("A", 150.0, "npv", 0.9, 0.9, 0.9)],
        "GIA string, threshold double, metric string, estimate double, lower_ci double, upper_ci double",
    )
    got = {r["GIA"]: r for r in impact.nnt(metrics).collect()}
    assert (got["A"]["estimate"], got["A"]["lower_ci"], got["A"]["upper_ci"]) == (2.0, 1.25, 4.0)
    assert got["B"]["estimate"] == math.inf and got["B"]["upper_ci"] == math.inf and got["B"]["lower_ci"] == 10.0
    assert got["C"]["estimate"] is None and got["C"]["upper_ci"] is None and len(got) == 3


@pytest.fixture
def prevalence(pairs, spark):
    df = pairs(
        [("A", 160, 170)] * 3 + [("A", 100, 170)] * 2 + [("A", 100, 100)] * 15 + [("B", None, 160)] * 2 + [("B", 100, 100)] * 3
        + [("C", 100, 100)] * 4 + [(None, None, 200)] * 2
    )
    metrics = spark.createDataFrame(
        [("A", 150.0, "ppv", 0.5), ("Overall", 150.0, "ppv", 0.25), ("A", 150.0, "sens", 0.9)],
        "GIA string, threshold double, metric string, estimate double",
    )
    return df, impact.prevalence_table(df, metrics, [150.0, 500.0])


def test_prevalence_counts_everyone_in_overall_only(prevalence):
    got = {(r["GIA"], r["threshold"]): r for r in prevalence[1].collect()}
    assert len(got) == 8 and (None, 150.0) not in got
    total = got[("Overall", 150.0)]
    assert (total["total_count"], total["measured_available_count"], total["predicted_available_count"]) == (31, 27, 31)
    assert (total["measured_elevated_count"], total["predicted_elevated_count"], total["predicted_elevated_adjusted"]) == (3, 9, 2.25)
    a, b = got[("A", 150.0)], got[("B", 150.0)]
    assert (a["total_count"], a["predicted_elevated_adjusted"], a["predicted_elevated_adjusted_pct"]) == (20, 2.5, 12.5)
    assert a["has_ppv_adjustment"] and not b["has_ppv_adjustment"] and b["predicted_elevated_adjusted"] is None
    assert got[("Overall", 500.0)]["measured_elevated_count"] == 0


def test_detection_improvement_and_comparison(prevalence, pairs):
    df, table = prevalence
    improvement = impact.detection_improvement(table)
    got = {(r["GIA"], r["threshold"]): r for r in improvement.collect()}
    a, b, c = got[("A", 150.0)], got[("B", 150.0)], got[("C", 150.0)]
    assert a["clinical_rate_per_1000"] == 150 and a["genetic_rate_per_1000"] == 125
    assert a["improvement_factor"] == pytest.approx(125 / 150) and a["rate_note"] == "PPV adjusted"
    # 2.5 rounds to 2 (half to even)
    assert a["p_value"] == pytest.approx(brute_fisher(2, 20, 3, 20), rel=1e-9)
    assert b["improvement_factor_unadjusted"] == math.inf and b["p_value"] is None and b["improvement_factor"] is None
    assert c["improvement_factor_unadjusted"] is None and c["p_value"] is None
    order = cohort.group_order(cohort.validation_cohort(df, 10))
    rows = impact.detection_comparison(improvement, order).collect()
    assert [r["GIA"] for r in rows] == ["Overall", "A", "B", "C"]
    assert [r["improvement_text"] for r in rows] == ["0.75x", "0.83x", "\u221e", "NA"]
    assert rows[2]["rate_note"] == "Unadjusted (no PPV available)" and rows[2]["genetic_count"] == 2.0
    assert rows[1]["clinical_pct_text"] == "15.0%" and rows[3]["p_value_text"] == "NA" and rows[1]["p_value_text"].startswith("p")


def test_join_ppv_overall_keeps_rows_without_a_ppv(prevalence, spark):
    df, _ = prevalence
    empty = spark.createDataFrame([], "ppv double")
    assert [r["ppv"] for r in impact.join_ppv_overall(impact.prevalence_overall(df, [150.0]), empty).collect()] == [None]


def test_empty_cohort(spark):
    df = spark.createDataFrame([], "ID int, GIA string, lpa_nmol_max double, lpa_pred_nm double")
    row = impact.prevalence_overall(df, [150.0]).first()
    assert row["total_count"] == 0 and row["measured_elevated_count"] == 0 and row["measured_elevated_pct"] is None


def test_whole_support_against_exact_integers(spark):
    """Tables whose support is wider than what is evaluated, with p neither 0 nor 1."""
    from fractions import Fraction

    tables = [(5050, 10000, 4890, 10000), (2600, 100000, 2450, 100000), (40, 9000, 71, 20000)]

    def exact(a, n1, c, n2):
        m = a + c
        low, high = max(0, m - n2), min(m, n1)
        terms = [math.comb(n1, low) * math.comb(n2, m - low)]
        for v in range(low, high):
            terms.append(terms[-1] * (m - v) * (n1 - v) // ((v + 1) * (n2 - m + v + 1)))
        most = terms[a - low] * (10**7 + 1) // 10**7
        return float(Fraction(sum(t for t in terms if t <= most), sum(terms)))

    df = spark.createDataFrame([(i, *t) for i, t in enumerate(tables)], "k int, a long, n1 long, c long, n2 long")
    got = {r["k"]: r["p_value"] for r in impact.fisher_exact(df, ["k"], "a", "n1", "c", "n2").collect()}
    for i, t in enumerate(tables):
        want = exact(*t)
        assert 0 < want < 1 and got[i] == pytest.approx(want, rel=1e-7)
