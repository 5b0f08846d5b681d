import pytest

from cohortlens.operators import summary


@pytest.fixture
def people(spark):
    rows = [(g, float(20 + i), "Male" if i % 3 else "Female", i % 2 == 0, False if i else None, float(i % 4), None if i % 5 == 0 else float(i))
            for i in range(40) for g in (["A"] if i % 4 else ["B"])]
    return spark.createDataFrame(rows, "GIA string, age double, sex string, HTN boolean, DM boolean, grade double, lpa_nmol_max double")


def test_kinds_of_columns(people):
    cols = ["age", "sex", "HTN", "grade", "lpa_nmol_max"]
    assert summary.split_by_kind(people, cols) == (["age", "lpa_nmol_max"], ["sex", "HTN", "grade"])


def test_continuous_drops_missing(people):
    got = {r["variable"]: r for r in summary.summary_continuous(people, ["age", "lpa_nmol_max"]).collect()}
    assert (got["age"]["p25"], got["age"]["median"], got["age"]["p75"]) == (29.75, 39.5, 49.25)
    assert got["lpa_nmol_max"]["n"] == 32


def test_categorical_levels_and_logicals(people):
    got = {(r["stratum"], r["variable"], r["level"]): r for r in summary.summary_categorical(people, ["sex", "HTN", "DM", "grade"], "GIA").collect()}
    assert got[("B", "HTN", "TRUE")]["n"] == 10 and got[("B", "HTN", "TRUE")]["pct"] == 100
    assert ("B", "HTN", "FALSE") not in got
    assert got[("A", "DM", "TRUE")]["n"] == 0 and got[("A", "DM", "TRUE")]["pct"] == 0
    assert got[("A", "sex", "Male")]["n"] + got[("A", "sex", "Female")]["n"] == 30
    assert {k[2] for k in got if k[1] == "grade"} == {"0.0", "1.0", "2.0", "3.0"}


def test_tidy_has_true_groups_and_levels(people):
    tidy = summary.demographics(people, "GIA")
    rows = {(r["variable"], r["level"], r["stratum"]): r for r in tidy.collect()}
    assert {k[2] for k in rows} == {"A", "B"} and ("sex", "Male", "B") in rows
    assert rows[("age", None, "B")]["value"] == "38.0 (29.0, 47.0)" and rows[("age", None, "B")]["label"] == "Age (years)"
    assert rows[("HTN", "TRUE", "B")]["value"] == "10 (100.0%)"
    overall = summary.demographics(people)
    assert {r["stratum"] for r in overall.collect()} == {"Overall"}


def test_without_demographic_columns(spark):
    bare = spark.createDataFrame([("A", 1), ("B", 2)], "code string, v int")
    assert [(r["variable"], r["value"]) for r in summary.demographics(bare).collect()] == [("cohort_size", "2")]


def test_fallback(people):
    got = {r["stratum"]: r for r in summary.summary_fallback(people, "GIA").collect()}
    assert got["A"]["cohort_size"] == 30 and got["B"]["cohort_size"] == 10


def test_few_demographic_columns_take_others(spark):
    df = spark.createDataFrame([("A", 1, 2.0, "x", "u", 5)] * 3, "GIA string, ID int, lpa_nmol_max double, site string, arm string, n int")
    by_group = {r["variable"] for r in summary.demographics(df, "GIA").collect()}
    assert by_group == {"lpa_nmol_max", "site", "arm"}
    assert {r["variable"] for r in summary.demographics(df).collect()} == {"lpa_nmol_max", "GIA"}
    wide = summary.wide_by_group(summary.demographics(df, "GIA"), ["A", "B"])
    assert wide.columns == ["variable", "label", "level", "A", "B"] and wide.filter("B is not null").count() == 0
