import pytest
from pyspark.sql import functions as F

from cohortlens import ValidationConfig
from cohortlens.operators import report
from cohortlens.plans.validation import build_cohort, validate, write_run
from cohortlens.sources import scratch, tables
from verification.inputs import Inputs

SMALL = "/root/testdata/sf0.001"
CSV = """ID,lpa_nmol_max,GIA,age,sex,IHD,HTN,site
SAMPLE001,120.5,EUR,65,Male,TRUE,FALSE,x1
SAMPLE002,NA,AFR,45,Female,FALSE,TRUE,NA
SAMPLE003,250.3,"",55,Male,FALSE,,x3
"""


def test_read_measured(spark, tmp_path):
    (tmp_path / "m.csv").write_text(CSV)
    df = tables.read_measured(spark, str(tmp_path / "m.csv"))
    assert dict(df.dtypes)["lpa_nmol_max"] == "double" and dict(df.dtypes)["IHD"] == "boolean" and dict(df.dtypes)["site"] == "string"
    rows = {r["ID"]: r for r in df.collect()}
    assert rows["SAMPLE002"]["lpa_nmol_max"] is None and rows["SAMPLE002"]["site"] is None
    assert rows["SAMPLE003"]["GIA"] is None and rows["SAMPLE003"]["HTN"] is None and rows["SAMPLE001"]["IHD"] is True


def test_read_errors(spark, tmp_path):
    (tmp_path / "m.csv").write_text("ID,GIA\n1,EUR\n")
    with pytest.raises(ValueError, match="lpa_nmol_max"):
        tables.read_measured(spark, str(tmp_path / "m.csv"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        tables.read_measured(spark, str(tmp_path / "none.csv"))


def test_write_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), (None, None)], "k string, v double")
    tables.write_results({"t": df}, str(tmp_path))
    text = "".join(p.read_text() for p in (tmp_path / "t").glob("part-*"))
    assert "NA,NA" in text and "k,v" in text
    paths = tables.write_results({"t": df, "u": df}, str(tmp_path / "pq"), "parquet")
    assert [spark.read.parquet(p).count() for p in paths] == [2, 2]


def test_scratch_uses_the_configured_folder(spark):
    df = scratch.written(spark.range(5).withColumn("x", F.col("id") * 2.0), "t")
    assert df.count() == 5
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert not configured or df.inputFiles()[0].split("//")[-1].startswith(configured.split("//")[-1].rstrip("/"))


@pytest.fixture(scope="module")
def results(spark):
    i = Inputs(spark, SMALL)
    out = validate(i.predictions, i.measured, ValidationConfig(resamples=40))
    return {name: df.toPandas() for name, df in out.items()}


def test_every_table_has_rows(results):
    assert all(len(t) for t in results.values())
    assert set(results["all_metrics"]["metric_type"]) == {"Numeric", "Classification"}


def test_intervals_hold_the_estimates(results):
    m = results["all_metrics"].dropna(subset=["estimate"])
    assert ((m["lower_ci"] <= m["estimate"] + 1e-9) & (m["estimate"] <= m["upper_ci"] + 1e-9)).mean() > 0.99
    assert set(m["GIA"]) == {"Overall", "AFR", "AMR", "CSA", "EAS", "EUR", "MID"}


def test_small_group_has_no_ppv_and_sorts_last(results):
    table = results["detection_comparison"]
    assert table["GIA"].iloc[0] == "Overall" and table["GIA"].iloc[-1] == "Other"
    assert table["rate_note"].iloc[-1].startswith("Unadjusted")


def test_reports(results):
    assert results["numeric_report"]["GIA"].iloc[0] == "Overall" and "(" in results["numeric_report"]["R2"].iloc[0]
    assert results["class_report"].shape == (7, 8)
    assert list(results["threshold_report"]["Threshold"]) == ["125 nmol/L", "150 nmol/L", "175 nmol/L", "200 nmol/L"]
    assert results["conclusions"]["performance"].iloc[0] in ("strong", "moderate")
    assert results["headline"]["n_validated"].iloc[0] == results["group_sizes"].set_index("GIA")["pop_size"]["Overall"]


def test_without_bootstrap(spark):
    i = Inputs(spark, SMALL)
    out = validate(i.predictions, i.measured, ValidationConfig(do_bootstrap=False))
    assert out["all_metrics"].filter("sd is not null").count() == 0 and out["nnt_metrics"].count() == 7


def test_unknown_group_code_is_an_error(spark):
    i = Inputs(spark, SMALL)
    with pytest.raises(ValueError, match="are not among"):
        build_cohort(i.predictions, i.measured.withColumn("GIA", F.lit("XXX")))


def test_best_group_ties_by_name(spark):
    m = spark.createDataFrame([("B", "rsq", 0.7), ("A", "rsq", 0.7), ("Overall", "rsq", 0.9), ("C", "rsq", None)],
                              "GIA string, metric string, estimate double")
    assert report.best_group(m).first()["GIA"] == "A"


def test_a_run_writes_its_result_files(spark, tmp_path):
    i = Inputs(spark, SMALL)
    paths = write_run(validate(i.predictions, i.measured, ValidationConfig(do_bootstrap=False)), str(tmp_path))
    assert len(paths) == 11 and all(spark.read.csv(p, header=True).count() for p in paths)
    wide = spark.read.csv(str(tmp_path / "demographics_by_ancestry"), header=True)
    assert {"variable", "label", "level", "AFR", "EUR"} <= set(wide.columns)
