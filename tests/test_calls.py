import gzip

import pytest

from cohortlens.operators import calls as c
from cohortlens.plans.genotypes import prepare_calls
from cohortlens.sources import vcf

CALL = "chrom string, pos bigint, ref string, alt string, sample string, gt string"
SITE = "chrom string, pos bigint, ref string, alt string"


@pytest.fixture
def table(spark):
    rows = [
        ("6", 160500000, "A", "G", "S1", "0|1"), ("6", 160500000, "A", "G", "S2", ".|."),
        ("6", 160500100, "A", "G,T", "S1", "1|2"), ("6", 160500100, "A", "G,T", "S2", "2|2"),
        ("6", 160500200, "A", "C", "S1", ".|1"), ("6", 160500200, "A", "C", "S2", "0/0"),
        ("6", 160399998, "ACGT", "A", "S1", "0|0"), ("6", 160800001, "A", "G", "S1", "0|0"),
    ]
    return spark.createDataFrame(rows, CALL)


@pytest.fixture
def sites(spark):
    rows = [("chr6", 160500000, "A", "G"), ("chr6", 160500100, "A", "G,T"), ("chr6", 160500200, "A", "G"), ("chr6", 160900000, "A", "G")]
    return spark.createDataFrame(rows, SITE)


def test_naming_and_region(table, spark):
    assert c.detect_chrom_naming(table).first()[0] == "6"
    assert c.detect_chrom_naming(c.normalize_chrom(table)).first()[0] == "chr6"
    other = spark.createDataFrame([("7", 1, "A", "G", "S1", "0|0")], CALL)
    assert c.detect_chrom_naming(other).first()[0] is None
    with pytest.raises(ValueError):
        c.require_chrom(other)
    inside = c.region_filter(c.normalize_chrom(table))
    assert {r["pos"] for r in inside.collect()} == {160500000, 160500100, 160500200, 160399998}
    assert c.region_filter(table).count() == 0


def test_extraction_and_quality(table, sites):
    found = c.site_intersect(c.normalize_chrom(table), sites)
    assert {r["pos"] for r in found.collect()} == {160500000, 160500100} and found.count() == 4
    assert {r["pos"] for r in c.missing_sites(sites, found).collect()} == {160500200, 160900000}
    assert tuple(c.site_coverage(sites, found).first()) == (4, 2, 50.0)
    assert [tuple(r) for r in c.sample_missingness(found).collect()] == [("S2", 1)]
    assert tuple(c.needs_imputation(sites, found).first()) == (2, 1, True, "sites missing")
    assert c.multiallelic_count(found).first()[0] == 1
    assert tuple(c.is_phased(table).first()) == (1, False) and tuple(c.is_phased(found).first()) == (0, True)


def test_decision_order(table, sites):
    named = c.normalize_chrom(table)
    two = sites.filter("pos <= 160500100")
    found = c.site_intersect(named, two)
    assert tuple(c.needs_imputation(two, found).first()) == (0, 1, True, "samples missing")
    complete = found.filter("gt not like '%.%'")
    assert tuple(c.needs_imputation(two, complete).first()) == (0, 0, False, "none")


def test_an_ac(table):
    got = {r["pos"]: (r["an"], r["ac"]) for r in c.an_ac(table).collect()}
    assert got[160500000] == (2, "1") and got[160500100] == (4, "1,3") and got[160500200] == (3, "1")
    assert got[160399998] == (2, "0")
    assert c.an_ac(table.filter("gt = '.|.'")).first()["an"] == 0


def test_summary_stages(table, sites):
    out = prepare_calls(table, sites)
    row = out["summary"].first()
    assert (row["stage"], row["chrom_naming"], row["n_required"], row["n_extracted"], row["coverage_pct"]) == ("raw", "6", 4, 2, 50.0)
    assert (row["n_samples"], row["n_samples_missing"], row["n_multiallelic"], row["reason"]) == (2, 1, 1, "sites missing")
    assert out["calls"].columns == ["chrom", "pos", "ref", "alt", "sample", "gt"]
    two = c.qc_summary([("a", out["calls"]), ("b", out["calls"].filter("gt not like '%.%'"))], sites)
    assert [r["n_samples_missing"] for r in two.orderBy("stage").collect()] == [1, 0]


VCF = """##fileformat=VCFv4.2
##contig=<ID=6>
#CHROM	POS	ID	REF	ALT	QUAL	FILTER	INFO	FORMAT	S1	S2
6	160500000	rs1	A	G	.	PASS	AN=4	GT:DS	0|1:1.0	.|.:0
6	160500100	.	A	G,T	.	PASS	.	GT	0|2	1|1
"""


@pytest.mark.parametrize("suffix", ["vcf", "vcf.gz"])
def test_read_vcf(spark, tmp_path, suffix):
    path = tmp_path / f"calls.{suffix}"
    path.write_bytes(gzip.compress(VCF.encode()) if suffix.endswith("gz") else VCF.encode())
    got = sorted(tuple(r) for r in vcf.read_calls_vcf(spark, str(path), 3).collect())
    assert got == [
        ("6", 160500000, "A", "G", "S1", "0|1"), ("6", 160500000, "A", "G", "S2", ".|."),
        ("6", 160500100, "A", "G,T", "S1", "0|2"), ("6", 160500100, "A", "G,T", "S2", "1|1"),
    ]
    assert sorted(tuple(r) for r in vcf.read_sites_vcf(spark, str(path)).collect()) == [
        ("6", 160500000, "A", "G"), ("6", 160500100, "A", "G,T")
    ]


def test_headers_of_one_cohort(spark, tmp_path):
    (tmp_path / "a.vcf").write_text(VCF)
    (tmp_path / "b.vcf").write_text(VCF.replace("160500000", "160500500"))
    assert vcf.read_calls_vcf(spark, str(tmp_path)).count() == 8
    (tmp_path / "c.vcf").write_text(VCF.replace("S1", "S9"))
    with pytest.raises(Exception, match="header line"):
        vcf.read_calls_vcf(spark, str(tmp_path)).collect()
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.vcf").write_text("##only\n")
    with pytest.raises(ValueError, match="header"):
        vcf.read_calls_vcf(spark, str(tmp_path / "d"))


def test_ragged_vcf_is_an_error(spark, tmp_path):
    path = tmp_path / "bad.vcf"
    path.write_text(VCF + "\t".join(["6", "1", ".", "A", "G", ".", ".", ".", "GT", "0|0"]) + "\n")
    with pytest.raises(Exception, match="number of samples"):
        vcf.read_calls_vcf(spark, str(path)).collect()


def test_region_tests_reach_the_scan(spark, tmp_path):
    rows = [("6", p, "A", "G", "S1", "0|1") for p in range(160_390_000, 160_810_000, 10_000)]
    path = str(tmp_path / "calls")
    spark.createDataFrame(rows, CALL).write.parquet(path)
    sites = spark.createDataFrame([("chr6", 160_500_000, "A", "G"), ("6", 160_700_000, "A", "G")], "chrom string, pos long, ref string, alt string")
    found = c.site_intersect(spark.read.parquet(path), sites)
    plan = found._jdf.queryExecution().explainString(found._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "In(chrom, [6,chr6])" in pushed and "GreaterThanOrEqual(pos,160500000)" in pushed and "LessThanOrEqual(pos," in pushed
    assert sorted((r["chrom"], r["pos"]) for r in found.collect()) == [("chr6", 160_500_000), ("chr6", 160_700_000)]


def test_genotype_is_looked_up_in_format(spark, tmp_path):
    head = "##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\n"
    lines = [("DS:GT", "0.9:0|1"), ("DS", "0.98"), ("GT", "1|1"), ("DP:DS:GT", "3:1")]
    path = tmp_path / "odd.vcf"
    path.write_text(head + "".join(f"6\t{i}\t.\tA\tG\t.\t.\t.\t{f}\t{v}\n" for i, (f, v) in enumerate(lines)))
    assert [r["gt"] for r in vcf.read_calls_vcf(spark, str(path)).orderBy("pos").collect()] == ["0|1", None, "1|1", None]


def test_stages_get_a_row_each(table, spark):
    sites = spark.createDataFrame([("chr6", 160_500_000, "A", "G")], "chrom string, pos long, ref string, alt string")
    out = prepare_calls(table, sites, later={"phased": table, "imputed": table.limit(0)})
    rows = out["summary"].collect()
    assert [r["stage"] for r in rows] == ["raw", "phased", "imputed"] and rows[2]["n_extracted"] == 0
