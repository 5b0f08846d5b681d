"""Preparation and quality control of long-form genotype calls: one row per variant and sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

VARIANT = ["chrom", "pos", "ref", "alt"]

# Accepted names of the chromosome, and the two default regions (inclusive).
CHROM_NAMES = ("6", "chr6")
CHROM = "chr6"
TARGET_REGION = ("chr6", 159_500_000, 161_700_000)
EXTRACTION_REGION = ("chr6", 160_400_000, 160_800_000)


def detect_chrom_naming(calls: DataFrame) -> DataFrame:
    """Which of the accepted chromosome names the calls use (``6`` before ``chr6`` if both); one row, NULL if none."""
    return calls.agg(
        F.when(F.count_if(F.col("chrom") == CHROM_NAMES[0]) > 0, F.lit(CHROM_NAMES[0]))
        .when(F.count_if(F.col("chrom") == CHROM_NAMES[1]) > 0, F.lit(CHROM_NAMES[1]))
        .alias("chrom_naming")
    )


def require_chrom(calls: DataFrame) -> DataFrame:
    """``calls`` itself, or an error if neither chromosome name occurs."""
    if not calls.filter(F.col("chrom").isin(*CHROM_NAMES)).limit(1).count():
        raise ValueError("calls contain neither chromosome '6' nor 'chr6'")
    return calls


def normalize_chrom(calls: DataFrame) -> DataFrame:
    """Chromosome ``6`` renamed to ``chr6``."""
    return calls.withColumn("chrom", F.when(F.col("chrom") == CHROM_NAMES[0], F.lit(CHROM)).otherwise(F.col("chrom")))


def region_filter(
    calls: DataFrame, region: tuple[str, int, int] = EXTRACTION_REGION, names: Sequence[str] | None = None
) -> DataFrame:
    """Records whose span ``pos .. pos + len(ref) - 1`` overlaps the inclusive region.

    ``names`` are accepted for the region's chromosome (default: its own name). Tests of columns as they are stored
    reach the file scan, so filter by all names first and rename the chromosome afterwards.
    """
    chrom, first, last = region
    return calls.filter(
        F.col("chrom").isin(*(names or (chrom,))) & (F.col("pos") <= last) & (F.col("pos") + F.length("ref") - 1 >= first)
    )


def strip_fields(calls: DataFrame) -> DataFrame:
    """Only the variant, the sample and the genotype."""
    return calls.select(*VARIANT, "sample", "gt")


def site_intersect(calls: DataFrame, sites: DataFrame, region: tuple[str, int, int] = EXTRACTION_REGION) -> DataFrame:
    """Calls inside the region whose position and alleles all equal those of a site; the chromosome is renamed.

    The first wanted position (one look at the sites) bounds the scan of the calls from below.
    """
    names = CHROM_NAMES if region[0] in CHROM_NAMES else None
    wanted = normalize_chrom(region_filter(sites, region, names)).select(*VARIANT)
    first = wanted.agg(F.min("pos")).first()[0]
    inside = region_filter(calls, region, names).filter(F.col("pos") >= (region[1] if first is None else first))
    return normalize_chrom(inside).join(wanted, VARIANT, "left_semi")


def missing_sites(sites: DataFrame, extracted: DataFrame) -> DataFrame:
    """Sites without any extracted call."""
    return sites.select(*VARIANT).join(extracted.select(*VARIANT), VARIANT, "left_anti")


def is_missing(gt: Column) -> Column:
    """A genotype with at least one missing allele."""
    return gt.contains(".")


def _genotype_counts(calls: DataFrame) -> DataFrame:
    """Calls per variant and distinct genotype text; all string work below runs on this small table."""
    return calls.groupBy(*VARIANT, "gt").agg(F.count(F.lit(1)).alias("calls"))


def an_ac(calls: DataFrame) -> DataFrame:
    """Per variant: AN, the number of called alleles, and AC, the count of each alternative allele (text, by comma)."""
    counts = _genotype_counts(calls)
    alleles = counts.select(*VARIANT, "calls", F.explode(F.split("gt", "[|/]")).alias("allele"))
    per_allele = (
        alleles.filter(F.col("allele") != ".")
        .groupBy(*VARIANT, F.col("allele").cast("int").alias("allele"))
        .agg(F.sum("calls").alias("c"))
    )
    # Variants without a called allele stay, with zero counts; the list holds one entry per allele of the variant.
    rows = per_allele.unionByName(
        counts.select(*VARIANT, F.lit(0).alias("allele"), F.lit(0).cast("bigint").alias("c")).distinct()
    )
    per_variant = rows.groupBy(*VARIANT).agg(
        F.sum("c").alias("an"), F.map_from_entries(F.collect_list(F.when(F.col("allele") > 0, F.struct("allele", "c")))).alias("by_allele")
    )
    n_alt = F.size(F.split("alt", ","))
    each = F.transform(
        F.sequence(F.lit(1), n_alt), lambda i: F.coalesce(F.col("by_allele")[i], F.lit(0)).cast("string")
    )
    return per_variant.select(*VARIANT, "an", F.array_join(each, ",").alias("ac"))


def site_coverage(sites: DataFrame, extracted: DataFrame) -> DataFrame:
    """One row: sites required (all sites, not only those of the region), sites extracted, and the percentage."""
    required = sites.select(*VARIANT).distinct().agg(F.count(F.lit(1))).scalar()
    found = extracted.select(*VARIANT).distinct().agg(F.count(F.lit(1)).alias("n_extracted"))
    counted = found.withColumn("n_required", required)
    return counted.select(
        "n_required",
        "n_extracted",
        F.when(F.col("n_required") > 0, F.round(F.col("n_extracted") / F.col("n_required") * 100, 1)).alias("coverage_pct"),
    )


def sample_missingness(calls: DataFrame) -> DataFrame:
    """Samples with missing genotypes and how many."""
    return (
        calls.groupBy("sample").agg(F.count_if(is_missing(F.col("gt"))).alias("n_missing")).filter(F.col("n_missing") > 0)
    )


def multiallelic_count(calls: DataFrame) -> DataFrame:
    """One row: number of variants with more than one alternative allele."""
    several = calls.filter(F.col("alt").contains(",")).select(*VARIANT).distinct()
    return several.agg(F.count(F.lit(1)).alias("n_multiallelic"))


def is_phased(calls: DataFrame) -> DataFrame:
    """One row: number of unphased calls, and whether there is none."""
    return calls.agg(F.count_if(F.col("gt").contains("/")).alias("n_unphased")).select(
        "n_unphased", (F.col("n_unphased") == 0).alias("phased")
    )


def _reason(sites_missing: Column, samples_missing: Column) -> Column:
    return (
        F.when(sites_missing > 0, F.lit("sites missing"))
        .when(samples_missing > 0, F.lit("samples missing"))
        .otherwise(F.lit("none"))
    )


def needs_imputation(sites: DataFrame, extracted: DataFrame) -> DataFrame:
    """One row: whether imputation is needed and why; missing sites take precedence over missing genotypes."""
    coverage = site_coverage(sites, extracted)
    samples = sample_missingness(extracted).agg(F.count(F.lit(1))).scalar()
    both = coverage.withColumn("n_samples_missing", samples)
    short = F.col("n_required") - F.col("n_extracted")
    return both.select(
        short.alias("n_sites_missing"),
        "n_samples_missing",
        ((short > 0) | (F.col("n_samples_missing") > 0)).alias("needed"),
        _reason(short, F.col("n_samples_missing")).alias("reason"),
    )


def qc_summary(stages: Sequence[tuple[str, DataFrame]], sites: DataFrame, naming: DataFrame | None = None) -> DataFrame:
    """One row per stage (for example raw, phased, imputed): coverage, samples, missing and multiallelic counts.

    Two aggregates over a stage's calls, one per variant and one per sample, hold everything.
    """
    rows = []
    required = sites.select(*VARIANT).distinct().agg(F.count(F.lit(1))).scalar()
    for name, calls in stages:
        variants = calls.groupBy(*VARIANT).agg(F.count(F.lit(1)).alias("calls")).agg(
            F.count(F.lit(1)).alias("n_extracted"), F.count_if(F.col("alt").contains(",")).alias("n_multiallelic")
        )
        samples = calls.groupBy("sample").agg(F.count_if(is_missing(F.col("gt"))).alias("missing")).agg(
            F.count("sample").alias("n_samples"), F.count_if(F.col("missing") > 0).alias("n_samples_missing")
        )
        # Both sides are aggregates of one row.
        counted = variants.crossJoin(F.broadcast(samples)).withColumn("n_required", required)
        row = counted.select(
            F.lit(name).alias("stage"),
            (naming.select("chrom_naming").scalar() if naming is not None else F.lit(CHROM)).alias("chrom_naming"),
            "n_required",
            "n_extracted",
            F.when(F.col("n_required") > 0, F.round(F.col("n_extracted") / F.col("n_required") * 100, 1)).alias("coverage_pct"),
            "n_samples",
            "n_samples_missing",
            "n_multiallelic",
            _reason(F.col("n_required") - F.col("n_extracted"), F.col("n_samples_missing")).alias("reason"),
        )
        rows.append(row)
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out
