"""Quality control of genotype calls against the model's sites."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortlens.operators import calls as ops
from cohortlens.sources.scratch import written


def prepare_calls(
    calls: DataFrame, sites: DataFrame, region: tuple[str, int, int] = ops.EXTRACTION_REGION, stage: str = "raw",
    later: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Extracted calls and their quality-control tables; the extracted calls are written once.

    ``later`` names the calls after further stages (for example phased, then imputed), in order. They are extracted like
    the first ones and get a row each in the summary; the other tables describe the last stage.
    """
    naming = ops.detect_chrom_naming(ops.require_chrom(calls))
    named_sites = ops.normalize_chrom(sites)
    stages = []
    for name, own in {stage: calls, **(later or {})}.items():
        stages.append((name, written(ops.strip_fields(ops.site_intersect(own, sites, region)), "extracted")))
    extracted = stages[-1][1]
    return {
        "calls": extracted,
        "an_ac": ops.an_ac(extracted),
        "missing_sites": ops.missing_sites(named_sites, extracted),
        "samples_with_missing": ops.sample_missingness(extracted),
        "needs_imputation": ops.needs_imputation(named_sites, extracted),
        "summary": ops.qc_summary(stages, named_sites, naming),
    }
