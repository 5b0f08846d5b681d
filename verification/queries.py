"""One registered query per operator, over whole tables of a scale-factor folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortlens import ValidationConfig
from cohortlens.config import ESTIMATE, GROUP, ID, PART_ESTIMATE, PART_UNCERTAINTY, TRUTH
from cohortlens.functions import scalars
from cohortlens.operators import agreement, calls, cohort, exactsums, impact, intervals, packed, plotdata, replicates, report, resample, sampling, sketches, summary
from cohortlens.plans.genotypes import prepare_calls
from cohortlens.plans.validation import validate
from cohortlens.sources import blockgzip, runs, tables, vcf
from cohortlens.sources.scratch import scratch_path, written
from verification.inputs import CHROM_OFFSET, THRESHOLDS, Inputs, rounded

REPLICATES = 20
FULL_REPLICATES = 1000
SEED = 7
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    """Register a query written as a function of the inputs."""

    def keep(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
        return build

    return keep


def _point_metrics(i: Inputs) -> DataFrame:
    """The metric table without resampling; written because several branches of a query read it."""
    valid = written(i.valid, "valid")
    return written(
        agreement.union_metrics(
            agreement.point_metrics_numeric(valid), agreement.point_metrics_class(valid, THRESHOLDS)
        ),
        "point-metrics",
    )


def _valid(i: Inputs) -> DataFrame:
    """The rows of ``i.valid`` with what a bootstrap reads of them, from pairs that are written first: once for the groups'
    sizes and once for the rows."""
    return written(cohort.min_group_filter(written(i.pairs.select(ID, GROUP, TRUTH, ESTIMATE), "pairs")), "valid")


def _numeric_boot(i: Inputs) -> DataFrame:
    return resample.numeric_boot(_valid(i), FULL_REPLICATES, SEED)


def _class_boot(i: Inputs) -> DataFrame:
    """The bootstrap that a validation run makes, with as many resamples."""
    return resample.class_boot(_valid(i), THRESHOLDS, FULL_REPLICATES, SEED)


# ---- sources, sinks, contracts ---------------------------------------------------------------------------------


@register("read_measured")
def _(i):
    path = scratch_path(i.spark, "measured-csv")
    tables.write_results({"measured": i.measured}, path)
    return rounded(tables.read_measured(i.spark, f"{path}/measured"))


@register("read_predictions")
def _(i):
    path = scratch_path(i.spark, "predictions")
    tables.write_results({"predictions": i.predictions}, path, "parquet")
    return rounded(tables.read_predictions(i.spark, f"{path}/predictions"), 10)


@register("write_results")
def _(i):
    path = scratch_path(i.spark, "results")
    tables.write_results({"group_sizes": cohort.group_sizes(i.valid)}, path)
    return i.spark.read.csv(f"{path}/group_sizes", header=True, nullValue="NA", schema="GIA string, pop_size bigint")


@register("require_columns")
def _(i):
    return cohort.require_columns(i.measured, [ID, TRUTH, GROUP]).select(ID, GROUP)


@register("available_columns")
def _(i):
    return i.measured.select(*cohort.available_columns(i.measured, ["sex", "HLD", "age", "CKD", "DM"]))


@register("domain_violations")
def _(i):
    return cohort.domain_violations(i.joined, GROUP, ["AFR", "AMR", "EAS", "EUR"])


def _variant_lines(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """Header line and record lines of a variant file: one line per variant, samples without a call are missing."""
    raw = written(i.raw_calls, "raw-calls")
    names = raw.select("sample").distinct().agg(F.array_sort(F.collect_list("sample")).alias("s"))
    header = names.select(
        F.concat(F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"), F.array_join("s", "\t")).alias("value")
    )
    # A line is made of its calls and of runs of missing entries between them, not sample by sample.
    places = names.select(F.posexplode("s").alias("place", "of"))
    place = F.coalesce("place", F.raise_error(F.lit("a call without a sample")).cast("int")).alias("place")
    per_variant = raw.join(places, F.col("sample") == F.col("of"), "left").groupBy("chrom", "pos", "ref", "alt").agg(
        F.array_sort(F.collect_list(F.struct(place, F.coalesce("gt", F.lit(".|.")).alias("gt")))).alias("calls")
    )

    def missing(after: Column, before: Column) -> Column:
        return F.repeat(F.lit("\t.|.:1"), before - after - 1)

    entries = F.transform("calls", lambda call, at: F.concat(
        missing(F.coalesce(F.get("calls", at - 1)["place"], F.lit(-1)), call["place"]), F.lit("\t"), call["gt"], F.lit(":1")
    ))
    last = F.element_at("calls", -1)["place"]
    lines = per_variant.withColumn("n", names.select(F.size("s")).scalar()).select(
        F.concat(
            F.concat_ws(
                "\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.lit("PASS"), F.lit("."),
                F.lit("GT:DS"),
            ),
            F.array_join(entries, ""), missing(last, F.col("n")),
        ).alias("value")
    )
    return header.coalesce(1), lines


@register("read_calls_vcf")
def _(i):
    path = scratch_path(i.spark, "calls-vcf")
    for part in _variant_lines(i):
        # A line holds an entry for every sample: compressed, or the text outgrows the calls it is made of many times.
        part.write.mode("append").text(path, compression="deflate")
    return vcf.read_calls_vcf(i.spark, path, 8)


@register("read_calls_vcf_blocks")
def _(i):
    path = scratch_path(i.spark, "calls-vcf-gz")
    for part in _variant_lines(i):
        blockgzip.write_lines(part, path)
    return vcf.read_calls_vcf(i.spark, path, 8)


@register("read_sites")
def _(i):
    path = scratch_path(i.spark, "sites")
    tables.write_results({"sites": i.sites}, path, "parquet")
    return tables.read_sites(i.spark, f"{path}/sites")


@register("commit_run")
def _(i):
    """A run of three tables, read back with its counts and hashes compared."""
    folder = scratch_path(i.spark, "run")
    valid = written(i.valid, "valid")
    runs.commit_run(i.spark, {"sites": i.sites, "sizes": cohort.group_sizes(valid), "summary": i.summary}, folder)
    runs.read_run(i.spark, folder, verify=True)
    return runs.manifests(i.spark, folder).select("table_name", "row_count")


# ---- projections, filters, scalar functions --------------------------------------------------------------------


@register("normal_ci")
def _(i):
    return rounded(
        scalars.normal_ci(i.predictions, PART_ESTIMATE, PART_UNCERTAINTY).select(ID, PART_ESTIMATE, "lower", "upper"), 10
    )


@register("complete_pairs")
def _(i):
    return rounded(i.pairs.select(ID, TRUTH, ESTIMATE))


@register("exceeds")
def _(i):
    t = F.lit(150.0)
    return i.joined.select(
        ID, scalars.exceeds(F.col(TRUTH), t).alias("true_class"), scalars.exceeds(F.col(ESTIMATE), t).alias("pred_class")
    )


@register("strata_key")
def _(i):
    return agreement.classified(i.valid, THRESHOLDS).select(ID, "threshold", "strata")


@register("select_rename")
def _(i):
    return i.valid.drop(ID, "age", "sex").withColumnRenamed("n", "Count").select(GROUP, "Count", "HTN", "DM", "IHD")


@register("prefer_adjusted")
def _(i):
    adjusted = F.when(F.col(GROUP) != "CSA", F.col(TRUTH))
    return rounded(i.joined.select(ID, scalars.prefer_adjusted(adjusted, F.col(ESTIMATE)).alias("value")))


@register("relabel")
def _(i):
    labelled = report.labelled_metrics(agreement.point_metrics_class(i.valid, THRESHOLDS))
    long = agreement.pivot_longer(i.valid, [ID], [ESTIMATE, TRUTH], "measurement", "value")
    kinds = long.groupBy(scalars.measurement_type(F.col("measurement")).alias("performance")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return labelled.groupBy("performance").agg(F.count(F.lit(1)).alias("n")).unionByName(kinds)


def _probe_ratio() -> Column:
    return F.when(F.col(TRUTH) > 0, F.col(ESTIMATE) / F.col(TRUTH))


@register("p_value_band")
def _(i):
    p = F.when(F.col(TRUTH) > 0, F.col("lpa_pred_se") / (100 * F.col(TRUTH)))
    return i.joined.select(scalars.p_value_band(p).alias("band")).groupBy("band").agg(F.count(F.lit(1)).alias("n"))


@register("ratio_label")
def _(i):
    return i.joined.select(ID, scalars.ratio_label(_probe_ratio()).alias("label"))


@register("pct_label")
def _(i):
    return i.joined.select(ID, scalars.pct_label(_probe_ratio() * 100).alias("label"))


@register("ci_label")
def _(i):
    label = scalars.ci_label(F.col(ESTIMATE), F.col("lpa_pred_lci95"), F.col("lpa_pred_uci95"), 1)
    return i.summary.select(ID, label.alias("label"))


@register("group_label")
def _(i):
    return i.valid.select(ID, scalars.group_label(F.col(GROUP), F.col("n")).alias("label"))


@register("round_cols")
def _(i):
    return scalars.round_cols(i.summary.select(ID, "lpa_pred_lci95", "lpa_pred_uci95"), ["lpa_"], 2)


# ---- joins -----------------------------------------------------------------------------------------------------


@register("join_pred_measured")
def _(i):
    return rounded(i.joined)


@register("join_ppv_overall")
def _(i):
    ppv = agreement.metrics_class_by_threshold_grouping(i.valid, [150.0]).filter("GIA = 'Overall'").select("ppv")
    return rounded(impact.join_ppv_overall(impact.prevalence_overall(i.joined, [150.0]), ppv))


@register("join_ppv_group")
def _(i):
    ppv = agreement.metrics_class_by_threshold_grouping(i.valid, [150.0])
    return rounded(impact.join_ppv_group(impact.prevalence_by_group(i.joined, [150.0]), ppv))


@register("join_group_sizes")
def _(i):
    return rounded(plotdata.join_group_sizes(agreement.point_metrics_numeric(i.valid), cohort.group_sizes(i.valid)))


@register("join_fallback_counts")
def _(i):
    return rounded(summary.summary_fallback(i.valid, GROUP))


@register("cross_thresholds")
def _(i):
    return rounded(agreement.cross_thresholds(i.valid.select(ID, GROUP, TRUTH), THRESHOLDS))


@register("site_intersect")
def _(i):
    return calls.site_intersect(calls.strip_fields(calls.normalize_chrom(i.raw_calls)), i.sites)


def _extracted(i: Inputs) -> DataFrame:
    return calls.site_intersect(calls.strip_fields(calls.normalize_chrom(i.raw_calls)), i.sites)


@register("missing_sites")
def _(i):
    return calls.missing_sites(i.sites, _extracted(i))


@register("order_join")
def _(i):
    sizes = cohort.group_sizes(i.valid)
    return cohort.order_join(sizes, cohort.group_order(i.valid))


# ---- aggregations ----------------------------------------------------------------------------------------------


@register("pred_summary")
def _(i):
    return rounded(i.summary)


@register("group_counts")
def _(i):
    return cohort.group_counts(i.joined)


@register("group_sizes")
def _(i):
    return cohort.group_sizes(i.valid)


@register("metrics_numeric")
def _(i):
    return rounded(agreement.metrics_numeric(i.valid))


@register("metrics_numeric_exact")
def _(i):
    return rounded(exactsums.metrics_numeric_exact(i.valid))


@register("exact_sums")
def _(i):
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    terms = {"price": price, "price_quantity": (price, quantity)}
    return rounded(exactsums.exact_sums(i.table("lineitem"), ["l_suppkey"], terms), 2)


@register("metrics_class")
def _(i):
    return rounded(agreement.metrics_class(agreement.confusion_counts(i.valid, THRESHOLDS)))


@register("metrics_class_by_threshold_grouping")
def _(i):
    return rounded(agreement.metrics_class_by_threshold_grouping(i.valid, THRESHOLDS))


@register("prevalence_overall")
def _(i):
    return rounded(impact.prevalence_overall(i.joined, THRESHOLDS))


@register("prevalence_by_group")
def _(i):
    return rounded(impact.prevalence_by_group(i.joined, THRESHOLDS))


def _prevalence(i: Inputs) -> DataFrame:
    joined = written(i.joined, "joined")
    valid = cohort.validation_cohort(joined)
    return impact.prevalence_table(joined, agreement.point_metrics_class(valid, THRESHOLDS), THRESHOLDS)


@register("prevalence_table")
def _(i):
    return rounded(_prevalence(i))


@register("summary_continuous")
def _(i):
    return rounded(summary.summary_continuous(i.valid, ["age", TRUTH, ESTIMATE], GROUP))


@register("summary_continuous_overall")
def _(i):
    return rounded(summary.summary_continuous(i.valid, ["age", TRUTH, ESTIMATE]))


@register("summary_categorical")
def _(i):
    return rounded(summary.summary_categorical(i.valid, ["sex", "HTN", "DM", "IHD"], GROUP))


@register("summary_categorical_overall")
def _(i):
    return rounded(summary.summary_categorical(i.valid, ["sex", GROUP, "HTN", "DM", "IHD"]))


@register("summary_fallback")
def _(i):
    return rounded(summary.summary_fallback(i.valid))


@register("bootstrap_ci")
def _(i):
    resampler = resample.numeric_resampler(_valid(i), FULL_REPLICATES, SEED)
    return rounded(resample.bootstrap_ci(resample.numeric_replicates(resampler), [GROUP, "metric"]))


@register("an_ac")
def _(i):
    return calls.an_ac(_extracted(i))


@register("site_coverage")
def _(i):
    return calls.site_coverage(i.sites, _extracted(i))


@register("sample_missingness")
def _(i):
    return calls.sample_missingness(_extracted(i))


@register("needs_imputation")
def _(i):
    return calls.needs_imputation(i.sites, written(_extracted(i), "extracted"))


@register("multiallelic_count")
def _(i):
    return calls.multiallelic_count(_extracted(i))


@register("qc_summary")
def _(i):
    extracted = written(_extracted(i), "extracted")
    complete = extracted.filter(~calls.is_missing(F.col("gt")))
    naming = calls.detect_chrom_naming(i.raw_calls)
    return calls.qc_summary([("raw", extracted), ("complete", complete)], i.sites, naming)


@register("headline")
def _(i):
    valid = written(i.valid, "valid")
    return cohort.headline(i.predictions, i.measured, valid, agreement.point_metrics_numeric(valid))


# ---- group attachments, order, limits --------------------------------------------------------------------------


@register("add_group_size")
def _(i):
    return cohort.add_group_size(i.joined.select(ID, GROUP))


@register("min_group_filter")
def _(i):
    return rounded(i.valid.select(ID, GROUP, "n"))


@register("total_count")
def _(i):
    return cohort.total_count(i.joined.select(ID, GROUP))


@register("best_group")
def _(i):
    return rounded(report.best_group(agreement.point_metrics_numeric(i.valid)))


@register("resample_index")
def _(i):
    strata = resample.bootstrap_strata(written(i.valid, "valid"), GROUP, seed=SEED)
    return rounded(resample.resample_index(strata, [GROUP], TRUTH, ESTIMATE))


@register("group_order")
def _(i):
    return cohort.group_order(i.pairs)


@register("overall_first")
def _(i):
    return cohort.overall_first(cohort.group_sizes(i.valid), cohort.group_order(i.valid))


@register("take_n")
def _(i):
    return rounded(cohort.take_n(i.valid.select(ID, ESTIMATE), 10, F.desc(ESTIMATE), F.asc(ID)))


# ---- set operations and reshaping ------------------------------------------------------------------------------


@register("union_metrics")
def _(i):
    return rounded(_point_metrics(i))


@register("point_metrics")
def _(i):
    return rounded(agreement.point_metrics_class(i.valid, THRESHOLDS))


@register("union_prevalence")
def _(i):
    joined = i.joined
    return rounded(
        impact.union_prevalence(impact.prevalence_overall(joined, THRESHOLDS), impact.prevalence_by_group(joined, THRESHOLDS))
    )


@register("name_setops")
def _(i):
    present = cohort.available_columns(i.measured, ["HTN", "HLD", "DM"])
    return i.measured.groupBy(*present).agg(F.count(F.lit(1)).alias("n"))


@register("pivot_longer")
def _(i):
    return rounded(agreement.pivot_longer(i.joined, [ID, GROUP], [ESTIMATE, TRUTH], "measurement", "value"))


@register("pivot_wider_numeric")
def _(i):
    return report.pivot_wider_numeric(_numeric_boot(i))


@register("pivot_wider_class")
def _(i):
    return rounded(report.pivot_wider_class(_point_metrics(i)))


@register("threshold_table")
def _(i):
    return rounded(report.threshold_table(_point_metrics(i), THRESHOLDS))


@register("tidy_summary")
def _(i):
    return rounded(summary.tidy_summary(i.valid, ["age", "sex", TRUTH, "HTN", "DM", "IHD"], GROUP))


@register("drop_na")
def _(i):
    return i.joined.select(ID, TRUTH, GROUP).dropna().select(ID, GROUP)


# ---- resampling ------------------------------------------------------------------------------------------------


@register("bootstrap_strata")
def _(i):
    return resample.bootstrap_strata(i.valid, GROUP, seed=SEED).select(ID, GROUP, "stratum")


@register("bootstrap_weights")
def _(i):
    resampler = resample.numeric_resampler(_valid(i), FULL_REPLICATES, SEED)
    return rounded(resampler.weights())


def _weight_vectors(i: Inputs) -> DataFrame:
    resampler = resample.numeric_resampler(_valid(i), FULL_REPLICATES, SEED)
    return written(replicates.weight_vectors(resampler), "weight-vectors")


@register("bootstrap_weight_vectors")
def _(i):
    """Every replicate's weights; the digest is that of the block's counts, joined by commas."""
    digest = F.md5(F.array_join(F.col("weights").cast("array<string>"), ","))
    return rounded(_weight_vectors(i).select("stratum", GROUP, TRUTH, ESTIMATE, "block", digest.alias("digest")))


@register("numeric_boot_from_vectors")
def _(i):
    found = replicates.vector_replicates(_weight_vectors(i), TRUTH, ESTIMATE)
    return rounded(resample.bootstrap_ci(found, [GROUP, "metric"]))


@register("numeric_boot_grouped")
def _(i):
    return rounded(agreement.grouped_only(_numeric_boot(i)))


@register("numeric_boot_overall")
def _(i):
    return rounded(agreement.overall_only(_numeric_boot(i)))


@register("class_boot_grouped")
def _(i):
    return rounded(agreement.grouped_only(_class_boot(i)))


@register("class_boot_overall")
def _(i):
    return rounded(agreement.overall_only(_class_boot(i)))


@register("class_boot_by_cell")
def _(i):
    return rounded(_class_boot(i))


@register("class_boot_by_row")
def _(i):
    return rounded(resample.class_boot(_valid(i), THRESHOLDS, REPLICATES, SEED, by_cell=False))


# ---- impact ----------------------------------------------------------------------------------------------------


@register("nnt")
def _(i):
    return rounded(impact.nnt(_class_boot(i)))


@register("detection_rates")
def _(i):
    rates = impact.detection_rates(_prevalence(i))
    return rounded(
        rates.select(
            GROUP, "threshold", "clinical_rate_per_1000", "genetic_rate_unadjusted_per_1000", "genetic_rate_per_1000",
            "improvement_factor_unadjusted", "improvement_factor",
        )
    )


@register("fisher_exact")
def _(i):
    prevalence = written(_prevalence(i), "prevalence")
    return rounded(impact.detection_improvement(prevalence).select(GROUP, "threshold", "p_value", "rate_note"), 8)


@register("detection_comparison")
def _(i):
    prevalence = written(_prevalence(i), "prevalence")
    table = impact.detection_comparison(impact.detection_improvement(prevalence), cohort.group_order(i.valid))
    return rounded(
        table.select(GROUP, "ord", "total_count", "clinical_count", "clinical_pct", "genetic_count", "genetic_pct",
                     "improvement", "p_value_text", "rate_note", "clinical_pct_text", "genetic_pct_text", "improvement_text")
    )


@register("conclusions")
def _(i):
    return report.conclusions(_point_metrics(i))


# ---- plot data -------------------------------------------------------------------------------------------------


@register("fit_line")
def _(i):
    return rounded(plotdata.fit_line(i.valid), 4)


@register("fit_band")
def _(i):
    return rounded(plotdata.fit_band(plotdata.fit_line(i.valid)), 4)


@register("density")
def _(i):
    return rounded(plotdata.density(written(i.valid, "valid")), 8)


@register("violin_density")
def _(i):
    return rounded(plotdata.violin_density(written(i.valid, "valid")), 6)


@register("box_stats")
def _(i):
    return rounded(plotdata.box_stats(i.valid))


@register("scatter_points")
def _(i):
    return rounded(plotdata.scatter_points(i.valid))


@register("scatter_sample")
def _(i):
    return rounded(sampling.scatter_sample(written(i.valid, "valid"), 300, SEED))


@register("summary_continuous_approx")
def _(i):
    """Sketches per part of the cohort, merged, and held against the exact ranks of all rows."""
    valid, cols, folder = written(i.valid, "valid"), ["age", TRUTH, ESTIMATE], scratch_path(i.spark, "sketches")
    parts = sketches.sketch_parts(valid.withColumn("day", F.pmod(F.col(ID), F.lit(8))), cols, "day", GROUP)
    sketches.store_sketches(parts, folder)
    summed = sketches.approx_summary(sketches.stored_sketches(i.spark, folder))
    return sketches.rank_check(summed, valid, cols, GROUP).select("stratum", "variable", "n", "p", "within")


@register("performance_points")
def _(i):
    valid = written(i.valid, "valid")
    return rounded(plotdata.performance_points(_point_metrics(i), cohort.group_sizes(valid), cohort.group_order(valid)))


@register("nnt_points")
def _(i):
    valid = written(i.valid, "valid")
    table = impact.nnt(agreement.point_metrics_class(valid, THRESHOLDS))
    return rounded(plotdata.nnt_points(table, cohort.group_sizes(valid), cohort.group_order(valid)))


# ---- genotype calls and documented preparation -----------------------------------------------------------------


@register("detect_chrom_naming")
def _(i):
    return calls.detect_chrom_naming(i.raw_calls)


@register("normalize_chrom")
def _(i):
    return calls.normalize_chrom(i.raw_calls)


@register("region_filter")
def _(i):
    return calls.normalize_chrom(calls.region_filter(i.raw_calls, names=calls.CHROM_NAMES))


@register("overlaps")
def _(i):
    """Records of several bases against the regions of all suppliers, over a table laid out by position."""
    folder = scratch_path(i.spark, "laid-out")
    spans = written(i.raw_calls, "raw-calls").withColumn("ref", F.repeat(F.lit("A"), (1 + F.pmod(F.col("pos"), F.lit(7)) * 90).cast("int")))
    intervals.lay_out(spans, folder)
    key = F.col("s_suppkey")
    regions = i.table("supplier").select(
        F.concat(F.lit("r"), key).alias("region"), F.when(key % 10 == 0, "chr6").otherwise("6").alias("chrom"),
        (F.lit(CHROM_OFFSET) + key * 701).alias("first"), (F.lit(CHROM_OFFSET) + key * 701 + key % 1000).alias("last"),
    )
    pairs = intervals.overlaps(intervals.read_laid_out(i.spark, folder), regions)
    return pairs.select("chrom", "pos", "last", "alt", "sample", "region")


@register("strip_fields")
def _(i):
    return calls.strip_fields(i.raw_calls)


def _packed(i: Inputs) -> tuple[DataFrame, DataFrame]:
    found = written(_extracted(i), "extracted")
    samples = packed.sample_places(found)
    return written(packed.pack_calls(found, samples), "packed-calls"), samples


@register("an_ac_packed")
def _(i):
    return packed.packed_an_ac(_packed(i)[0])


@register("sample_missingness_packed")
def _(i):
    return packed.packed_sample_missingness(*_packed(i))


@register("multiallelic_count_packed")
def _(i):
    return packed.packed_multiallelic_count(_packed(i)[0])


@register("unpack_calls")
def _(i):
    return packed.unpack_calls(*_packed(i))


@register("is_phased")
def _(i):
    return calls.is_phased(i.raw_calls)


@register("to_nmol")
def _(i):
    unit = F.when(F.col("event_type") == "click", F.lit("mg/dL")).otherwise(F.lit("nmol/L"))
    return rounded(i.table("events").select("event_id", scalars.to_nmol(F.col("value"), unit).alias("value")))


@register("max_per_person")
def _(i):
    unit = F.when(F.col("event_type") == "click", "mg/dL").when(F.col("event_type") == "view", "nmol/L")
    return rounded(cohort.max_per_person(i.table("events").withColumn("unit", unit), "user_id", "value", "unit"))


@register("code_flag")
def _(i):
    flags = {"clicked": "click", "viewed": "view", "purchased": "purchase"}
    return cohort.code_flag(i.table("events"), "user_id", "event_type", flags)


@register("id_overlap")
def _(i):
    return cohort.id_overlap(i.predictions.select(ID), i.measured.select(ID))



# ---- whole flows -----------------------------------------------------------------------------------------------


def _validated(i: Inputs) -> dict[str, DataFrame]:
    return validate(i.predictions, i.measured, ValidationConfig(do_bootstrap=False))


@register("validate_all_metrics")
def _(i):
    return rounded(_validated(i)["all_metrics"])


@register("validate_prevalence")
def _(i):
    return rounded(_validated(i)["prevalence_by_threshold"])


@register("validate_conclusions")
def _(i):
    return _validated(i)["conclusions"]


@register("prepare_calls_summary")
def _(i):
    raw = written(i.raw_calls, "raw-calls")
    later = {"complete": raw.filter(~calls.is_missing(F.col("gt")))}
    return prepare_calls(raw, i.sites, later=later)["summary"]
