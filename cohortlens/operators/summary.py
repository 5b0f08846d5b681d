"""Cohort summary tables: medians with quartiles, counts with shares, and the long text form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cohortlens.config import ESTIMATE, ESTIMATE_SE, GROUP, ID, OVERALL, TRUTH
from cohortlens.functions.scalars import VARIABLE_LABELS, nan_to_null, relabel
from cohortlens.operators.cohort import available_columns
from cohortlens.operators.quantiles import exact_quantiles

# The columns a summary shows if they exist, and how many distinct numbers make a column numeric.
DEMOGRAPHICS = ("age", "sex", "GIA", "lpa_nmol_max", "IHD", "HTN", "HLD", "HF", "CKD", "DM", "AF", "PVD", "IS")
FEW_VALUES = 10
#: Columns that never stand in for missing demographic ones.
PERSON_COLUMNS = (ID, "n", ESTIMATE, ESTIMATE_SE, "lpa_pred_lci95", "lpa_pred_uci95")


def split_by_kind(df: DataFrame, cols: Sequence[str]) -> tuple[list[str], list[str]]:
    """Column names to summarise by quantiles, and those to summarise by level counts.

    Numbers with fewer than ``FEW_VALUES`` distinct values count as levels. One approximate pass settles columns
    with many values; the exact count runs only where that estimate is small, so it shuffles next to nothing.
    """
    types = dict(zip(df.columns, [f.dataType for f in df.schema.fields]))
    numeric = [c for c in cols if isinstance(types[c], T.NumericType)]
    few: list[str] = []
    if numeric:
        estimate = df.agg(*[F.approx_count_distinct(c).alias(c) for c in numeric]).first()
        unsure = [c for c in numeric if estimate[c] < 3 * FEW_VALUES]
        if unsure:
            exact = df.agg(*[F.countDistinct(c).alias(c) for c in unsure]).first()
            few = [c for c in unsure if exact[c] < FEW_VALUES]
    continuous = [c for c in numeric if c not in few]
    return continuous, [c for c in cols if c not in continuous]


def _overall_and_groups(df: DataFrame, group: str | None) -> DataFrame:
    """Rows tagged with their table column: Overall, or their group when one is given."""
    return df.withColumn("stratum", F.col(group) if group else F.lit(OVERALL))


def summary_continuous(df: DataFrame, cols: Sequence[str], group: str | None = None) -> DataFrame:
    """Median and quartiles per variable (and group), missing values dropped."""
    tagged = _overall_and_groups(df, group)
    long = tagged.select("stratum", *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        ["stratum"], list(cols), "variable", "value"
    )
    return exact_quantiles(long, ["stratum", "variable"], "value", {"p25": 0.25, "median": 0.5, "p75": 0.75})


def summary_categorical(df: DataFrame, cols: Sequence[str], group: str | None = None) -> DataFrame:
    """Count and percentage per level (and group) of the non-missing values; logical columns show TRUE only."""
    types = dict(zip(df.columns, [f.dataType for f in df.schema.fields]))
    logical = [c for c in cols if isinstance(types[c], T.BooleanType)]
    tagged = _overall_and_groups(df, group)
    levels = [F.upper(F.col(c).cast("string")) if c in logical else F.col(c).cast("string") for c in cols]
    long = tagged.select("stratum", *[lv.alias(c) for lv, c in zip(levels, cols)]).unpivot(
        ["stratum"], list(cols), "variable", "level"
    )
    known = long.filter(F.col("level").isNotNull())
    counts = known.groupBy("stratum", "variable", "level").agg(F.count(F.lit(1)).alias("n"))
    totals = (
        counts.groupBy("stratum", "variable")
        .agg(F.sum("n").alias("total"))
        .select(F.col("stratum").alias("s"), F.col("variable").alias("v"), "total")
    )
    joined = counts.join(totals, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("variable") == F.col("v")))
    shown = joined.select("stratum", "variable", "level", "n", (F.col("n") / F.col("total") * 100).alias("pct"))
    # A logical column without any TRUE still gets its row.
    missing_true = joined.filter(F.col("variable").isin(logical)).groupBy("stratum", "variable").agg(
        F.count_if(F.col("level") == "TRUE").alias("t")
    ).filter("t = 0").select(
        "stratum", "variable", F.lit("TRUE").alias("level"), F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("pct")
    )
    hidden = F.col("variable").isin(logical) & (F.col("level") == "FALSE")
    return shown.filter(~hidden).unionByName(missing_true) if logical else shown


def summary_fallback(df: DataFrame, group: str | None = None, truth: str = TRUTH) -> DataFrame:
    """Cohort size and mean measured value, overall or per group, in one aggregation."""
    tagged = _overall_and_groups(df, group)
    value = nan_to_null(F.col(truth)) if truth in df.columns else F.lit(None).cast("double")
    return tagged.groupBy("stratum").agg(F.count(F.lit(1)).alias("cohort_size"), F.avg(value).alias("mean_truth"))


def _number(c: Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f", c)


def tidy_summary(df: DataFrame, cols: Sequence[str], group: str | None = None) -> DataFrame:
    """Long table ``variable, label, level, stratum, value, stat_1..3`` of both kinds of summary.

    ``value`` is the text of the table cell; the numbers behind it stay beside it.
    """
    continuous, levels = split_by_kind(df, cols)
    tables = []
    if continuous:
        q = summary_continuous(df, continuous, group)
        text = F.concat(_number(F.col("median")), F.lit(" ("), _number(F.col("p25")), F.lit(", "),
                        _number(F.col("p75")), F.lit(")"))
        tables.append(q.select("variable", F.lit(None).cast("string").alias("level"), "stratum", text.alias("value"),
                               F.col("median").alias("stat_1"), F.col("p25").alias("stat_2"),
                               F.col("p75").alias("stat_3")))
    if levels:
        c = summary_categorical(df, levels, group)
        text = F.concat(F.col("n").cast("string"), F.lit(" ("), _number(F.col("pct")), F.lit("%)"))
        tables.append(c.select("variable", "level", "stratum", text.alias("value"),
                               F.col("n").cast("double").alias("stat_1"), F.col("pct").alias("stat_2"),
                               F.lit(None).cast("double").alias("stat_3")))
    if not tables:
        counts = summary_fallback(df, group)
        return counts.select(F.lit("cohort_size").alias("variable"), F.lit("Cohort Size").alias("label"),
                             F.lit(None).cast("string").alias("level"), "stratum",
                             F.col("cohort_size").cast("string").alias("value"),
                             F.col("cohort_size").cast("double").alias("stat_1"),
                             F.lit(None).cast("double").alias("stat_2"), F.lit(None).cast("double").alias("stat_3"))
    out = tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])
    return out.withColumn("label", relabel(F.col("variable"), VARIABLE_LABELS)).filter(F.col("value").isNotNull())


def demographics(df: DataFrame, group: str | None = None, wanted: Sequence[str] = DEMOGRAPHICS) -> DataFrame:
    """Summary of the demographic columns that exist, overall or by group.

    By group, fewer than two of them are joined by up to three other columns of the table.
    """
    names = [c for c in wanted if c != group]
    if not group:
        return tidy_summary(df, available_columns(df, names))
    return tidy_summary(df, available_columns(df, names, 2, (group, *PERSON_COLUMNS)), group)


def wide_by_group(tidy: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The tidy summary with one text column per group, in the order given; one row per variable and level."""
    columns = [F.max(F.when(F.col("stratum") == g, F.col("value"))).alias(g) for g in groups]
    return tidy.groupBy("variable", "label", "level").agg(*columns).orderBy("variable", F.col("level").asc_nulls_first())
