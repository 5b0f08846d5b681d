"""Building the validation cohort: contracts, per-person predictions, the join, group sizes and group order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlens.config import (
    ESTIMATE,
    ESTIMATE_SE,
    GROUP,
    GROUP_CODES,
    ID,
    OTHER,
    OVERALL,
    PART_ESTIMATE,
    PART_UNCERTAINTY,
    TRUTH,
)
from cohortlens.functions.scalars import nan_to_null, normal_ci, overall_or, to_nmol
from cohortlens.operators.joins import HOT_ROWS, attach, left_join_skewed, null_safe_join


#: Codes that an error names; it says how many others there are.
_SHOWN_CODES = 20

# ---- contracts -------------------------------------------------------------------------------------------------


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` itself, or an error that names the missing mandatory columns."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError("The table lacks the columns " + ", ".join(missing))
    return df


def available_columns(df: DataFrame, wanted: Sequence[str], at_least: int = 0, exclude: Sequence[str] = (),
                      extra: int = 3) -> list[str]:
    """The wanted columns that exist, in the wanted order; up to ``extra`` others if fewer than ``at_least``."""
    found = [c for c in wanted if c in df.columns]
    if len(found) < at_least:
        others = [c for c in df.columns if c not in found and c not in exclude]
        found += others[:extra]
    return found


def domain_violations(df: DataFrame, col: str = GROUP, valid: Sequence[str] = GROUP_CODES) -> DataFrame:
    """Distinct values of ``col`` outside the valid set; NULL is a violation."""
    return df.filter(~F.coalesce(F.col(col).isin(list(valid)), F.lit(False))).select(col).distinct()


def require_domain(df: DataFrame, col: str = GROUP, valid: Sequence[str] = GROUP_CODES) -> DataFrame:
    """``df`` itself, or an error that shows values outside the valid set and says how many there are."""
    outside = domain_violations(df, col, valid)
    total = outside.count()
    if total:
        shown = sorted(str(r[0]) for r in outside.limit(_SHOWN_CODES).collect())
        more = f" and {total - len(shown)} more" if total > len(shown) else ""
        raise ValueError(f"{total} codes of {col} are not among {', '.join(valid)}: {', '.join(shown)}{more}")
    return df


# ---- preparation of the inputs ---------------------------------------------------------------------------------


def max_per_person(df: DataFrame, id_col: str, value: str, unit: str | None = None, out: str = TRUTH) -> DataFrame:
    """Largest measurement per person, after conversion to nmol/L where a unit column says mg/dL."""
    v = to_nmol(F.col(value), F.col(unit)) if unit else F.col(value)
    return df.groupBy(id_col).agg(F.max(nan_to_null(v)).alias(out))


def code_flag(df: DataFrame, id_col: str, code: str, flags: dict[str, str], times: int = 2) -> DataFrame:
    """One boolean column per entry of ``flags`` (column name to code): the code occurs at least ``times`` times."""
    return df.groupBy(id_col).agg(
        *[(F.count_if(F.col(code) == value) >= times).alias(name) for name, value in flags.items()]
    )


def id_overlap(a: DataFrame, b: DataFrame, id_col: str = ID) -> DataFrame:
    """One row: number of distinct ids in both tables, only in the first, only in the second."""
    marked = a.select(id_col, F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionByName(
        b.select(id_col, F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
    )
    per_id = marked.groupBy(id_col).agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    return per_id.agg(
        F.count_if((F.col("in_a") == 1) & (F.col("in_b") == 1)).alias("n_both"),
        F.count_if(F.col("in_b") == 0).alias("n_first_only"),
        F.count_if(F.col("in_a") == 0).alias("n_second_only"),
    )


# ---- predictions and the join ----------------------------------------------------------------------------------


def pred_summary(
    parts: DataFrame, id_col: str = ID, part: str = PART_ESTIMATE, uncertainty: str = PART_UNCERTAINTY, z: float = 1.96
) -> DataFrame:
    """Per person: sum of the parts, independent errors combined, and a normal interval.

    A missing part makes the person's value missing (a plain sum would skip it).
    """

    def strict_sum(c: Column) -> Column:
        c = nan_to_null(c)
        return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))

    u = F.col(uncertainty)
    per_id = parts.groupBy(id_col).agg(
        strict_sum(F.col(part)).alias(ESTIMATE), F.sqrt(strict_sum(u * u)).alias(ESTIMATE_SE)
    )
    return normal_ci(per_id, ESTIMATE, ESTIMATE_SE, z, "lpa_pred_lci95", "lpa_pred_uci95")


def join_pred_measured(
    pred: DataFrame, measured: DataFrame, id_col: str = ID, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Keep every predicted person, with measurements where there are any (ids match null-safely)."""
    return left_join_skewed(pred, measured, id_col, hot_rows)


def complete_pairs(df: DataFrame, truth: str = TRUTH, estimate: str = ESTIMATE) -> DataFrame:
    """Rows with both a measured and a predicted value."""
    return df.filter(
        nan_to_null(F.col(truth)).isNotNull() & nan_to_null(F.col(estimate)).isNotNull()
    )


# ---- group sizes and order -------------------------------------------------------------------------------------


def group_counts(df: DataFrame, group: str = GROUP) -> DataFrame:
    """Rows per group, largest first."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(group))


def add_group_size(df: DataFrame, group: str = GROUP, out: str = "n") -> DataFrame:
    """Attach the group's row count to each row: an aggregate joined back, so no group meets in one task."""
    return attach(df, df.groupBy(group).agg(F.count(F.lit(1)).alias(out)), [group])


def min_group_filter(df: DataFrame, group: str = GROUP, more_than: int = 20) -> DataFrame:
    """Rows of groups with more than ``more_than`` rows, with the group size as ``n``."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > more_than)
    return attach(df, sizes, [group], "inner")


def validation_cohort(joined: DataFrame, more_than: int = 20) -> DataFrame:
    """Complete pairs of sufficiently large groups."""
    return min_group_filter(complete_pairs(joined), GROUP, more_than)


def total_count(df: DataFrame) -> DataFrame:
    """Attach the table's row count, computed once as a scalar."""
    return df.withColumn("total_count", df.agg(F.count(F.lit(1))).scalar())


def group_sizes(df: DataFrame, group: str = GROUP) -> DataFrame:
    """Size of each group and of the whole cohort (row ``Overall``)."""
    return (
        df.groupingSets([[group], []], group)
        .agg(overall_or(group).alias("__name"), F.count(F.lit(1)).alias("pop_size"))
        .select(F.col("__name").alias(group), "pop_size")
    )


def group_order(df: DataFrame, group: str = GROUP) -> DataFrame:
    """Groups numbered by size, largest first, ties by code, ``Other`` always last.

    The window runs over one row per group.
    """
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    by_size = Window.orderBy(
        F.coalesce(F.col(group) == OTHER, F.lit(False)), F.desc("n"), F.asc_nulls_last(group)
    )
    return counts.withColumn("ord", F.row_number().over(by_size).cast("bigint"))


def order_join(table: DataFrame, order: DataFrame, group: str = GROUP) -> DataFrame:
    """Attach ``ord`` to a result table: Overall is 0, groups outside the order keep their name and have none."""
    with_order = null_safe_join(table, order.select(group, "ord"), [group])
    return with_order.withColumn("ord", F.when(F.col(group) == OVERALL, F.lit(0)).otherwise(F.col("ord")).cast("bigint"))


def overall_first(table: DataFrame, order: DataFrame, *then: str, group: str = GROUP) -> DataFrame:
    """Sort a result table: Overall, groups in order, groups outside the order last."""
    return order_join(table, order, group).orderBy(F.asc_nulls_last("ord"), F.asc_nulls_last(group), *then)


def take_n(df: DataFrame, n: int, *by: Column) -> DataFrame:
    """First ``n`` rows of a total order."""
    return df.orderBy(*by).limit(n)


def headline(parts: DataFrame, measured: DataFrame, valid: DataFrame, overall_numeric: DataFrame,
             truth: str = TRUTH) -> DataFrame:
    """One row of cohort counts with overall R2 and RMSE (``overall_numeric`` has one row per metric).

    Persons count once, however many parts their prediction has.
    """

    def metric(name: str, digits: int) -> Column:
        return F.bround(F.max(F.when((F.col("metric") == name) & (F.col(GROUP) == OVERALL), F.col("estimate"))), digits)

    persons = parts.select(ID).distinct().agg(F.count(F.lit(1))).scalar()
    counts = measured.agg(
        F.count(F.lit(1)).alias("n_measured_rows"), F.count(nan_to_null(F.col(truth))).alias("n_measured")
    )
    numbers = overall_numeric.agg(metric("rsq", 3).alias("rsq"), metric("rmse", 1).alias("rmse"))
    return counts.select(
        persons.alias("n_genotyped"),
        "n_measured_rows",
        "n_measured",
        valid.agg(F.count(F.lit(1))).scalar().alias("n_validated"),
        numbers.select("rsq").scalar().alias("rsq"),
        numbers.select("rmse").scalar().alias("rmse"),
    )
