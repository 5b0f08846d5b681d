"""Column expressions: guards for missing values, class flags, adjusted-value choice and report texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.config import GROUP, OVERALL

# Display labels of the metrics and of the demographic variables.
METRIC_LABELS = {
    "sens": "Sensitivity",
    "spec": "Specificity",
    "ppv": "PPV",
    "npv": "NPV",
    "accuracy": "Accuracy",
    "f_meas": "F1 Score",
}
VARIABLE_LABELS = {
    "lpa_nmol_max": "Lp(a) (nmol/L)",
    "GIA": "Genetic ancestry",
    "age": "Age (years)",
    "sex": "Sex",
    "IHD": "Ischemic heart disease",
    "HTN": "Hypertension",
    "HLD": "Hyperlipidemia",
    "HF": "Heart failure",
    "CKD": "Chronic kidney disease",
    "DM": "Diabetes",
    "AF": "Atrial fibrillation",
    "PVD": "Peripheral vascular disease",
    "IS": "Ischemic stroke",
}

# Fixed value: nmol/L per mg/dL.
NMOL_PER_MG = 2.15


def nan_to_null(c: Column) -> Column:
    """NaN counts as missing."""
    return F.when(~F.isnan(c), c)


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` for non-negative inputs: x/0 is Infinity, 0/0 is missing."""
    return F.when(den != 0, num / den).when((den == 0) & (num > 0), F.lit(float("inf")))


def normal_ci(
    df: DataFrame, estimate: str, se: str, z: float = 1.96, lower: str = "lower", upper: str = "upper"
) -> DataFrame:
    """Add ``estimate -/+ z * se``."""
    return df.withColumns({lower: F.col(estimate) - z * F.col(se), upper: F.col(estimate) + z * F.col(se)})


def exceeds(value: Column, threshold: Column) -> Column:
    """Elevated class: strictly above the threshold."""
    return value > threshold


def strata_key(group: Column, flag: Column, threshold: Column) -> Column:
    """``{group}_{class}_{threshold}``; a missing group prints as NA, whole thresholds without decimals."""
    whole = threshold == F.floor(threshold)
    number = F.when(whole, threshold.cast("bigint").cast("string")).otherwise(threshold.cast("string"))
    return F.concat_ws("_", F.coalesce(group, F.lit("NA")), F.upper(flag.cast("string")), number)


def prefer_adjusted(adjusted: Column, unadjusted: Column) -> Column:
    """The adjusted value where there is one, the unadjusted value otherwise."""
    return F.coalesce(adjusted, unadjusted)


def relabel(code: Column, labels: Mapping[str, str]) -> Column:
    """Code to label; codes without a label stay as they are."""
    out = code
    for key, label in labels.items():
        out = F.when(code == key, F.lit(label)).otherwise(out)
    return out


def measurement_type(name: Column) -> Column:
    """Predicted for column names that contain ``pred``, Measured otherwise."""
    return F.when(name.contains("pred"), F.lit("Predicted")).otherwise(F.lit("Measured"))


def p_value_band(p: Column) -> Column:
    """Text band of a p value."""
    return (
        F.when(p.isNull(), F.lit("NA"))
        .when(p < 0.001, F.lit("p < 0.001"))
        .when(p < 0.01, F.lit("p < 0.01"))
        .when(p < 0.05, F.lit("p < 0.05"))
        .otherwise(F.lit("p \u2265 0.05"))
    )


def ratio_label(value: Column) -> Column:
    """``1.25x``; NA when missing, the infinity sign when infinite."""
    return (
        F.when(value.isNull(), F.lit("NA"))
        .when(F.abs(value) == float("inf"), F.lit("\u221e"))
        .otherwise(F.format_string("%.2fx", value))
    )


def pct_label(value: Column, digits: int = 1) -> Column:
    """``12.3%``; NA when missing."""
    return F.when(value.isNull(), F.lit("NA%")).otherwise(F.format_string(f"%.{digits}f%%", value))


def ci_label(estimate: Column, lower: Column, upper: Column, digits: int = 1, unit: str = "") -> Column:
    """``est (lower-upper)``, each number followed by ``unit``; missing numbers print as NA."""

    def number(c: Column) -> Column:
        shown = F.when(c.isNull(), F.lit("NA")).otherwise(F.format_string(f"%.{digits}f", c))
        return F.concat(shown, F.lit(unit))

    return F.concat(number(estimate), F.lit(" ("), number(lower), F.lit("-"), number(upper), F.lit(")"))


def group_label(group: Column, n: Column) -> Column:
    """``EUR (n = 120)``."""
    return F.concat(F.coalesce(group, F.lit("NA")), F.lit(" (n = "), n.cast("string"), F.lit(")"))


def round_cols(df: DataFrame, prefixes: Sequence[str], digits: int = 2) -> DataFrame:
    """Round half to even all columns whose names start with one of ``prefixes``."""
    chosen = [c for c in df.columns if c.startswith(tuple(prefixes))]
    return df.withColumns({c: F.bround(c, digits) for c in chosen})


def to_nmol(value: Column, unit: Column) -> Column:
    """Measurements in mg/dL converted to nmol/L, others unchanged."""
    return F.when(unit == "mg/dL", value * NMOL_PER_MG).otherwise(value)


def overall_or(group: str = GROUP) -> Column:
    """Group name in a grouping-sets result; the total row is named Overall, a real NULL group stays NULL."""
    return F.when(F.grouping(group) == 1, F.lit(OVERALL)).otherwise(F.col(group))
