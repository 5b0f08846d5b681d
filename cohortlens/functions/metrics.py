"""Formulas of the agreement metrics over sufficient statistics, with their undefined cases as NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def confusion_metrics(tp: Column, fp: Column, tn: Column, fn: Column) -> dict[str, Column]:
    """Classification metrics with the elevated class as the event.

    ppv and npv go through prevalence, so they also need both true classes; f_meas needs a defined, non-zero
    precision and recall.
    """
    pos, neg, called, rejected = tp + fn, tn + fp, tp + fp, tn + fn
    both = (pos > 0) & (neg > 0)
    return {
        "sens": F.when(pos > 0, tp / pos),
        "spec": F.when(neg > 0, tn / neg),
        "ppv": F.when(both & (called > 0), tp / called),
        "npv": F.when(both & (rejected > 0), tn / rejected),
        "accuracy": F.when(pos + neg > 0, (tp + tn) / (pos + neg)),
        "f_meas": F.when(tp > 0, 2 * tp / (2 * tp + fp + fn)),
    }


def relative_error(truth: Column, estimate: Column) -> Column:
    """``|truth - estimate| / |truth|``: Infinity for a zero truth that was missed, missing for 0/0."""
    d = F.abs(truth - estimate)
    return F.when(truth != 0, d / F.abs(truth)).when(d != 0, F.lit(float("inf")))


def numeric_metrics(truth: Column, estimate: Column) -> dict[str, Column]:
    """Aggregates rsq (squared correlation), mape (percent) and rmse of complete pairs."""
    d = truth - estimate
    rel = relative_error(truth, estimate)
    varies = (F.min(truth) < F.max(truth)) & (F.min(estimate) < F.max(estimate))
    # Not corr(): it raises on a constant column under ANSI rules.
    cov, product = F.covar_pop(truth, estimate), F.var_pop(truth) * F.var_pop(estimate)
    return {
        "rsq": F.when(varies & (product > 0), cov * cov / product),
        "mape": F.when(F.count(rel) == F.count(F.lit(1)), F.avg(rel) * 100),
        "rmse": F.sqrt(F.avg(d * d)),
    }


#: Weighted sums from which the numeric metrics of one resample follow (truth and estimate centred beforehand).
NUMERIC_SUMS = ("n", "sy", "sx", "syy", "sxx", "sxy", "sdd", "srel", "n_inf", "n_undef")


def numeric_terms(truth: Column, estimate: Column, centre_y: float, centre_x: float) -> dict[str, Column]:
    """Per-row terms of ``NUMERIC_SUMS``; infinite and undefined relative errors are counted, not summed."""
    y, x, d = truth - centre_y, estimate - centre_x, truth - estimate
    rel = relative_error(truth, estimate)
    one, zero = F.lit(1.0), F.lit(0.0)
    return {
        "n": one,
        "sy": y,
        "sx": x,
        "syy": y * y,
        "sxx": x * x,
        "sxy": x * y,
        "sdd": d * d,
        "srel": F.when(truth != 0, rel).otherwise(zero),
        "n_inf": F.when((truth == 0) & (d != 0), one).otherwise(zero),
        "n_undef": F.when((truth == 0) & (d == 0), one).otherwise(zero),
    }


def numeric_from_sums() -> dict[str, Column]:
    """The numeric metrics of one resample from its ``NUMERIC_SUMS`` columns."""
    c = {name: F.col(name) for name in NUMERIC_SUMS}
    vy = c["syy"] - c["sy"] * c["sy"] / c["n"]
    vx = c["sxx"] - c["sx"] * c["sx"] / c["n"]
    cov = c["sxy"] - c["sx"] * c["sy"] / c["n"]
    # A variance that is only rounding noise counts as zero.
    varies = (vy > 1e-13 * c["syy"]) & (vx > 1e-13 * c["sxx"])
    return {
        "rsq": F.when(varies, cov * cov / (vy * vx)),
        "mape": F.when(c["n_undef"] > 0, F.lit(None).cast("double"))
        .when(c["n_inf"] > 0, F.lit(float("inf")))
        .otherwise(c["srel"] / c["n"] * 100),
        "rmse": F.sqrt(c["sdd"] / c["n"]),
    }
