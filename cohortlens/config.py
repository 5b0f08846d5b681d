"""Settings of a validation run and the column names of its input tables."""

from __future__ import annotations

from dataclasses import dataclass

# Default column names of the input tables.
ID = "ID"
GROUP = "GIA"
TRUTH = "lpa_nmol_max"
ESTIMATE = "lpa_pred_nm"
ESTIMATE_SE = "lpa_pred_se"
PART_ESTIMATE = "Lpa_pred_nM"
PART_UNCERTAINTY = "min_uncertainty_nM"

# Accepted group codes, and the names of the two special rows in result tables.
GROUP_CODES = ("AFR", "AMR", "CSA", "EAS", "EUR", "MID", "Other")
OVERALL = "Overall"
OTHER = "Other"

# Metric codes.
NUMERIC_METRICS = ("rsq", "mape", "rmse")
CLASS_METRICS = ("sens", "spec", "ppv", "npv", "accuracy", "f_meas")


@dataclass(frozen=True)
class ValidationConfig:
    """Parameters of one validation run; the defaults are the usual report settings."""

    do_bootstrap: bool = True
    resamples: int = 1000
    thresholds: tuple[float, ...] = (125.0, 150.0, 175.0, 200.0)
    primary_threshold: float = 150.0
    min_group: int = 20
    z: float = 1.96
    ci: tuple[float, float] = (0.025, 0.975)
    pool: float = 0.1
    seed: int = 20240501
    rsq_cut: float = 0.5
