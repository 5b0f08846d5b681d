"""Prediction-versus-measurement validation of large cohorts, written as Spark DataFrame jobs."""

from cohortlens.config import ValidationConfig

__all__ = ["ValidationConfig"]
