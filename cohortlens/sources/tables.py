"""Delimited and parquet tables in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.config import GROUP, ID, PART_ESTIMATE, PART_UNCERTAINTY, TRUTH
from cohortlens.operators.cohort import require_columns

# Types of the known columns of the measured table; other columns stay text unless given a type.
MEASURED_TYPES = {
    ID: "string",
    TRUTH: "double",
    GROUP: "string",
    "age": "double",
    "sex": "string",
    **{flag: "boolean" for flag in ("IHD", "HTN", "HLD", "HF", "CKD", "DM", "AF", "PVD", "IS")},
}
PREDICTION_TYPES = {ID: "string", PART_ESTIMATE: "double", PART_UNCERTAINTY: "double"}
SITE_TYPES = {"chrom": "string", "pos": "bigint", "ref": "string", "alt": "string"}
MISSING = "NA"


def _read(spark: SparkSession, path: str, fmt: str, sep: str) -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(path)
    return spark.read.csv(path, header=True, sep=sep, nullValue=MISSING)


def _typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Known columns cast to their types; blank texts and NaN are missing."""
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = []
    for name, have in fields.items():
        want = types.get(name, have)
        c = F.col(f"`{name}`")
        if have == "string":
            c = F.nullif(F.trim(c), F.lit(""))
        if want != have:
            c = c.cast(want)
        if want in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        out.append(c.alias(name))
    return df.select(*out)


def read_measured(
    spark: SparkSession, path: str, fmt: str = "csv", sep: str = ",", extra_types: Mapping[str, str] | None = None
) -> DataFrame:
    """The measured table, one row per participant; optional columns are kept as they come.

    Types come from the contract, so there is no inference pass over the file. Parquet keeps its own id type.
    """
    raw = require_columns(_read(spark, path, fmt, sep), [ID, TRUTH, GROUP])
    types = dict(MEASURED_TYPES) | dict(extra_types or {})
    if fmt == "parquet":
        types.pop(ID)
    return _typed(raw, types)


def read_predictions(spark: SparkSession, path: str, fmt: str = "parquet", sep: str = ",") -> DataFrame:
    """The prediction table, one row per part (haplotype) of a participant."""
    raw = require_columns(_read(spark, path, fmt, sep), list(PREDICTION_TYPES))
    types = dict(PREDICTION_TYPES)
    if fmt == "parquet":
        types.pop(ID)
    return _typed(raw, types)


def read_sites(spark: SparkSession, path: str, fmt: str = "parquet", sep: str = "\t") -> DataFrame:
    """The model's site list (use ``read_sites_vcf`` for a variant file)."""
    raw = require_columns(_read(spark, path, fmt, sep), list(SITE_TYPES))
    return _typed(raw.select(*SITE_TYPES), SITE_TYPES)


def write_results(tables: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> Sequence[str]:
    """Write each table below ``folder``; CSV has a header and NA for missing values. Returns the paths."""
    paths = []
    for name, df in tables.items():
        path = f"{folder.rstrip('/')}/{name}"
        if fmt == "csv":
            df.write.mode("overwrite").csv(path, header=True, nullValue=MISSING)
        else:
            df.write.mode("overwrite").format(fmt).save(path)
        paths.append(path)
    return paths
