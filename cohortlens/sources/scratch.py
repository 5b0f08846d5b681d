"""Intermediate tables that several branches of a plan read.

They are written as parquet below the folder the cluster names in ``spark.checkpoint.dir``, so a lost executor
costs a re-read instead of a recomputation, and every later reader starts from a table of known size.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: the session's setting, else the context's checkpoint folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/cohortlens/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the table read back (lineage cut, sizes known)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
