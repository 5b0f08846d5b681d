"""All tables of a run as one commit: readers see a complete run or none of it.

Tables are written below a new folder of the run, read back and counted; then the manifest, one small file with a row per
table, is written as the last step. Its job commits by the rename of that one file, so a run without a manifest never
happened for readers, whatever is left of it. Runs never overwrite each other.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.sources.tables import MISSING

MANIFEST = "run_id string, committed_at bigint, table_name string, format string, schema string, row_count bigint, content_hash string"


def _stored(spark: SparkSession, path: str, fmt: str, schema: str) -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.csv(path, header=True, nullValue=MISSING) if fmt == "csv" else reader.format(fmt).load(path)


def fingerprint(df: DataFrame) -> tuple[int, str]:
    """Row count and a content hash that does not depend on the order of the rows, in one aggregation."""
    # Two hashes whose sums are exact decimals: repeated rows do not cancel out.
    columns = [F.col(f"`{c}`").cast("string") for c in df.columns]
    named = [F.coalesce(F.concat(F.lit("="), c), F.lit("-")) for c in columns] or [F.lit("")]
    first, second = F.xxhash64(*named), F.xxhash64(F.lit(1), *named)
    found = df.agg(
        F.count(F.lit(1)).alias("n"), F.sum(first.cast("decimal(38,0)")).alias("a"), F.sum(second.cast("decimal(38,0)")).alias("b")
    ).first()
    return found["n"], f"{int(found['a'] or 0):x}.{int(found['b'] or 0):x}"


def commit_run(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> str:
    """Write ``tables`` as one run below ``folder`` and return the run's id; an error on the way leaves no visible run.

    CSV keeps texts only: its tables are stored, hashed and read back with text columns, NA for missing values.
    """
    root, run_id = folder.rstrip("/"), uuid.uuid4().hex
    rows = []
    for name, df in tables.items():
        path = f"{root}/runs/{run_id}/{name}"
        if fmt == "csv":
            df.write.mode("errorifexists").csv(path, header=True, nullValue=MISSING)
            schema = ", ".join(f"`{c}` string" for c in df.columns)
        else:
            df.write.mode("errorifexists").format(fmt).save(path)
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        rows.append((name, fmt, schema, *fingerprint(_stored(spark, path, fmt, schema))))
    if not rows:
        raise ValueError("a run has at least one table")
    stamp = time.time_ns() // 1000
    manifest = spark.createDataFrame([(run_id, stamp, *r) for r in rows], MANIFEST)
    manifest.coalesce(1).write.mode("errorifexists").json(f"{root}/manifests/{run_id}")
    return run_id


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """One row per table of every complete run below ``folder``; no rows if there is none."""
    reader = spark.read.schema(MANIFEST).option("recursiveFileLookup", "true")
    try:
        return reader.json(f"{folder.rstrip('/')}/manifests")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def read_run(spark: SparkSession, folder: str, run_id: str | None = None, verify: bool = False) -> dict[str, DataFrame]:
    """The tables of a complete run, by default the one committed last; ``verify`` compares counts and hashes."""
    every = manifests(spark, folder)
    if run_id is None:
        last = every.agg(F.max(F.struct("committed_at", "run_id")).alias("r")).first()["r"]
        run_id = last["run_id"] if last else None
    rows = every.filter(F.col("run_id") == run_id).collect() if run_id else []
    if not rows:
        raise ValueError(f"no complete run {run_id or ''} below {folder}")
    tables = {}
    for r in rows:
        path = f"{folder.rstrip('/')}/runs/{run_id}/{r['table_name']}"
        tables[r["table_name"]] = _stored(spark, path, r["format"], r["schema"])
        if verify and fingerprint(tables[r["table_name"]]) != (r["row_count"], r["content_hash"]):
            raise ValueError(f"table {r['table_name']} of run {run_id} is not what was committed")
    return tables
