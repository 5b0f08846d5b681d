"""Resamples as replicate vectors: one row per run of equal rows and block of replicates, with its counts as an array.

``Resampler.weights`` gives a row per distinct row and replicate, that is up to n x B rows. Here a run of at most 1024 equal
rows has one row per ``per_vector`` replicates, whose array holds a count for each of them, zeros included; a column file
stores such small numbers in two or three bits each. Weighted sums are dot products of these arrays with the rows' values.

The draws are the same. The counts are drawn twice: once for their totals per stratum and replicate, then, with the missing
draws of each run at hand, for the vectors. So the vectors themselves are never shuffled or added up.

Defined cases: no rows or no resamples give no vectors; NULL keys are groups; extra columns of the cohort are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cohortlens.config import GROUP
from cohortlens.functions.metrics import numeric_terms
from cohortlens.operators.resample import Resampler, _HELD_GROUPS, replicate_metrics

PER_VECTOR = 250


def weight_vectors(resampler: Resampler, per_vector: int = PER_VECTOR) -> DataFrame:
    """(stratum, keys, truth, estimate, start, copies, block, weights): counts of replicates ``block * per_vector + 1`` on.

    ``start`` tells runs of equal rows apart. A run's weights are those of all its copies together.
    """
    content = ["stratum", *resampler.keys, resampler.truth, resampler.estimate, "start", "copies"]
    runs = resampler._runs(resampler.units)
    fields = {f.name: f for f in runs.schema.fields}
    schema = T.StructType(
        [fields[c] for c in content]
        + [T.StructField("block", T.IntegerType()), T.StructField("weights", T.ArrayType(T.IntegerType()))]
    )

    def rows(part: pa.RecordBatch, replicates: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        block, n = (int(replicates[0]) - 1) // per_vector, len(replicates)
        ends = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * n)
        vectors = pa.ListArray.from_arrays(ends, pa.array(counts.T.ravel()))
        yield pa.RecordBatch.from_arrays(
            [*part.columns, pa.array(np.full(part.num_rows, block, np.int32)), vectors], names=[*content, "block", "weights"]
        )

    return resampler.resampled(runs, resampler.drawn(), content, per_vector, rows, schema)


def vector_sums(vectors: DataFrame, keys: Sequence[str], terms: dict[str, Column], per_vector: int = PER_VECTOR) -> DataFrame:
    """Weighted sums of per-row ``terms`` by (keys, replicate): dot products in the tasks, their results added up."""
    names, by = list(terms), [*keys, "block"]
    held = vectors.select(*by, "weights", *[c.cast("double").alias(n) for n, c in terms.items()])
    fields = {f.name: f for f in held.schema.fields}
    schema = T.StructType(
        [fields[k] for k in keys]
        + [T.StructField("replicate", T.IntegerType())]
        + [T.StructField(n, T.DoubleType()) for n in names]
    )

    def emit(sums: dict[tuple, np.ndarray]) -> pd.DataFrame:
        frames = []
        for key, total in sums.items():
            frame = pd.DataFrame(total, columns=names)
            frame.insert(0, "replicate", np.arange(len(total), dtype=np.int32) + key[-1] * per_vector + 1)
            for i, (column, value) in enumerate(zip(keys, key)):
                frame.insert(i, column, [value] * len(total))
            frames.append(frame)
        return pd.concat(frames, ignore_index=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            table = pa.table(batch)
            number = table.select(by).append_column("__row", pa.array(np.arange(len(table))))
            for own in number.group_by(by).aggregate([("__row", "list")]).to_pylist():
                # NaN is a group like NULL.
                key = tuple(None if own[k] != own[k] else own[k] for k in by)
                part = table.take(pa.array(own["__row_list"]))
                lists = part.column("weights").combine_chunks()
                weights = lists.flatten().to_numpy().reshape(len(part), -1)
                values = np.stack([part.column(c).to_numpy().astype(np.float64) for c in names], axis=1)
                product = weights.T.astype(np.float64) @ values
                sums[key] = sums[key] + product if key in sums else product
                if len(sums) >= _HELD_GROUPS:
                    yield from batched(sums)
                    sums = {}
        if sums:
            yield from batched(sums)

    def batched(sums: dict[tuple, np.ndarray]) -> Iterator[pa.RecordBatch]:
        yield from pa.Table.from_pandas(emit(sums), arrow_schema, preserve_index=False).to_batches()

    arrow_schema = to_arrow_schema(schema)
    summed = held.mapInArrow(run, schema)
    return summed.groupBy(*keys, "replicate").agg(*[F.sum(n).alias(n) for n in names])


def vector_replicates(vectors: DataFrame, truth: str, estimate: str, group: str = GROUP, per_vector: int = PER_VECTOR) -> DataFrame:
    """rsq, mape and rmse of every replicate from stored vectors, the same rows as ``numeric_replicates``."""
    y, x = F.col(truth), F.col(estimate)
    once = vectors.filter("block = 0")
    centre = once.agg(
        (F.sum(y * F.col("copies")) / F.sum("copies")).alias("y"), (F.sum(x * F.col("copies")) / F.sum("copies")).alias("x")
    ).first()
    terms = numeric_terms(y, x, centre["y"] or 0.0, centre["x"] or 0.0)
    return replicate_metrics(vector_sums(vectors, [group], terms, per_vector), group)
