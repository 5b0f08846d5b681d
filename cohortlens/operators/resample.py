"""Stratified bootstrap of cohorts of any size.

A resample of a stratum with n rows is n draws with replacement, so the row weights of a replicate are multinomial
with total n. They are produced without moving n x B draws between tasks:

1. every row draws an independent Poisson count with a rate a little below 1, in the task that holds the row;
   weighted sums leave the task already aggregated per (stratum, group, replicate);
2. if the counts of a stratum add up to S <= n, the n - S missing draws (about 3 sqrt(n)) are uniform picks of row
   positions, joined to the rows; if S > n (about 1 replicate in 1000) the counts are discarded and all n draws
   are picks.

Given S, independent Poisson counts are multinomial with total S, so both cases give exact multinomial weights.
All draws are functions of (seed, stratum, row position, replicate).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cohortlens.config import CLASS_METRICS, ESTIMATE, GROUP, ID, NUMERIC_METRICS, TRUTH
from cohortlens.functions.draws import CELL_SLACK, SLACK, UNIFORM_BITS, draw60, poisson_counts, poisson_quantiles, thinned_rate
from cohortlens.functions.metrics import NUMERIC_SUMS, confusion_metrics, numeric_from_sums, numeric_terms
from cohortlens.functions.scalars import exceeds, nan_to_null, overall_or, strata_key
from cohortlens.operators.agreement import classified, pivot_longer
from cohortlens.operators.joins import attach, settled
from cohortlens.sources.scratch import written

ALL = "all"
CONFUSION = ("tp", "fp", "tn", "fn")

_ROWS_PER_BUCKET = 250_000
_COPIES_PER_CHUNK = 1024
_PICKS_PER_CHUNK = 65_536
# A task also hands on a row per group and replicate, so tasks must be long enough for that not to outweigh their draws.
_DRAWS_PER_TASK = 200_000_000
_PICKS_PER_TASK = 1_000_000
_MAX_TASKS = 50_000
_BROADCAST_UNITS = 200_000
_UNITS_PER_STEP = 16_384
_CELLS_PER_STEP = 262_144
_HELD_GROUPS = 512
_REPLICATES_PER_TASK = 50
_RUNS = 1024
#: Row positions that are dealt out together at most, and their draws.
_POSITIONS_PER_RANGE = 65_536
_DRAWS_PER_RANGE = 1 << 26
_ROWS_PER_BATCH = 65_536


# ---- strata and row positions ----------------------------------------------------------------------------------


def bootstrap_strata(df: DataFrame, level: str, pool: float = 0.1, seed: int = 0, id_col: str = ID) -> DataFrame:
    """Attach the resampling ``stratum``.

    Levels with a share of at least ``pool`` are strata. Rows of smaller levels and rows without a level are spread
    over those strata by a draw on their id; if no level is large enough there is one stratum. ``pool=0`` keeps
    every level as its own stratum, rows without one being another. At most 1/pool level names come to the driver.
    """
    if pool <= 0:
        text = F.col(level).cast("string")
        # A level that reads NA is not a missing one.
        return df.withColumn("stratum", F.when(text.isNull(), F.lit("NA")).when(text == "NA", F.lit("NA (level)")).otherwise(text))
    # Names are texts made by Spark, here and in the comparison below: other engines write booleans and doubles differently.
    name = F.col(level).cast("string")
    names = _large_levels(df.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n")), pool)
    return df.withColumn("stratum", _stratum(name, names, _pick(names, seed, id_col)))


def _large_levels(counts: DataFrame, pool: float) -> list[str]:
    """Names of the levels (name, n) that are strata of their own, in order."""
    counts, _ = settled(counts)
    total = counts.agg(F.sum("n")).scalar()
    kept = counts.filter(F.col("name").isNotNull() & (F.col("n") / total >= pool)).select("name").collect()
    return sorted(r[0] for r in kept)


def _pick(names: list[str], seed: int, id_col: str) -> Column:
    """Which of the strata a row joins if its own level is too small."""
    return (draw60(seed, "pool", F.coalesce(F.col(id_col).cast("string"), F.lit("NA"))) % max(1, len(names))).cast("int")


def _stratum(name: Column, names: list[str], pick: Column) -> Column:
    if not names:
        return F.lit(ALL)
    return F.when(name.isin(names), name).otherwise(F.element_at(F.array(*[F.lit(n) for n in names]), pick + 1))


def _text(c: Column, data_type: T.DataType) -> Column:
    """Text of a key or value, the same on every engine."""
    if isinstance(data_type, T.NumericType):
        c = c.try_cast("decimal(38,6)")
    return F.coalesce(c.cast("string"), F.lit("NA"))


def resample_index(
    df: DataFrame, keys: Sequence[str], truth: str, estimate: str, rows: int | None = None
) -> DataFrame:
    """Positions of the rows in their stratum, as one row per distinct (stratum, keys, truth, estimate).

    ``copies`` equal rows take the positions ``start .. start + copies - 1`` (from 0). Rows are ordered by a hash of
    their content. Equal rows are merged before any shuffle and the running count is taken within hash buckets, so
    neither a dominant stratum nor a dominant value lands in one task. ``rows`` (an upper bound of the row count)
    sets the number of buckets; positions do not depend on it.
    """
    content = ["stratum", *keys, truth, estimate]
    types = dict(zip(df.columns, [f.dataType for f in df.schema.fields]))
    rows = rows if rows is not None else df.count()
    digits = max(0, math.ceil(math.log(max(rows, 1) / _ROWS_PER_BUCKET, 16)))

    def tag(table: DataFrame) -> DataFrame:
        tagged = table.withColumn("tag", F.md5(F.concat_ws("|", *[_text(F.col(c), types[c]) for c in content])))
        return tagged.withColumn("bucket", F.substring("tag", 1, digits) if digits else F.lit(""))

    tagged = tag(df.groupBy(*content).agg(F.count(F.lit(1)).alias("copies")))
    within = Window.partitionBy("stratum", "bucket").orderBy("tag", truth, estimate, *keys)
    numbered = tagged.withColumn(
        "before", F.sum("copies").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("copies")
    )
    earlier = Window.partitionBy("stratum").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Bucket sizes come straight from the rows: map-side counting, next to nothing to shuffle.
    offsets = (
        tag(df.select(*content))
        .groupBy("stratum", "bucket")
        .agg(F.count(F.lit(1)).alias("size"))
        .select(
            F.col("stratum").alias("s"),
            F.col("bucket").alias("k"),
            (F.sum("size").over(earlier) - F.col("size")).alias("offset"),
        )
    )
    placed = numbered.join(offsets, (F.col("stratum") == F.col("s")) & (F.col("bucket") == F.col("k")))
    return placed.select(*content, "copies", (F.col("offset") + F.col("before")).alias("start"))


class Resampler:
    """Rows of a cohort with their strata and positions, ready to be resampled ``resamples`` times.

    ``df`` needs the columns ``stratum``, ``keys``, ``truth`` and ``estimate``. ``slack`` only shifts work between the
    two steps above; any value gives the same distribution.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], truth: str, estimate: str, resamples: int, seed: int,
                 slack: float = SLACK):
        self.slack = slack
        self.keys, self.truth, self.estimate = list(keys), truth, estimate
        self.resamples, self.seed = resamples, seed
        narrow = df.select("stratum", *keys, truth, estimate)
        self.strata, small = settled(narrow.groupBy("stratum").agg(F.count(F.lit(1)).alias("size")))
        self.rows = self.strata.agg(F.sum("size")).first()[0] or 0
        index = resample_index(narrow, keys, truth, estimate, self.rows)
        self.units = written(attach(index, self.strata, ["stratum"], small=small), "resample-index")

    # -- pieces shared by sums and weights --

    def _tasks(self, draws: int, per_task: int) -> int:
        """Number of tasks for that many draws (given to ``repartition``, so it is not merged down again)."""
        parallel = self.units.sparkSession.sparkContext.defaultParallelism
        return min(max(math.ceil(draws / per_task), parallel), _MAX_TASKS)

    def _runs(self, units: DataFrame) -> DataFrame:
        """Units cut into runs of at most ``_COPIES_PER_CHUNK`` equal rows."""
        zero = F.lit(0).cast("bigint")
        runs = units.withColumn("at", F.explode(F.sequence(zero, F.col("copies") - 1, zero + _COPIES_PER_CHUNK)))
        return runs.select(
            "stratum",
            *self.keys,
            self.truth,
            self.estimate,
            "size",
            (F.col("start") + F.col("at")).alias("start"),
            F.least(F.lit(_COPIES_PER_CHUNK), F.col("copies") - F.col("at")).alias("copies"),
            draw60(self.seed, F.col("stratum")).alias("stratum_key"),
        )

    def _chunks(self) -> DataFrame:
        """The runs of all units, spread evenly over the tasks."""
        tasks = self._tasks(self.rows * self.resamples, _DRAWS_PER_TASK)
        return self._runs(self.units).repartition(tasks, "stratum", "start")

    def _pick_runs(self, drawn: DataFrame) -> DataFrame:
        """Draws that the counts do not cover, in runs: (stratum, replicate, size, missing, first), spread over the tasks.

        ``drawn`` has one row per (stratum, replicate) with the summed counts.
        """
        grid = self.strata.select(
            "stratum", "size", F.explode(F.sequence(F.lit(1), F.lit(self.resamples))).alias("replicate")
        )
        have = drawn.select(F.col("stratum").alias("s"), F.col("replicate").alias("r"), "drawn")
        total = F.coalesce(F.col("drawn").cast("bigint"), F.lit(0))
        needed = grid.join(have, (F.col("stratum") == F.col("s")) & (F.col("replicate") == F.col("r")), "left").select(
            "stratum",
            "replicate",
            "size",
            F.when(total > F.col("size"), F.col("size")).otherwise(F.col("size") - total).alias("missing"),
        )
        runs = needed.filter("missing > 0").withColumn(
            "first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("missing") - 1, F.lit(_PICKS_PER_CHUNK).cast("bigint")))
        )
        expected = int(3 * math.sqrt(self.rows) * self.resamples)
        return runs.repartition(self._tasks(expected, _PICKS_PER_TASK), "stratum", "replicate", "first")

    def _picks(self, drawn: DataFrame) -> DataFrame:
        """Row positions of the draws that the counts do not cover: (stratum, replicate, position)."""
        slots = self._pick_runs(drawn).select(
            "stratum",
            "replicate",
            "size",
            F.explode(
                F.sequence(F.col("first"), F.least(F.col("first") + _PICKS_PER_CHUNK, F.col("missing")) - 1)
            ).alias("slot"),
        )
        draw = draw60(self.seed, "pick", F.col("stratum"), F.col("replicate").cast("string"), F.col("slot").cast("string"))
        return slots.select("stratum", "replicate", (draw % F.col("size")).alias("position"))

    def _picked(self, drawn: DataFrame, columns: Sequence[Column]) -> DataFrame:
        """One row per pick with the picked row's ``columns``."""
        singles = self._chunks().select(
            F.col("stratum").alias("s"),
            F.explode(F.sequence(F.col("start"), F.col("start") + F.col("copies") - 1)).alias("p"),
            *columns,
        )
        # The number of single rows is known here; Spark's own estimate does not see the explode.
        singles = F.broadcast(singles) if self.rows <= _BROADCAST_UNITS else singles.hint("merge")
        picks = self._picks(drawn)
        return picks.join(singles, (F.col("stratum") == F.col("s")) & (F.col("position") == F.col("p"))).drop("s", "p")

    def _overfull(self, drawn: DataFrame) -> DataFrame:
        """(stratum, replicate) pairs whose counts exceed the stratum size."""
        sizes = self.strata.select(F.col("stratum").alias("s"), "size")
        return (
            drawn.join(sizes, F.col("stratum") == F.col("s"))
            .filter(F.col("drawn") > F.col("size"))
            .select("stratum", "replicate")
        )

    # -- results --

    def sums(self, terms: dict[str, Column]) -> DataFrame:
        """Weighted sums of per-row ``terms`` (of keys, truth and estimate) by (keys, replicate); the first must be the constant 1."""
        names = list(terms)
        held = self._chunks().select("stratum", *self.keys, "size", "start", "copies", "stratum_key",
                                     *[c.cast("double").alias(n) for n, c in terms.items()])
        fields = {f.name: f for f in held.schema.fields}
        by = ["stratum", *self.keys]
        schema = T.StructType(
            [fields[c] for c in by]
            + [T.StructField("replicate", T.IntegerType())]
            + [T.StructField(n, T.DoubleType()) for n in names]
        )
        counted = held.sortWithinPartitions(*by, "start").mapInPandas(
            _sums_of_counts(by, names, self.resamples, self.slack), schema
        )
        counted = counted.groupBy(*by, "replicate").agg(*[F.sum(n).alias(n) for n in names])
        counted = written(counted, "replicate-sums")
        drawn = counted.groupBy("stratum", "replicate").agg(F.sum(names[0]).alias("drawn"))
        kept = counted.join(self._overfull(drawn), ["stratum", "replicate"], "left_anti")
        # The terms are made of the picked values, so that they are not carried along with every row of the cohort.
        picked = self._picked(drawn, [F.col(c) for c in (*self.keys, self.truth, self.estimate)])
        picked = picked.groupBy(*self.keys, "replicate").agg(*[F.sum(c.cast("double")).alias(n) for n, c in terms.items()])
        both = kept.select(*self.keys, "replicate", *names).unionByName(picked)
        return both.groupBy(*self.keys, "replicate").agg(*[F.sum(n).alias(n) for n in names])

    def weights(self) -> DataFrame:
        """The resamples themselves: weight per (stratum, keys, truth, estimate, replicate), zero weights left out.

        Weights are whole where a run of equal rows is; only those of values that fill several runs are added up.
        """
        content = ["stratum", *self.keys, self.truth, self.estimate]
        fields = {f.name: f for f in self.units.schema.fields}
        schema = T.StructType(
            [fields[c] for c in content]
            + [T.StructField("replicate", T.IntegerType()), T.StructField("weight", T.LongType())]
        )
        drawn, step = self.drawn(), max(1, min(self.resamples, 256))

        def rows(part: pa.RecordBatch, replicates: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            r, c = np.nonzero(counts)
            for at in range(0, len(r), _ROWS_PER_BATCH):
                place, value = r[at : at + _ROWS_PER_BATCH], c[at : at + _ROWS_PER_BATCH]
                own = part.take(pa.array(value))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(replicates[place].astype(np.int32)), pa.array(counts[place, value].astype(np.int64))],
                    names=[*content, "replicate", "weight"],
                )

        def of(units: DataFrame) -> DataFrame:
            return self.resampled(self._runs(units), drawn, content, step, rows, schema)

        one_run = F.col("copies") <= _COPIES_PER_CHUNK
        if not self.units.filter(~one_run).limit(1).count():
            return of(self.units)
        added = of(self.units.filter(~one_run)).groupBy(*content, "replicate").agg(F.sum("weight").alias("weight"))
        return of(self.units.filter(one_run)).unionByName(added)

    def drawn(self) -> DataFrame:
        """(stratum, replicate, drawn): totals of the counts."""
        held = self._chunks().select("stratum", "size", "start", "copies", "stratum_key")
        counted = held.mapInPandas(_totals_of_counts(self.resamples, self.slack), "stratum string, replicate int, n long")
        return written(counted.groupBy("stratum", "replicate").agg(F.sum("n").alias("drawn")), "drawn")

    def resampled(self, runs: DataFrame, drawn: DataFrame, content: list[str], step: int, rows: Callable, schema: T.StructType) -> DataFrame:
        """What ``rows`` makes of the weights of runs: it gets rows of ``content``, ``step`` replicate numbers and the
        weights (replicates x rows).

        Runs and picks are dealt out by stratum and range of positions. The picks of a range come before its runs and
        are looked up among them as they pass, so they are neither joined nor shuffled one by one. A run may begin in a
        range and end in the next; the picks at a range's beginning therefore go to the range before, too, and count
        only where their run is.
        """
        reach = _COPIES_PER_CHUNK - 1
        parallel = self.units.sparkSession.sparkContext.defaultParallelism
        wide = max(1, min(_POSITIONS_PER_RANGE, _DRAWS_PER_RANGE // max(1, self.resamples), self.rows // (4 * parallel)), reach + 1)
        overfull = self._overfull(drawn).groupBy("stratum").agg(F.collect_list("replicate").alias("overfull"))
        held = attach(runs, overfull, ["stratum"]).withColumns(
            {"__range": F.floor(F.col("start") / wide), "__kind": F.lit(1)}
        )
        picks = self._pick_runs(drawn).select("stratum", "replicate", "size", "missing", "first").mapInArrow(
            _picks_by_range(self.seed, wide, reach), "stratum string, __range long, pick_replicates binary, pick_positions binary"
        ).withColumn("__kind", F.lit(0))
        both = held.unionByName(picks, allowMissingColumns=True)
        dealt = both.repartition(self._tasks(self.rows * self.resamples, _DRAWS_PER_TASK), "stratum", "__range")
        in_order = dealt.sortWithinPartitions("stratum", "__range", "__kind", "start")
        return in_order.mapInArrow(_resampled_runs(content, self.resamples, self.slack, step, rows), schema)


# ---- small helpers that run inside the tasks -------------------------------------------------------------------


def _pieces(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Row slices of at most about ``_UNITS_PER_STEP`` single rows."""
    step = (part["copies"].cumsum() - 1) // _UNITS_PER_STEP
    for _, piece in part.groupby(step.to_numpy(), sort=False):
        yield piece


def _positions(piece: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the single rows, and for each the row of ``piece`` it belongs to."""
    copies = piece["copies"].to_numpy()
    owner = np.repeat(np.arange(len(piece)), copies)
    first = np.cumsum(copies) - copies
    return piece["start"].to_numpy()[owner] + (np.arange(len(owner)) - first[owner]), owner


def _counts(
    piece: pd.DataFrame, positions: np.ndarray, resamples: int, slack: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Replicate numbers with their Poisson counts, a few replicates at a time."""
    width = max(1, _CELLS_PER_STEP // len(positions))
    key, size = int(piece["stratum_key"].iloc[0]), int(piece["size"].iloc[0])
    for start in range(1, resamples + 1, width):
        replicates = np.arange(start, min(start + width, resamples + 1))
        yield replicates, poisson_counts(key, size, positions, replicates, slack)


def _sums_of_counts(by: list[str], names: list[str], resamples: int, slack: float):
    """Per task: count-weighted sums by (stratum, keys, replicate); a bounded number of groups is held at a time."""

    def emit(held: dict[tuple, np.ndarray]) -> pd.DataFrame:
        frames = []
        for key, total in held.items():
            frame = pd.DataFrame(total, columns=names)
            frame.insert(0, "replicate", np.arange(1, resamples + 1, dtype=np.int32))
            for i, (column, value) in enumerate(zip(by, key)):
                frame.insert(i, column, [None if pd.isna(value) else value] * resamples)
            frames.append(frame)
        return pd.concat(frames, ignore_index=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for key, part in batch.groupby(by, dropna=False, sort=False):
                key = tuple(None if pd.isna(v) else v for v in key)
                total = held.setdefault(key, np.zeros((resamples, len(names))))
                for piece in _pieces(part):
                    positions, owner = _positions(piece)
                    values = piece[names].to_numpy()[owner]
                    for replicates, counts in _counts(piece, positions, resamples, slack):
                        total[replicates - 1] += counts.astype(np.float64) @ values
                if len(held) >= _HELD_GROUPS:
                    yield emit(held)
                    held = {}
        if held:
            yield emit(held)

    return run


def _totals_of_counts(resamples: int, slack: float):
    """Per task: sums of the counts by (stratum, replicate)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str | None, np.ndarray] = {}
        for batch in batches:
            for stratum, part in batch.groupby("stratum", sort=False):
                total = held.setdefault(stratum, np.zeros(resamples, np.int64))
                for piece in _pieces(part):
                    for replicates, counts in _counts(piece, _positions(piece)[0], resamples, slack):
                        total[replicates - 1] += counts.sum(axis=1, dtype=np.int64)
            if len(held) >= _HELD_GROUPS:
                yield from said(held)
                held = {}
        yield from said(held)

    def said(held: dict[str | None, np.ndarray]) -> Iterator[pd.DataFrame]:
        for stratum, total in held.items():
            yield pd.DataFrame({"stratum": stratum, "replicate": np.arange(1, resamples + 1, dtype=np.int32), "n": total})

    return run


def _picks_by_range(seed: int, wide: int, reach: int):
    """Per task: picked positions by stratum and range of ``wide`` positions; those in the first ``reach`` go to the range before, too."""

    def said(stratum: str, replicates: list[np.ndarray], positions: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        r, p = np.concatenate(replicates), np.concatenate(positions)
        early = (p >= wide) & (p % wide < reach)
        own = np.concatenate([p // wide, p[early] // wide - 1])
        r, p = np.concatenate([r, r[early]]), np.concatenate([p, p[early]])
        order = np.argsort(own, kind="stable")
        own, r, p = own[order], r[order], p[order]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        ends = np.append(first, len(own))
        columns = [[values[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])] for values in (r, p)]
        yield pa.RecordBatch.from_arrays(
            [pa.repeat(stratum, len(first)), pa.array(own[first]), *[pa.array(c, pa.binary()) for c in columns]],
            names=["stratum", "__range", "pick_replicates", "pick_positions"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list[np.ndarray], list[np.ndarray]]] = {}
        for batch in batches:
            for stratum, replicate, size, missing, first in zip(*batch.to_pydict().values()):
                # The same draws as those of ``draw60``.
                text = f"{seed}|pick|{stratum}|{replicate}|".encode()
                slots = range(first, min(first + _PICKS_PER_CHUNK, missing))
                draws = np.frombuffer(b"".join([md5(b"%s%d" % (text, slot)).digest()[:8] for slot in slots]), ">u8") >> 4
                replicates, positions = held.setdefault(stratum, ([], []))
                replicates.append(np.full(len(draws), replicate, np.int32))
                positions.append(draws.astype(np.int64) % size)
                if sum(map(len, positions)) >= _PICKS_PER_TASK:
                    yield from said(stratum, *held.pop(stratum))
        for stratum, parts in held.items():
            yield from said(stratum, *parts)

    return run


def _resampled_runs(content: list[str], resamples: int, slack: float, step: int, rows: Callable):
    """Per task: what ``rows`` makes of the weights of the runs, a bounded number of rows and replicates at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, picked = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            strata = batch.column("stratum").to_pylist()
            ranges, kinds = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("__range", "__kind"))
            number = batch.column("stratum").dictionary_encode().indices.to_numpy()
            change = np.diff(number) | np.diff(ranges) | np.diff(kinds)
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if (strata[a], ranges[a]) != now:
                    now, picked = (strata[a], ranges[a]), []
                part = batch.slice(a, b - a)
                if kinds[a] == 0:
                    picked += zip(part.column("pick_replicates"), part.column("pick_positions"))
                    continue
                if not isinstance(picked, tuple):
                    picked = _sorted_picks(picked)
                copies = part.column("copies").to_numpy()
                which = (np.cumsum(copies) - 1) // _UNITS_PER_STEP
                ends = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), len(copies)]
                for c, d in zip(ends[:-1], ends[1:]):
                    own = part.slice(c, d - c)
                    kept = own.select(content)
                    for replicates, weights in _weights_of_runs(own, *picked, resamples, slack, step):
                        yield from rows(kept, replicates, weights)

    return run


def _sorted_picks(picked: list[tuple[pa.BinaryScalar, pa.BinaryScalar]]) -> tuple[np.ndarray, np.ndarray]:
    """Replicates and positions of picks in the order of their positions."""
    replicates, positions = (
        np.concatenate([np.empty(0, t), *[np.frombuffer(row[i].as_buffer(), t) for row in picked]]) for i, t in enumerate((np.int32, np.int64))
    )
    order = np.argsort(positions)
    return replicates[order], positions[order]


def _weights_of_runs(
    runs: pa.RecordBatch, replicates: np.ndarray, positions: np.ndarray, resamples: int, slack: float, step: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Replicate numbers with the weights (replicates x runs): counts, those of overfull replicates left out, and picks."""
    start, copies = (runs.column(c).to_numpy() for c in ("start", "copies"))
    key, size = runs.column("stratum_key")[0].as_py(), runs.column("size")[0].as_py()
    overfull = np.array(runs.column("overfull")[0].as_py() or [], np.int64)
    low, high = np.searchsorted(positions, [start[0], start[-1] + copies[-1]])
    owner = np.searchsorted(start, positions[low:high], side="right") - 1
    inside = positions[low:high] < (start + copies)[owner]
    owner, of = owner[inside], replicates[low:high][inside]
    order = np.argsort(of, kind="stable")
    owner, of = owner[order], of[order]
    single = bool((copies == 1).all())
    first_of = np.cumsum(copies) - copies
    places = start if single else np.repeat(start - first_of, copies) + np.arange(copies.sum())
    for first in range(1, resamples + 1, step):
        numbers = np.arange(first, min(first + step, resamples + 1))
        counts = poisson_counts(key, size, places, numbers, slack)
        weights = counts.astype(np.int32) if single else np.add.reduceat(counts, first_of, axis=1, dtype=np.int32)
        weights[np.isin(numbers, overfull)] = 0
        a, b = np.searchsorted(of, [first, first + step])
        np.add.at(weights, (of[a:b] - first, owner[a:b]), 1)
        yield numbers, weights


# ---- intervals over replicates ---------------------------------------------------------------------------------


def bootstrap_ci(
    replicates: DataFrame, keys: Sequence[str], value: str = "value", ci: tuple[float, float] = (0.025, 0.975)
) -> DataFrame:
    """Mean, sd and percentile interval over the replicates of each key.

    One undefined replicate makes mean and sd missing; the interval comes from the defined ones. A key has at most
    as many values as there are replicates, so the exact percentile is bounded.
    """
    v = nan_to_null(F.col(value))
    defined = F.count(v) == F.count(F.lit(1))
    return replicates.groupBy(*keys).agg(
        F.when(defined, nan_to_null(F.avg(v))).alias("estimate"),
        F.when(defined, nan_to_null(F.stddev_samp(v))).alias("sd"),
        nan_to_null(F.percentile(v, ci[0])).alias("lower_ci"),
        nan_to_null(F.percentile(v, ci[1])).alias("upper_ci"),
    )


def numeric_resampler(
    df: DataFrame, resamples: int, seed: int, pool: float = 0.1, group: str = GROUP, truth: str = TRUTH,
    estimate: str = ESTIMATE, id_col: str = ID,
) -> Resampler:
    """Resamples of the cohort, stratified by group."""
    strata = bootstrap_strata(df, group, pool, seed, id_col)
    return Resampler(strata, [group], truth, estimate, resamples, seed)


def numeric_replicates(resampler: Resampler, group: str = GROUP) -> DataFrame:
    """rsq, mape and rmse of every replicate, per group and overall (row ``Overall``), long form."""
    y, x = F.col(resampler.truth), F.col(resampler.estimate)
    centre = resampler.units.agg(
        (F.sum(y * F.col("copies")) / F.sum("copies")).alias("y"), (F.sum(x * F.col("copies")) / F.sum("copies")).alias("x")
    ).first()
    return replicate_metrics(resampler.sums(numeric_terms(y, x, centre["y"] or 0.0, centre["x"] or 0.0)), group)


def replicate_metrics(sums: DataFrame, group: str = GROUP) -> DataFrame:
    """Numeric metrics per group and overall from the weighted sums of every replicate, long form."""
    totals = (
        sums.groupingSets([[group, "replicate"], ["replicate"]], group, "replicate")
        .agg(overall_or(group).alias("__name"), *[F.sum(c).alias(c) for c in NUMERIC_SUMS])
        .drop(group)
        .withColumnRenamed("__name", group)
    )
    metrics = totals.select(group, "replicate", *[c.alias(m) for m, c in numeric_from_sums().items()])
    return pivot_longer(metrics, [group, "replicate"], NUMERIC_METRICS, "metric", "value")


def numeric_boot(df: DataFrame, resamples: int, seed: int, pool: float = 0.1,
                 ci: tuple[float, float] = (0.025, 0.975), group: str = GROUP, **columns: str) -> DataFrame:
    """Bootstrapped numeric metrics per group and overall."""
    resampler = numeric_resampler(df, resamples, seed, pool, group, **columns)
    return bootstrap_ci(numeric_replicates(resampler, group), [group, "metric"], ci=ci)


# ---- classification --------------------------------------------------------------------------------------------


def _class_rows(df: DataFrame, thresholds: Sequence[float], pool: float, seed: int, group: str, truth: str,
                estimate: str, id_col: str) -> DataFrame:
    """Rows by threshold with 1/0 classes and the resampling stratum."""
    rows = classified(df, thresholds, group, truth, estimate)
    drawn = bootstrap_strata(rows, "strata", pool, seed, id_col)
    return drawn.select(
        "stratum", group, "threshold", F.col("true_class").cast("double").alias("truth"),
        F.col("pred_class").cast("double").alias("called"),
    )


def _confusion_terms() -> dict[str, Column]:
    up, called = F.col("truth") == 1, F.col("called") == 1

    def flag(c: Column) -> Column:
        return F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))

    return {"tp": flag(up & called), "fp": flag(~up & called), "tn": flag(~up & ~called), "fn": flag(up & ~called)}


def class_sums_by_row(df: DataFrame, thresholds: Sequence[float], resamples: int, seed: int, pool: float = 0.1,
                      group: str = GROUP, truth: str = TRUTH, estimate: str = ESTIMATE, id_col: str = ID) -> DataFrame:
    """Confusion counts of every replicate, drawn row by row like the numeric resamples."""
    rows = _class_rows(df, thresholds, pool, seed, group, truth, estimate, id_col)
    resampler = Resampler(rows, [group, "threshold"], "truth", "called", resamples, seed)
    return resampler.sums({"n": F.lit(1.0), **_confusion_terms()})


def _cell_rows(df: DataFrame, thresholds: Sequence[float], pool: float, seed: int, group: str, truth: str,
               estimate: str, id_col: str) -> DataFrame:
    """The rows of ``_class_rows`` counted: ``copies`` of each, some in several rows.

    Classes at all thresholds are counted side by side; only the counted table is multiplied by the thresholds. Which
    stratum a row of a small level joins depends on its id alone, so that choice is counted along.
    """
    def exceeded(c: str) -> Column:
        return F.array(*[exceeds(F.col(c), F.lit(float(t))) for t in thresholds])

    def by_threshold(counted: DataFrame, *more: str) -> DataFrame:
        levels = F.array(*[F.lit(float(t)) for t in thresholds])
        zipped = F.arrays_zip("threshold", "truths", "calls")
        each = counted.withColumn("threshold", levels).select(group, *more, "copies", F.inline(zipped))
        return each.withColumn("strata", strata_key(F.col(group), F.col("truths"), F.col("threshold")))

    flags = df.select(group, id_col, exceeded(truth).alias("truths"), exceeded(estimate).alias("calls"))
    copies = F.count(F.lit(1)).alias("copies")
    if pool > 0:
        first = by_threshold(flags.groupBy(group, "truths", "calls").agg(copies))
        names = _large_levels(first.groupBy(F.col("strata").alias("name")).agg(F.sum("copies").alias("n")), pool)
        counted = flags.withColumn("pick", _pick(names, seed, id_col)).groupBy(group, "truths", "calls", "pick").agg(copies)
        placed = by_threshold(counted, "pick").withColumn("stratum", _stratum(F.col("strata"), names, F.col("pick")))
    else:
        placed = bootstrap_strata(by_threshold(flags.groupBy(group, "truths", "calls").agg(copies)), "strata", pool)
    return placed.select(
        "stratum", group, "threshold", F.col("truths").cast("double").alias("truth"),
        F.col("calls").cast("double").alias("called"), "copies",
    )


def class_cells(df: DataFrame, thresholds: Sequence[float], seed: int, pool: float = 0.1, group: str = GROUP,
                truth: str = TRUTH, estimate: str = ESTIMATE, id_col: str = ID) -> DataFrame:
    """Rows per (stratum, group, threshold, true, predicted) cell: ``copies``, and ``start``, the rows of the stratum's
    cells before it, in the order of a hash of the cell's name. The window sees one row per cell."""
    keys = ["stratum", group, "threshold", "truth", "called"]
    cells = _cell_rows(df, thresholds, pool, seed, group, truth, estimate, id_col).groupBy(*keys).agg(F.sum("copies").alias("copies"))
    types = {f.name: f.dataType for f in cells.schema.fields}
    tagged = cells.withColumn("tag", F.md5(F.concat_ws("|", *[_text(F.col(c), types[c]) for c in keys])))
    inside = Window.partitionBy("stratum")
    before = inside.orderBy("tag").rowsBetween(Window.unboundedPreceding, -1)
    return tagged.withColumns({
        "size": F.sum("copies").over(inside),
        "start": F.coalesce(F.sum("copies").over(before), F.lit(0).cast("bigint")),
    })


def _cell_counts(cells: DataFrame, resamples: int, seed: int) -> DataFrame:
    """(stratum, tag, replicate, weight): the thinned Poisson count of every cell and replicate, zeros included."""
    n_blocks = (resamples - 1) // _REPLICATES_PER_TASK + 1
    last = F.least(F.lit(resamples), (F.col("block") + 1) * _REPLICATES_PER_TASK)
    draws = (
        cells.select("stratum", "tag", "copies", "size", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
        .repartition(cells.sparkSession.sparkContext.defaultParallelism, "tag", "block")
        .withColumn("replicate", F.explode(F.sequence(F.col("block") * _REPLICATES_PER_TASK + 1, last)))
    )
    u = F.shiftright(draw60(seed, "cell", F.col("tag"), F.col("replicate").cast("string")), 60 - UNIFORM_BITS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby("tag", sort=False):
                mean = thinned_rate(int(part["size"].iloc[0]), CELL_SLACK) * int(part["copies"].iloc[0])
                out = part[["stratum", "tag", "replicate"]].copy()
                out["weight"] = poisson_quantiles(mean, part["u"].to_numpy())
                yield out

    held = draws.select("stratum", "tag", "copies", "size", "replicate", u.alias("u"))
    return held.mapInPandas(run, "stratum string, tag string, replicate int, weight long")


def _cell_picks(cells: DataFrame, drawn: DataFrame, resamples: int, seed: int) -> DataFrame:
    """(tag, replicate, weight) of the draws that the counts leave out, as uniform picks of the stratum's rows.

    A pick's row lies in one cell. Rows are numbered in runs of a fixed part of the stratum; cells are listed once per
    run that they touch, so a pick meets few of them.
    """
    strata = cells.groupBy("stratum").agg(F.max("size").alias("size"))
    grid = strata.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(resamples))))
    total = F.coalesce(F.col("drawn"), F.lit(0).cast("bigint"))
    needed = grid.join(drawn, ["stratum", "replicate"], "left").withColumn(
        "missing", F.when(total > F.col("size"), F.col("size")).otherwise(F.col("size") - total)
    )
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("missing") - 1, F.lit(_PICKS_PER_CHUNK).cast("bigint")))
    slots = (
        needed.filter("missing > 0").withColumn("first", first)
        .repartition(cells.sparkSession.sparkContext.defaultParallelism, "stratum", "replicate", "first")
        .withColumn("slot", F.explode(F.sequence(F.col("first"), F.least(F.col("first") + _PICKS_PER_CHUNK, F.col("missing")) - 1)))
    )
    draw = draw60(seed, "cell-pick", F.col("stratum"), F.col("replicate").cast("string"), F.col("slot").cast("string"))
    run_length = F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("size") / _RUNS))
    picks = slots.select("stratum", "replicate", (draw % F.col("size")).alias("position"), run_length.alias("long"))
    picks = picks.withColumn("run", F.floor(F.col("position") / F.col("long")))
    listed = cells.select("stratum", "tag", "start", (F.col("start") + F.col("copies")).alias("end"), run_length.alias("long"))
    touched = F.sequence(F.floor(F.col("start") / F.col("long")), F.floor((F.col("end") - 1) / F.col("long")))
    listed = listed.withColumn("run", F.explode(touched)).drop("long")
    met = picks.join(listed, ["stratum", "run"]).filter((F.col("position") >= F.col("start")) & (F.col("position") < F.col("end")))
    return met.groupBy("tag", "replicate").agg(F.count(F.lit(1)).alias("weight"))


def class_sums_by_cell(df: DataFrame, thresholds: Sequence[float], resamples: int, seed: int, pool: float = 0.1,
                       group: str = GROUP, truth: str = TRUTH, estimate: str = ESTIMATE, id_col: str = ID) -> DataFrame:
    """Confusion counts of every replicate, drawn per confusion cell.

    The metrics only see how many draws fall into each (group, threshold, true, predicted) cell. The sum of the Poisson
    counts of a cell's rows is one Poisson count, so a cell draws once per replicate, from its cumulative table, and the
    draws that are missing in a stratum are picks of rows as in the row by row resamples. After one aggregation the cost
    grows with the square root of the row count at most.
    """
    cells = written(class_cells(df, thresholds, seed, pool, group, truth, estimate, id_col), "cells")
    counts = written(_cell_counts(cells, resamples, seed), "cell-counts")
    drawn = written(counts.groupBy("stratum", "replicate").agg(F.sum("weight").alias("drawn")), "cell-drawn")
    overfull = drawn.join(cells.groupBy("stratum").agg(F.max("size").alias("size")), "stratum").filter("drawn > size")
    kept = counts.join(overfull.select("stratum", "replicate"), ["stratum", "replicate"], "left_anti").drop("stratum")
    both = kept.unionByName(_cell_picks(cells, drawn, resamples, seed)).groupBy("tag", "replicate").agg(F.sum("weight").alias("weight"))
    named = cells.select("tag", group, "threshold", "truth", "called").join(both.filter("weight > 0"), "tag")
    return named.groupBy(group, "threshold", "replicate").agg(
        *[F.sum(F.col("weight") * c).alias(name) for name, c in _confusion_terms().items()]
    )


def class_replicates(sums: DataFrame, group: str = GROUP) -> DataFrame:
    """Classification metrics of every replicate, per group and overall, by threshold, long form."""
    totals = (
        sums.groupingSets([[group, "threshold", "replicate"], ["threshold", "replicate"]], group, "threshold", "replicate")
        .agg(overall_or(group).alias("__name"), *[F.sum(c).alias(c) for c in CONFUSION])
        .drop(group)
        .withColumnRenamed("__name", group)
    )
    formulas = confusion_metrics(*[F.col(c) for c in CONFUSION])
    metrics = totals.select(group, "threshold", "replicate", *[c.alias(m) for m, c in formulas.items()])
    return pivot_longer(metrics, [group, "threshold", "replicate"], CLASS_METRICS, "metric", "value")


def class_boot(df: DataFrame, thresholds: Sequence[float], resamples: int, seed: int, pool: float = 0.1,
               ci: tuple[float, float] = (0.025, 0.975), by_cell: bool = True, group: str = GROUP,
               **columns: str) -> DataFrame:
    """Bootstrapped classification metrics per group and overall, by threshold."""
    draw = class_sums_by_cell if by_cell else class_sums_by_row
    sums = draw(df, thresholds, resamples, seed, pool, group, **columns)
    return bootstrap_ci(class_replicates(sums, group), [group, "threshold", "metric"], ci=ci)
