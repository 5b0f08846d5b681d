"""Sums of doubles that do not depend on partitioning, order or retries: exact accumulators, rounded once.

A double is an integer times a power of two. Here it is cut at the multiples of ``LIMB`` binary places, and the pieces at
each place are added up as integers: per batch in the tasks, then by Spark as decimals. Integers add exactly in any order,
so the accumulators are the same for every partitioning. The product of two doubles is an integer times a power of two as
well, so sums of products, and with them variances and correlations, are exact too; only the final result is rounded.

Accumulators are a table (keys, term, limb, part) of a few rows per group and term. Tables of several parts of the data,
such as days of intake, merge by addition without a loss. A batch leaves its task as a few rows per group, whatever the
share of rows that one group holds.

Defined cases: NULL values are left out, NULL keys are a group, a term without values has a NULL sum, and groups without any
value are kept. NaN, or infinities of both signs, make a sum NaN; an infinity makes it infinite; a sum beyond the largest
double is infinite. An empty table has no groups. Columns that neither keys nor terms name are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cohortlens.config import ESTIMATE, GROUP, NUMERIC_METRICS, TRUTH
from cohortlens.functions.metrics import relative_error
from cohortlens.functions.scalars import overall_or

#: Binary places of a piece.
LIMB = 32
#: Entries in column ``limb`` that are counts, of values, NaN and infinities; places of doubles lie far below.
COUNT, NAN, ABOVE, BELOW = (1_000_000 + i for i in range(4))
_HALF = 27
#: Rows added up at once: 12 pieces of 2**32 from each stay exact as doubles.
_STEP = 1 << 16
_NAMES = ("term", "limb", "part")

Term = Column | tuple[Column, Column]


def _pieces(mantissa: np.ndarray, exponent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(limb, part) of integers up to 2**54 in size times ``2 ** exponent``; the parts times ``2 ** (LIMB * limb)`` add
    up to them."""
    for half, places in ((mantissa & ((1 << _HALF) - 1), exponent), (mantissa >> _HALF, exponent + _HALF)):
        limb = places // LIMB
        shifted = half << (places - limb * LIMB)
        yield limb, shifted & ((1 << LIMB) - 1)
        yield limb + 1, shifted >> LIMB


def _integers(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Finite doubles as integers below 2**53 in size and exponents of two."""
    fraction, exponent = np.frexp(x)
    return (fraction * 2.0**53).astype(np.int64), exponent.astype(np.int64) - 53


def _all_pieces(x: np.ndarray, y: np.ndarray | None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pieces of finite values, or of the products of two."""
    a, p = _integers(x)
    if y is None:
        return list(_pieces(a, p))
    b, q = _integers(y)
    low_a, high_a, low_b, high_b = a & ((1 << _HALF) - 1), a >> _HALF, b & ((1 << _HALF) - 1), b >> _HALF
    products = ((low_a * low_b, 0), (low_a * high_b + high_a * low_b, _HALF), (high_a * high_b, 2 * _HALF))
    return [piece for product, places in products for piece in _pieces(product, p + q + places)]


def _term_rows(x: pa.Array, y: pa.Array | None, code: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, limb, part) of one term over a step's rows."""
    valid = x.is_valid() if y is None else pc.and_(x.is_valid(), y.is_valid())
    valid = valid.to_numpy(zero_copy_only=False)
    left = x.to_numpy(zero_copy_only=False)[valid]
    right = None if y is None else y.to_numpy(zero_copy_only=False)[valid]
    own = code[valid]
    finite = np.isfinite(left) if right is None else np.isfinite(left) & np.isfinite(right)
    out = [(np.arange(groups), np.full(groups, COUNT), np.bincount(own, minlength=groups))]
    if not finite.all():
        with np.errstate(invalid="ignore"):
            odd = left[~finite] if right is None else left[~finite] * right[~finite]
        kind = np.where(np.isnan(odd), NAN, np.where(odd > 0, ABOVE, BELOW))
        out.append((own[~finite], kind, np.ones(len(odd), np.int64)))
        own, left, right = own[finite], left[finite], None if right is None else right[finite]
    if len(own):
        pieces = _all_pieces(left, right)
        limb = np.concatenate([l for l, _ in pieces])
        part = np.concatenate([p for _, p in pieces])
        first, width = limb.min(), int(limb.max() - limb.min()) + 1
        at = np.tile(own, len(pieces)) * width + (limb - first)
        added = np.bincount(at, weights=part.astype(np.float64), minlength=groups * width)
        kept = np.flatnonzero(added)
        out.append((kept // width, kept % width + first, added[kept].astype(np.int64)))
    return tuple(np.concatenate(c).astype(np.int64) for c in zip(*out))


def _groups(batch: pa.RecordBatch, keys: int) -> tuple[np.ndarray, np.ndarray]:
    """A row of every group, and every row's group."""
    code = np.zeros(batch.num_rows, np.int64)
    for i in range(keys):
        coded = batch.column(i).dictionary_encode(null_encoding="encode")
        code = np.unique(code * max(1, len(coded.dictionary)) + coded.indices.to_numpy(), return_inverse=True)[1]
    _, first, code = np.unique(code, return_index=True, return_inverse=True)
    return first, code


def accumulated(df: DataFrame, keys: Sequence[str], terms: Mapping[str, Term]) -> DataFrame:
    """(keys, term, limb, part): accumulators of the sums of ``terms`` per group. A pair of columns is their product."""
    keys, names = list(keys), list(terms)
    if set(keys) & set(_NAMES):
        raise ValueError(f"keys may not be named {', '.join(_NAMES)}")
    columns, places = [], []
    for term in terms.values():
        pair = term if isinstance(term, tuple) else (term,)
        places.append([len(keys) + len(columns) + i for i in range(len(pair))])
        columns += [c.cast("double").alias(f"__x{len(columns) + i}") for i, c in enumerate(pair)]
    held = df.select(*keys, *columns)
    fields = held.schema.fields[: len(keys)]
    schema = T.StructType([*fields, T.StructField("term", T.StringType()), T.StructField("limb", T.IntegerType()), T.StructField("part", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _STEP):
                rows = batch.slice(start, _STEP)
                first, code = _groups(rows, len(keys))
                for name, place in zip(names, places):
                    x, y = [rows.column(i) for i in place] + [None] * (2 - len(place))
                    group, limb, part = _term_rows(x, y, code, len(first))
                    of = pa.array(first[group])
                    arrays = [rows.column(i).take(of) for i in range(len(keys))]
                    arrays += [pa.array([name] * len(group), pa.string()), pa.array(limb.astype(np.int32)), pa.array(part)]
                    yield pa.RecordBatch.from_arrays(arrays, names=[*keys, *_NAMES])

    return _added(held.mapInArrow(run, schema), keys)


def _added(pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    return pieces.groupBy(*keys, "term", "limb").agg(F.sum(F.col("part").cast("decimal(28,0)")).alias("part"))


def merged(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Accumulators of several parts of the data as those of the whole."""
    keys = [c for c in first.columns if c not in _NAMES]
    for other in others:
        first = first.unionByName(other)
    return _added(first, keys)


@dataclass(frozen=True)
class Total:
    """An exact sum: the number of its values, and a fraction, or a double that is NaN or infinite."""

    count: int
    value: Fraction | float

    @property
    def exact(self) -> Fraction | None:
        return self.value if isinstance(self.value, Fraction) else None

    def rounded(self) -> float | None:
        """The double nearest to the sum; None without values."""
        return nearest(self.value) if self.count else None


def nearest(value: Fraction | float) -> float:
    """The double nearest to a fraction, infinite beyond the largest one."""
    try:
        return float(value)
    except OverflowError:
        return math.inf if value > 0 else -math.inf


def _totals(entries: list[dict]) -> dict[str, Total]:
    by_term: dict[str, dict[int, int]] = {}
    for e in entries:
        by_term.setdefault(e["term"], {})[e["limb"]] = int(Decimal(e["part"]))
    out = {}
    for term, parts in by_term.items():
        count, nan, above, below = (parts.pop(k, 0) for k in (COUNT, NAN, ABOVE, BELOW))
        if nan or (above and below):
            value: Fraction | float = math.nan
        elif above or below:
            value = math.inf if above else -math.inf
        else:
            value = sum((part * Fraction(2) ** (LIMB * limb) for limb, part in parts.items()), Fraction(0))
        out[term] = Total(count, value)
    return out


def evaluated(acc: DataFrame, keys: Sequence[str], names: Sequence[str],
              formulas: Callable[[dict[str, Total]], Sequence[float | None]]) -> DataFrame:
    """``keys`` and one double per name, computed from the exact sums of every group.

    A group has a few entries per term, so the list that one row holds is short whatever the number of its rows.
    """
    keys, names = list(keys), list(names)
    result = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
    kind = pa.struct([(n, pa.float64()) for n in names])

    @F.arrow_udf(result)
    def evaluate(groups: pa.Array) -> pa.Array:
        return pa.array([dict(zip(names, formulas(_totals(entries)))) for entries in groups.to_pylist()], kind)

    lists = acc.groupBy(*keys).agg(F.collect_list(F.struct("term", "limb", F.col("part").cast("string").alias("part"))).alias("__acc"))
    return lists.select(*keys, evaluate("__acc").alias("__result")).select(*keys, *[F.col("__result").getField(n).alias(n) for n in names])


def exact_sums(df: DataFrame, keys: Sequence[str], terms: Mapping[str, Term]) -> DataFrame:
    """``keys`` and the correctly rounded sum of every term per group."""
    names = list(terms)
    return evaluated(accumulated(df, keys, terms), keys, names, lambda t: [t[n].rounded() for n in names])


# ---- numeric agreement -----------------------------------------------------------------------------------------


def numeric_accumulators(df: DataFrame, group: str = GROUP, truth: str = TRUTH, estimate: str = ESTIMATE) -> DataFrame:
    """Accumulators per group behind rsq, mape and rmse, over pairs of which neither is NULL or NaN."""
    y, x = F.col(truth).cast("double"), F.col(estimate).cast("double")
    pairs = df.filter(y.isNotNull() & x.isNotNull() & ~F.isnan(y) & ~F.isnan(x))
    terms: dict[str, Term] = {"y": y, "x": x, "yy": (y, y), "xx": (x, x), "xy": (x, y), "rel": relative_error(y, x)}
    return accumulated(pairs, [group], terms)


def _numeric_formulas(t: dict[str, Total]) -> list[float | None]:
    n = t["y"].count
    y, x, yy, xx, xy = (t[k].exact for k in ("y", "x", "yy", "xx", "xy"))
    rel = t["rel"].value
    if n == t["rel"].count:
        mape = nearest(rel * 100 / n if isinstance(rel, Fraction) else rel)
    else:
        mape = None
    if any(s is None for s in (y, x, yy, xx, xy)):
        return [None, mape, None]
    var_y, var_x, cov = n * yy - y * y, n * xx - x * x, n * xy - x * y
    rsq = nearest(cov * cov / (var_y * var_x)) if var_y > 0 and var_x > 0 else None
    return [rsq, mape, math.sqrt(nearest((yy - 2 * xy + xx) / n))]


def numeric_from_accumulators(acc: DataFrame, group: str = GROUP) -> DataFrame:
    """rsq, mape and rmse per group and overall. An infinite value leaves rsq and rmse undefined (NULL)."""
    both = (
        acc.groupingSets([[group, "term", "limb"], ["term", "limb"]], group, "term", "limb")
        .agg(overall_or(group).alias("__name"), F.sum("part").alias("part"))
        .drop(group)
        .withColumnRenamed("__name", group)
    )
    return evaluated(both, [group], NUMERIC_METRICS, _numeric_formulas)


def metrics_numeric_exact(df: DataFrame, group: str = GROUP, truth: str = TRUTH, estimate: str = ESTIMATE) -> DataFrame:
    """``agreement.metrics_numeric`` with the same bits for every partitioning and order of the rows."""
    return numeric_from_accumulators(numeric_accumulators(df, group, truth, estimate), group)
