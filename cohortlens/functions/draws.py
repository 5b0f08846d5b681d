"""Reproducible random draws: the same draw on every run, partitioning and retry."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, functions as F

# A published 64-bit finaliser (two multipliers, three shifts) and two odd steps for its counters.
MIX_MULTIPLIERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
MIX_SHIFTS = (30, 27, 31)
POSITION_STEP = 0x9E3779B97F4A7C15
REPLICATE_STEP = 0xD1342543DE82EF95

_U = np.uint64
UNIFORM_BITS = 53


def draw60(*parts: Column | str | int) -> Column:
    """60 uniform bits as a non-negative bigint, determined by the texts of ``parts``."""
    texts = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 15), 16, 10).cast("bigint")


#: How many standard deviations the expected total of a stratum's counts stays below its size.
SLACK = 3.0


#: The same for draws per cell, where a stratum that is overfull costs a pick for each of its rows.
CELL_SLACK = 6.0


def thinned_rate(n: int, slack: float = SLACK) -> float:
    """Poisson rate per row such that ``n`` rows rarely exceed ``n`` draws in total; 0 for very small ``n``."""
    return max(0.0, 1.0 - slack / math.sqrt(n)) if n > 0 else 0.0


@lru_cache(maxsize=256)
def poisson_cutoffs(n: int, slack: float = SLACK) -> tuple[int, ...]:
    """A 53-bit uniform at or above the k-th cutoff means a count above k.

    The cutoffs go on while another count still raises them, so no uniform is cut short.
    """
    rate = thinned_rate(n, slack)
    term = total = math.exp(-rate)
    cuts = [math.floor(total * 2.0**UNIFORM_BITS)]
    while cuts[-1] < 2**UNIFORM_BITS:
        term = term * rate / len(cuts)
        total += term
        if total == total - term:  # what is left is below the resolution of the uniform
            break
        cuts.append(math.floor(total * 2.0**UNIFORM_BITS))
    return tuple(cuts)


def _mix(z: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser, in place on an array of uint64."""
    for shift, factor in zip(MIX_SHIFTS, MIX_MULTIPLIERS):
        z ^= z >> _U(shift)
        z *= _U(factor)
    z ^= z >> _U(MIX_SHIFTS[2])
    return z


#: Cells that are drawn at once, in buffers that stay in the processor's cache.
_CELLS_AT_ONCE = 32_768
#: Cutoffs that are compared with every cell; the few cells above them are compared with the others alone.
_COMMON_CUTOFFS = 5


def poisson_counts(
    stratum_key: int, n: int, positions: np.ndarray, replicates: np.ndarray, slack: float = SLACK
) -> np.ndarray:
    """Counts (replicates x positions, uint8) of a thinned Poisson draw per row and replicate."""
    row = _mix(_U(stratum_key) + positions.astype(_U) * _U(POSITION_STEP))
    step = replicates.astype(_U) * _U(REPLICATE_STEP)
    # Uniforms are the upper bits; a cutoff above all of them has no effect.
    cuts = [_U(c << (64 - UNIFORM_BITS)) for c in poisson_cutoffs(n, slack) if c < 2**UNIFORM_BITS]
    counts = np.zeros((len(step), len(row)), dtype=np.uint8)
    if not (len(row) and len(step) and cuts):
        return counts
    # Blocks of whole rows of ``counts``, or of a part of one: either lies in one piece.
    height, width = min(max(1, _CELLS_AT_ONCE // len(row)), len(step)), min(len(row), _CELLS_AT_ONCE)
    u, spare, above = (np.empty(height * width, t) for t in (_U, _U, bool))
    for top in range(0, len(step), height):
        steps = step[top : top + height, None]
        for left in range(0, len(row), width):
            own, block = row[left : left + width], counts[top : top + height, left : left + width]
            n = block.size
            np.add(own[None, :], steps, out=u[:n].reshape(block.shape))
            _cells_above(cuts, block.reshape(-1), u[:n], spare[:n], above[:n])
    return counts


def _cells_above(cuts: list[np.uint64], counts: np.ndarray, u: np.ndarray, spare: np.ndarray, above: np.ndarray) -> None:
    """Add to ``counts`` how many of the cutoffs each cell's uniform reaches, which ``u`` becomes by the finaliser."""
    for shift, factor in zip(MIX_SHIFTS, MIX_MULTIPLIERS):
        np.right_shift(u, _U(shift), out=spare)
        np.bitwise_xor(u, spare, out=u)
        np.multiply(u, _U(factor), out=u)
    np.right_shift(u, _U(MIX_SHIFTS[2]), out=spare)
    np.bitwise_xor(u, spare, out=u)
    for cut in cuts[:_COMMON_CUTOFFS]:
        np.greater_equal(u, cut, out=above)
        np.add(counts, above.view(np.uint8), out=counts)
    far = np.flatnonzero(above)
    rest = u[far]
    for cut in cuts[_COMMON_CUTOFFS:]:
        reached = rest >= cut
        if not reached.any():
            break
        counts[far] += reached.view(np.uint8)


def poisson_quantiles(mean: float, u: np.ndarray) -> np.ndarray:
    """Poisson counts of a mean of any size from 53-bit uniforms, by the cumulative table.

    The table spans nine standard deviations and 30 counts to either side of the mean; what lies beyond has a
    probability below the resolution of the uniform. Terms follow from their neighbours, so nothing under- or overflows.
    """
    if mean <= 0:
        return np.zeros(len(u), np.int64)
    reach = 9 * math.sqrt(mean) + 30
    low, high = max(0, math.floor(mean - reach)), math.ceil(mean + reach)
    k = np.arange(low + 1, high + 1, dtype=float)
    logs = np.concatenate([[0.0], np.cumsum(np.log(mean / k))])
    terms = np.exp(logs - logs.max())
    table = np.cumsum(terms)
    return low + np.searchsorted(table / table[-1], u / 2.0**UNIFORM_BITS, side="right").astype(np.int64)
