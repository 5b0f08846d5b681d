"""Quality rules as a learned decision list.

Every text gets statistics of its words, lines and symbols. From a bounded sample of labelled documents, sequential
covering learns an ordered list of threshold conjunctions for the low-quality class: a rule grows by the condition with
the best information gain on one part of the sample, is pruned on the other part, and joins the list if it is precise
there; covered documents leave. The list becomes one ordered Spark conditional expression over the statistics.

Defined cases: a null or empty text has no words and all statistics are 0; documents without labels do not train;
labels of one class give an empty list, which keeps everything; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.llm.common import at_work, hash_key

#: Labelled documents that train the list at most, those with the smallest hash of their id.
TRAINING_ROWS = 20_000
#: A rule needs this precision on documents it was not grown on, and covers this share of the sample at least.
LEAST_PRECISION, LEAST_SHARE = 0.9, 0.002
MOST_RULES, MOST_CONDITIONS = 16, 4
#: Candidate thresholds per statistic.
_CUTS = 32
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
_COUNTS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_distinct_words n_upper_words n_exclamations "
    "n_digits n_pipes n_short_words n_full_stops"
).split()
_UPPER = re.compile(r"[^\W\d_a-zà-öø-ÿß]{2,}")


def _repeated_words(words: list[bytes]) -> int:
    """Words inside windows of 8 that occur twice or more. Windows are compared by exact ids, doubled three times."""
    if len(words) <= REPEAT_WINDOW:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == len(words):
        return 0
    step = 1
    while step < REPEAT_WINDOW:
        pairs = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        ids = np.unique(pairs, return_inverse=True)[1]
        step *= 2
    again = np.bincount(ids)[ids] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[: len(again)] += again
    edges[REPEAT_WINDOW : REPEAT_WINDOW + len(again)] -= again
    return int((np.cumsum(edges)[:-1] > 0).sum())


def text_statistics(text: str | None) -> tuple[int, ...]:
    """The counts named in ``_COUNTS``."""
    if not text:
        return (0,) * len(_COUNTS)
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
    blanks = sum(map(text.count, " \t\n\v\f\r"))
    return (
        len(words), len(text) - blanks, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), _repeated_words(words),
        len(lines), len(set(words)), len(_UPPER.findall(text)), text.count("!"), sum(map(text.count, "0123456789")),
        text.count("|"), sum(len(w) < 3 for w in words), text.count("."),
    )


def with_statistics(docs: DataFrame) -> DataFrame:
    """The documents with a struct column ``__stats``."""

    @F.arrow_udf(", ".join(f"{c} long" for c in _COUNTS))
    def measure(texts: pa.Array) -> pa.Array:
        at_work("quality")
        rows = [text_statistics(t.as_py()) for t in texts]
        columns = list(zip(*rows)) or [()] * len(_COUNTS)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_COUNTS)

    return docs.withColumn("__stats", measure(F.col("text")))


def _ratios() -> dict[str, tuple[str, str]]:
    """Features: name -> (count, divisor)."""
    per_word = {f"{c}_per_word": (c, "n_words") for c in _COUNTS[1:] if c not in ("n_dup_lines", "n_lines")}
    return {"n_words": ("n_words", ""), **per_word, "dup_lines": ("n_dup_lines", "n_lines"), "words_per_line": ("n_words", "n_lines")}


def feature(name: str, stats: str = "__stats") -> Column:
    above, below = _ratios()[name]
    value = F.col(f"{stats}.{above}").cast("double")
    return value / F.greatest(F.col(f"{stats}.{below}"), F.lit(1)) if below else value


def _features(counts: np.ndarray) -> dict[str, np.ndarray]:
    at = {c: counts[:, i].astype(float) for i, c in enumerate(_COUNTS)}
    return {n: at[a] / np.maximum(at[b], 1) if b else at[a] for n, (a, b) in _ratios().items()}


@dataclass(frozen=True)
class Condition:
    """``feature > threshold`` or ``feature <= threshold``."""

    name: str
    above: bool
    threshold: float

    def holds(self, features: dict[str, np.ndarray]) -> np.ndarray:
        return (features[self.name] > self.threshold) == self.above

    def column(self) -> Column:
        value = feature(self.name)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def _covers(rule: Rule, features: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(features.values()))), bool)
    for condition in rule:
        out &= condition.holds(features)
    return out


def _between(values: np.ndarray, low: np.ndarray, cut: float, above: bool) -> float:
    """A threshold half way from the cut to the low documents that it is meant for, so that it does not rest on chance."""
    meant = values[low & (values > cut)] if above else values[values > cut]
    if not len(meant):
        return cut
    return (cut + float(np.quantile(meant, 0.02) if above else meant.min())) / 2


def _grow(features: dict[str, np.ndarray], low: np.ndarray) -> Rule:
    """Add the condition with the best gain (bits saved per low document kept) until the rule is pure."""
    rule: list[Condition] = []
    covered = np.ones(len(low), bool)
    while len(rule) < MOST_CONDITIONS and (covered & ~low).any():
        p0, n0 = (covered & low).sum(), covered.sum()
        best, best_gain = None, 1e-9
        for name, values in features.items():
            inside = values[covered]
            cuts = np.unique(np.quantile(inside, np.linspace(0, 1, _CUTS + 2)[1:-1]))
            for above in (True, False):
                hits = (inside[None, :] > cuts[:, None]) == above
                n, p = hits.sum(1), (hits & low[covered][None, :]).sum(1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / n) - np.log2(p0 / n0)), -1.0)
                i = int(np.argmax(gain))
                if gain[i] > best_gain:
                    best, best_gain = Condition(name, above, _between(inside, low[covered], float(cuts[i]), above)), gain[i]
        if best is None:
            break
        rule.append(best)
        covered &= best.holds(features)
    return tuple(rule)


def _worth(rule: Rule, features: dict[str, np.ndarray], low: np.ndarray) -> float:
    covered = _covers(rule, features)
    p, n = (covered & low).sum(), covered.sum()
    return (p - (n - p) * LEAST_PRECISION / (1 - LEAST_PRECISION)) / max(1, low.sum())


def _prune(rule: Rule, features: dict[str, np.ndarray], low: np.ndarray) -> Rule:
    """Drop trailing conditions while that does not lower the worth on documents the rule was not grown on."""
    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if _worth(rule[:k], features, low) >= _worth(best, features, low):
            best = rule[:k]
    return best


def decision_list(counts: np.ndarray, low: np.ndarray, seed: int = 5) -> list[Rule]:
    """Ordered rules for the low class by sequential covering. ``counts`` has the columns of ``_COUNTS``."""
    rules: list[Rule] = []
    if not len(low) or low.all() or not low.any():
        return rules
    features = _features(counts)
    held = np.random.default_rng(seed).random(len(low)) < 1 / 3
    left = np.ones(len(low), bool)
    while len(rules) < MOST_RULES and (left & ~held & low).any():
        grow, check = left & ~held, left & held
        rule = _grow({k: v[grow] for k, v in features.items()}, low[grow])
        checked = {k: v[check] for k, v in features.items()}
        rule = _prune(rule, checked, low[check]) if rule else rule
        hits = _covers(rule, checked)
        enough = hits.sum() >= max(3, LEAST_SHARE * check.sum())
        if not rule or not enough or (low[check] & hits).sum() < LEAST_PRECISION * hits.sum():
            break
        rules.append(rule)
        left &= ~_covers(rule, features)
    return rules


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and low-quality flags of at most ``rows`` labelled documents."""
    chosen = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality").distinct()
    chosen = chosen.orderBy(hash_key("quality", F.col("doc_id")), "quality").limit(rows)
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    picked = picked.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))  # repeated rows count once
    found = with_statistics(picked).select("quality", "__stats.*").toArrow()
    counts = np.column_stack([found.column(c).to_numpy() for c in _COUNTS]) if found.num_rows else np.empty((0, len(_COUNTS)))
    order = np.lexsort(counts.T) if len(counts) else np.empty(0, int)
    return counts[order], (found.column("quality").to_numpy() == 0)[order] if len(counts) else np.empty(0, bool)


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, else null: one ordered conditional expression."""
    out: Column | None = None
    for i, rule in enumerate(rules):
        holds = rule[0].column()
        for condition in rule[1:]:
            holds = holds & condition.column()
        out = F.when(holds, F.lit(i)) if out is None else out.when(holds, F.lit(i))
    return F.lit(None).cast("int") if out is None else out


def base_failed(stats: str = "__stats") -> Column:
    """Fewer than 20 words, or more than 30 % of them in repeated windows."""
    return (F.col(f"{stats}.n_words") < 20) | (100 * F.col(f"{stats}.n_repeat_words") > 30 * F.col(f"{stats}.n_words"))


def judged(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """The documents with ``__stats``, ``__rule`` (first rule that holds) and ``__kept``."""
    rules = decision_list(*training_sample(docs, labels, rows))
    measured = with_statistics(docs).withColumn("__rule", verdict(rules))
    return measured.withColumn("__kept", ~base_failed() & F.col("__rule").isNull())
