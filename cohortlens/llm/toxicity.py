"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel compares two segments by their common subsequences of three letters, each weighted by ``DECAY`` to the length
it spans, gaps included (up to ``SPAN`` characters), and is normalised; letters with others between them still match.
Segments are the words of a sentence, runs of single letters ("i d i o t") being one word.

Training (on the driver, from counts over a bounded sample of labelled documents): every sentence of a toxic document
is a positive example through its most suspicious segment, sentences of clean documents are negative through all of
theirs. Landmarks are the most telling segments of both classes; their kernel matrix gives the Nyström features, on
which a linear machine with squared hinge loss is fitted. Since all landmarks live in the finite space of three-letter
subsequences, the machine folds into one weight per subsequence.

A document's evidence is the two largest decision values of its words and how many of its words, repeated or different,
are called toxic; a logistic model weighs them. It is fitted on documents of one half of the sample as machines see them
that were trained on the other half. The score is the share of toxic ones among such documents of like evidence, pooled
to rise with it.

Defined cases: null or empty texts and texts without letters have the lowest decision value; documents without label do
not train; with labels of one class every score is that class's share; repeated rows get equal scores; an empty table
gives an empty result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.llm.common import at_work, hash_key, keeps
from cohortlens.sources.scratch import written

#: Labelled documents that train at most (those with the smallest hash of their id), and segments kept of either class.
TRAINING_ROWS = 20_000
TRAINING_SEGMENTS = 6_000
LANDMARKS = 480
DECAY, SPAN = 0.6, 6
#: A longer word is read in overlapping windows of this many characters.
WINDOW = 24
#: Share of labelled documents held out of training: those whose crc32 of the id is a multiple of this.
HELD_OUT = 5
#: Decision value of a text without segments.
LOWEST = -2.0
#: Decision values beyond this say no more, and a segment is called toxic above the margin.
MOST = 2.0
MARGIN = 0.3
#: A suspicious segment counts so many times its share of clean sentences as a negative example, too.
_IMPURITY = 3.0
#: A segment counts as toxic from this evidence on (a chance of about 1 in 10 million).
LEAST_EVIDENCE = 28.0
ROUNDS = 2
_COST = 20.0
#: Groups of training documents that calibration starts with.
_POOLS = 100
_REMEMBERED = 400_000
_LETTERS = 32
_SPACE = _LETTERS**3
_PAIRS = [(d1, d2) for d2 in range(2, SPAN) for d1 in range(1, d2)]
_SINGLES = re.compile(r"(?<![^\W\d_])[^\W\d_](?:[\s.,*_-]{1,3}[^\W\d_](?![^\W\d_])){2,}")
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % HELD_OUT == 0


#: Stands before a segment, as one more letter.
_START = "\1"


class _Codes(dict):
    """Letters without their accents are 1 to 26, other letters share 27 to 30; all else is 0, a gap."""

    def __missing__(self, c: int) -> int:
        letter = chr(c)
        base = unicodedata.normalize("NFD", letter)[0]
        if "a" <= base <= "z":
            code = ord(base) - 96
        else:
            code = 27 + c % 4 if letter.isalpha() else 0
        self[c] = code
        return code


_codes = _Codes({ord(_START): 31})


def segment_counts(text: str | None) -> dict[str, int]:
    """The segments of a text, in lower case, with their numbers."""
    lower = (text or "").lower()
    found = Counter(lower.split())
    if sum(len(w) == 1 for w in found) >= 2 or "." in lower and any(w.count(".") > 1 for w in found):
        found.update("".join(run.split()) for run in _SINGLES.findall(lower))
    for w in [w for w in found if len(w) > WINDOW]:
        n = found.pop(w)
        for i in range(0, len(w) - WINDOW // 2, WINDOW // 2):
            found[w[i : i + WINDOW]] += n
    return found


def segments(text: str | None) -> set[str]:
    """The distinct segments of a text, in lower case."""
    return set(segment_counts(text))


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, value) of the normalised kernel features of every word."""
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    gap = "\0" * (SPAN - 1)
    joined = "".join([_START + w + gap for w in words])
    codes = np.array([_codes[c] for c in map(ord, joined)], np.int64)
    owner = np.repeat(np.arange(len(words)), lengths + len(gap))
    keys, values = [], []
    n = len(codes)
    for d1, d2 in _PAIRS:
        i = np.flatnonzero((codes[: n - d2] > 0) & (codes[d1 : n - d2 + d1] > 0) & (codes[d2:] > 0))
        u = (codes[i] * _LETTERS + codes[i + d1]) * _LETTERS + codes[i + d2]
        keys.append(owner[i] * _SPACE + u)
        values.append(np.full(len(i), DECAY ** (d2 + 1)))
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    value = np.bincount(at, np.concatenate(values), minlength=len(key))
    word = key // _SPACE
    norm = np.sqrt(np.bincount(word, value * value, minlength=len(words)))
    return word, key % _SPACE, value / norm[word]


def kernel(words: list[str], landmarks: np.ndarray) -> np.ndarray:
    """Kernel values of words against landmarks given as dense rows of features."""
    word, u, value = subsequences(words)
    out = np.zeros((len(words), len(landmarks)))
    by_feature = np.ascontiguousarray(landmarks.T)
    first = np.searchsorted(word, np.arange(len(words) + 1))
    for at in range(0, len(words), 256):
        upto = min(at + 256, len(words))
        part = slice(first[at], first[upto])
        filled = at + np.flatnonzero(np.diff(first[at : upto + 1]))
        if len(filled):
            out[filled] = np.add.reduceat(by_feature[u[part]] * value[part, None], first[filled] - first[at])
    return out


def _dense(words: list[str]) -> np.ndarray:
    word, u, value = subsequences(words)
    out = np.zeros((len(words), _SPACE), np.float32)
    out[word, u] = value
    return out


def squared_hinge(z: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = _COST) -> np.ndarray:
    """Weights of the linear machine on features ``z`` (last column 1), by Newton steps on the active set."""
    w = np.zeros(z.shape[1])
    active = np.ones(len(y), bool)
    for _ in range(40):
        a, c = z[active], (cost * weight[active])[:, None]
        w = np.linalg.solve(np.eye(z.shape[1]) + a.T @ (c * a), a.T @ (c[:, 0] * y[active]))
        now = y * (z @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


#: Evidence of a document: offset, largest and second decision value, words called toxic, different ones, sum of their values.
EVIDENCE = 6


@dataclass
class Machine:
    """Weight of every subsequence, offset, weights of a document's evidence, and the points between which the weighted
    evidence becomes a score."""

    weights: np.ndarray
    offset: float
    of_evidence: np.ndarray = field(default_factory=lambda: np.eye(EVIDENCE)[1])
    at: np.ndarray = field(default_factory=lambda: np.array([0.0]))
    share: np.ndarray = field(default_factory=lambda: np.array([0.0]))
    _known: dict[str, float] = field(default_factory=dict, repr=False)

    def values(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.empty(0)
        word, u, value = subsequences(words)
        out = np.bincount(word, self.weights[u] * value, minlength=len(words)) + self.offset
        out[np.bincount(word, minlength=len(words)) == 0] = LOWEST
        return out

    def evidence(self, texts: list[str | None]) -> np.ndarray:
        """One row of evidence per text."""
        if len(self._known) > _REMEMBERED:
            self._known.clear()
        known, counts = self._known, [segment_counts(t) for t in texts]
        new = list(set().union(*counts).difference(known)) if counts else []
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            known.update(zip(part, self.values(part).tolist()))
        out = np.zeros((len(texts), EVIDENCE))
        for row, own in zip(out, counts):
            decided = [(known[w], n) for w, n in own.items()]
            largest = max(decided, default=(LOWEST, 1))
            toxic = [(d, n) for d, n in decided if d > MARGIN]
            second = largest[0] if largest[1] > 1 else max((d for d, _ in decided if d < largest[0]), default=LOWEST)
            times = sum(n for _, n in toxic)
            row[:] = 1, min(largest[0], MOST), min(max(second, LOWEST), MOST), min(times, 4), min(len(toxic), 4), np.log1p(sum(d * n for d, n in toxic))
        return out


def evidence_weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic model in which more evidence never counts against a document."""
    used = np.arange(x.shape[1])
    while True:
        w = logistic(x[:, used], y)
        if (w[1:] >= 0).all():
            break
        used = np.delete(used, 1 + int(np.argmin(w[1:])))
    out = np.zeros(x.shape[1])
    out[used] = w
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic model whose first feature is the offset, by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([1e-6] + [1.0] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ ((p * (1 - p))[:, None] * x) + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _segment_counts(sample: DataFrame) -> DataFrame:
    """(segment, toxic, clean): sentences of the sample's documents of either class that hold the segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                words, toxic = [], []
                for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for sentence in _SENTENCE_END.split(text or ""):
                        own = segments(sentence)
                        words += own
                        toxic += [label] * len(own)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(toxic, pa.int64())], names=["segment", "toxic"])

    rows = sample.select("text", F.col("toxic").cast("long")).mapInArrow(run, "segment string, toxic long")
    return rows.groupBy("segment").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))


def calibration(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Increasing decision values and their share of toxic documents: pooled until the shares never fall."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # sum of decisions, toxic documents, documents
    for part in np.array_split(order, min(len(x), _POOLS)):
        pools.append([float(x[part].sum()), float(y[part].sum()), float(len(part))])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    at = np.array([d / n for d, _, n in pools])
    share = np.array([(t + 0.05) / (n + 0.1) for _, t, n in pools])
    # Beyond the outermost pools the score still rises, so order is kept.
    at = np.concatenate([[min(LOWEST, at[0]) - 8.0], at, [at[-1] + 8.0]])
    return at, np.concatenate([[share[0] / 2], share, [(1 + share[-1]) / 2]])


def _fitted(toxic: list[str], clean: list[str], shares: dict[str, float] | None = None) -> Machine:
    """The machine of two lists of segments, the most telling first; the first of each are the landmarks.

    ``shares`` has the share of clean sentences of toxic segments that have some: these are negative examples in part.
    """
    half = LANDMARKS // 2
    landmarks = _dense(toxic[:half] + clean[:half])
    size, directions = np.linalg.eigh((landmarks @ landmarks.T).astype(float) + 1e-6 * np.eye(len(landmarks)))
    root = directions / np.sqrt(np.maximum(size, 1e-6)) @ directions.T
    mixed = [w for w in toxic if shares and w in shares]
    words = toxic + clean + mixed
    z = np.column_stack([kernel(words, landmarks) @ root, np.ones(len(words))])
    y = np.where(np.arange(len(words)) < len(toxic), 1.0, -1.0)
    purity = [1 - shares.get(w, 0.0) if shares else 1.0 for w in toxic]
    impure = [_IMPURITY * shares[w] for w in mixed] if shares else []
    each, other = (len(toxic) + len(clean)) / (2 * len(toxic)), (len(toxic) + len(clean)) / (2 * len(clean))
    weight = np.concatenate([each * np.array(purity), np.full(len(clean), other), each * np.array(impure)])
    fitted = squared_hinge(z, y, weight)
    return Machine(landmarks.T @ (root @ fitted[:-1]), float(fitted[-1]))


#: Letters and signs that stand for inserted ones.
_INSERTED = "x.ae1*uo-is"


def _disguised(words: list[str]) -> list[str]:
    """The words with a sign between all letters, with a letter or sign inserted in several places, with one doubled."""
    spaced = ["-".join(w) for w in words if 3 <= len(w) <= WINDOW // 2]
    inserted = []
    for i, w in enumerate(w for w in words if len(w) > 3):
        places = range(1, len(w))
        inserted += [w[:at] + _INSERTED[(i + at) % len(_INSERTED)] + w[at:] for at in places[i % 2 :: 2][:4]]
        at = places[i % len(places)]
        inserted.append(w[:at] + w[at - 1] + w[at:])
    return spaced + inserted


def _evidence(toxic: Column, clean: Column, share: float) -> Column:
    """Twice the log-likelihood ratio of a segment's toxic sentences against their overall share; 0 if below it."""
    both = toxic + clean
    term = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    return F.when(toxic > both * share, 2 * (term(toxic, both * share) + term(clean, both * (1 - share)))).otherwise(0.0)


def train(sample: DataFrame) -> Machine:
    """A machine from the documents (text, toxic) of a bounded sample, with the weights of a document's evidence, which
    come from documents that the machine they are seen by was not trained on."""
    half = F.pmod(F.xxhash64("text"), F.lit(2)).alias("half")
    sample = written(sample.select("text", F.col("toxic").cast("int").alias("toxic"), half), "toxicity-sample")
    machine = trained_machine(sample)
    seen = []
    for other in (0, 1):
        halved = trained_machine(sample.where(F.col("half") != other))
        # A half without telling segments, as when all toxic texts are one, is seen by the machine of both.
        seen.append(with_evidence(sample.where(F.col("half") == other), halved if halved.weights.any() else machine).select("evidence", "toxic").toArrow())
    seen = [t for t in seen if t.num_rows]
    if not machine.weights.any() or not seen:
        return machine
    x = np.concatenate([t.column("evidence").combine_chunks().flatten().to_numpy().reshape(-1, EVIDENCE) for t in seen])
    y = np.concatenate([t.column("toxic").to_numpy() for t in seen]).astype(float)
    machine.of_evidence = evidence_weights(x, y)
    machine.at, machine.share = calibration(x @ machine.of_evidence, y)
    return machine


def trained_machine(sample: DataFrame) -> Machine:
    """The machine alone.

    Segments whose share of toxic sentences is no chance start as positives, random and frequent others as negatives.
    Each round then adds what the machine of the last round finds: the clean segments with the largest decision values,
    and segments of half the evidence that it calls toxic and that no clean sentence holds. Positives also train in
    disguise: gapped, and with an inserted character.
    """
    classes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    share = classes.get(1, 0) / max(1, sum(classes.values()))
    chance = Machine(np.zeros(_SPACE), 0.0, share=np.array([share]))
    if len(classes) < 2:
        return chance
    counts = written(_segment_counts(sample), "toxicity-segments")
    total = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    if not total["toxic"] or not total["clean"]:
        return chance
    part = total["toxic"] / (total["toxic"] + total["clean"])
    rated = counts.withColumn("evidence", _evidence(F.col("toxic"), F.col("clean"), part))
    plain = rated.where((F.col("clean") >= 1) & (F.col("evidence") < LEAST_EVIDENCE / 2))

    shares: dict[str, float] = {}

    def take(rows: DataFrame, n: int, *order: Column) -> list[str]:
        found = rows.orderBy(*order, "segment").limit(n).collect()
        shares.update({r["segment"]: r["clean"] / (r["clean"] + r["toxic"]) for r in found if r["clean"]})
        return [r["segment"] for r in found if len(subsequences([r["segment"]])[0])]

    third = TRAINING_SEGMENTS // 3
    strong = take(rated.where(F.col("evidence") >= LEAST_EVIDENCE), third, F.col("evidence").desc())
    common = take(plain, third // 2, F.col("clean").desc()) + take(plain, third, hash_key("segment", F.col("segment")))
    if not strong or not common:
        return chance
    positive, negative = strong, list(dict.fromkeys(common))
    machine = _fitted(positive + _disguised(positive), negative, shares)
    for _ in range(ROUNDS):
        likely = rated.where((F.col("clean") == 0) & (F.col("evidence") >= LEAST_EVIDENCE / 2))
        more = take(decided_segments(likely, machine).where("decision > 0.25"), third // 2, F.col("evidence").desc())
        hard = take(decided_segments(plain, machine), third, F.col("decision").desc())
        positive, negative = list(dict.fromkeys(positive + more)), list(dict.fromkeys(hard + negative))
        machine = _fitted(positive + _disguised(positive), negative, shares)
    return machine


_worker: dict[bytes, Machine] = {}


def _at_work(machine: Machine) -> Callable[[], Machine]:
    """How a task gets the machine; a worker keeps one."""
    weights, rest = machine.weights.astype(np.float32), (machine.offset, machine.of_evidence, machine.at, machine.share)
    name = weights.tobytes() + machine.of_evidence.tobytes()

    def own() -> Machine:
        at_work("toxicity")
        keeps("toxicity", _worker.clear)
        if name not in _worker:
            _worker.clear()
            _worker[name] = Machine(weights.astype(float), *rest)
        return _worker[name]

    return own


def with_evidence(docs: DataFrame, machine: Machine) -> DataFrame:
    """The documents with a column ``evidence``."""
    own = _at_work(machine)

    @F.arrow_udf("array<double>")
    def evidence(texts: pa.Array) -> pa.Array:
        out = [own().evidence(texts.slice(at, 256).to_pylist()) for at in range(0, len(texts), 256)]
        flat = np.concatenate([np.empty((0, EVIDENCE)), *out]).ravel()
        return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * EVIDENCE), pa.array(flat))

    return docs.withColumn("evidence", evidence(F.col("text")))


def decided_segments(counts: DataFrame, machine: Machine) -> DataFrame:
    own = _at_work(machine)

    @F.arrow_udf("double")
    def decide(words: pa.Array) -> pa.Array:
        return pa.array(own().values(words.to_pylist()), pa.float64())

    return counts.withColumn("decision", decide(F.col("segment")))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents that are not held out."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    chosen = chosen.orderBy(hash_key("toxic", F.col("doc_id")), "toxic").limit(rows)
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return picked.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")  # repeated rows count once


def scored(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """Per document: doc_id, score (0 to 1)."""
    own = _at_work(train(training_sample(docs, labels, rows)))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out = [np.empty(0)]
        for at in range(0, len(texts), 256):
            machine = own()
            weighted = machine.evidence(texts.slice(at, 256).to_pylist()) @ machine.of_evidence
            out.append(np.interp(weighted, machine.at, machine.share))
        return pa.array(np.concatenate(out))

    return docs.select("doc_id", score(F.col("text")).alias("score"))
