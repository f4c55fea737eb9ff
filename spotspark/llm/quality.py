"""Quality classifier: ordinal cumulative-link regression of graded ratings on hashed text.

P(grade <= k) = sigmoid(threshold_k - f(x)) with one weight vector f for all grades and ordered thresholds, so that the
expected grade and the tail probability P(grade >= k) come from one number. x holds the share of each hashed feature among
a text's words: the word, the shape of its ends (case, digits, marks), a repeat of the word before, a marked end.

It is fitted on a bounded sample of the rated documents (at most FIT_ROWS with at most FIT_WORDS words in all, the least hashes of
doc_id), every document is scored.

Defined cases: null text is empty and gets the score of f = 0 (thresholds alone); null ratings are left out; a doc_id rated
twice counts with its highest rating, one whose rows repeat with its least text; without any rating, or with one grade only, every tail probability is 1; grades are the
distinct ratings in order (at most 16). Ties, repeated rows and extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import _GOLD, SPACE, blocks, labelled_sample, map_arrow, mix, owner, strings, words

#: Most rated documents that are fitted on, and hashed features as bits.
FIT_ROWS, FIT_WORDS, BITS = 6000, 4_000_000, 16
ROUNDS, RATE, RIDGE = 120, 0.5, 1e-4
#: Least P(grade >= GOOD) of a document that is kept.
KEEP = 0.5
_SHAPE = np.zeros(256, np.uint64)  # of a byte: 0 mark (as it is), 1 lower, 2 upper, 3 digit, 4 other script
_SHAPE[:] = np.arange(256, dtype=np.uint64) + np.uint64(8)
_SHAPE[97:123], _SHAPE[65:91], _SHAPE[48:58], _SHAPE[128:] = 1, 2, 3, 4


def features(data: np.ndarray, at: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed feature, text, share) of a block: four features a word, each family's shares adding up to 1."""
    hashed, starts, ends, bounds = words(data, at, SPACE)
    if not len(hashed):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    own, counts = owner(bounds), np.diff(bounds)
    shape = lambda k: _SHAPE[data[np.clip(k, 0, len(data) - 1)]]
    long_ = (ends - starts > 1).astype(np.uint64)
    with np.errstate(over="ignore"):
        form = shape(starts) + (shape(starts + 1) * long_ << np.uint64(9)) + (shape(ends - 1) << np.uint64(18)) + (shape(np.maximum(starts, ends - 2)) << np.uint64(27))
        again = np.zeros(len(hashed), np.uint64)
        again[1:] = (hashed[1:] == hashed[:-1]) & (own[1:] == own[:-1])
        families = [mix(hashed + _GOLD), mix(form * _GOLD + np.uint64(7)), mix(again * _GOLD + np.uint64(11)), mix(shape(ends - 1) * _GOLD + np.uint64(13))]
    index = np.concatenate([(f >> np.uint64(64 - bits)).astype(np.int64) for f in families])
    return index, np.tile(own, len(families)), np.tile(1.0 / counts[own], len(families))


@dataclass
class Ordinal:
    """weights, thresholds (one fewer than grades) and the grades themselves, in order."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[float]

    def tails(self, f: np.ndarray) -> np.ndarray:
        """P(grade >= grades[k]) for k = 1, ..., by row."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - f[:, None], -50, 50)))

    def expected(self, f: np.ndarray) -> np.ndarray:
        return self.grades[0] + self.tails(f) @ np.diff(self.grades) if len(self.grades) > 1 else np.full(len(f), self.grades[0])


def fit_ordinal(index: np.ndarray, row: np.ndarray, value: np.ndarray, grade: np.ndarray, grades: list[float], bits: int = BITS, rounds: int = ROUNDS) -> Ordinal:
    """Full-batch Adam on the likelihood. grade holds positions in grades. Thresholds stay ordered: they are a first one and
    the exponentials of steps."""
    k, n = len(grades) - 1, len(grade)
    share = np.clip(np.array([(grade >= j + 1).mean() for j in range(k)]), 1e-3, 1 - 1e-3)
    start = np.sort(-np.log(share / (1 - share)))
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    w = np.zeros(1 << bits)
    m, v = [np.zeros_like(w), np.zeros_like(free)], [np.zeros_like(w), np.zeros_like(free)]
    theta = start
    for t in range(1, rounds + 1):
        theta = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
        f = np.bincount(row, value * w[index], n)
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        hi, lo = (1 / (1 + np.exp(np.clip(f - edge[grade + d], -50, 50))) for d in (1, 0))
        p = np.maximum(hi - lo, 1e-9)
        dhi, dlo = hi * (1 - hi) / p, lo * (1 - lo) / p  # of log p by the upper and lower threshold
        df = dlo - dhi
        g_theta = np.array([dlo[grade == j + 1].sum() - dhi[grade == j].sum() for j in range(k)]) / n
        g_free = np.concatenate([[g_theta.sum()], np.exp(free[1:]) * np.cumsum(g_theta[::-1])[::-1][1:]])
        g_w = -np.bincount(index, value * df[row], len(w)) / n + RIDGE * w
        for j, (x, g) in enumerate(((w, g_w), (free, g_free))):
            m[j] = 0.9 * m[j] + 0.1 * g
            v[j] = 0.99 * v[j] + 0.01 * g * g
            x -= RATE * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.99**t)) + 1e-6)
    return Ordinal(w, theta, grades)


def fit(docs: DataFrame, labels: DataFrame, rating: str = "quality", rows: int = FIT_ROWS, most_words: int = FIT_WORDS) -> Ordinal:
    """Fits on at most `rows` rated documents with at most `most_words` words; their features, fewer than five a word, are made on the
    executors and gathered."""
    rated = labels.where(F.col(rating).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(rating).cast("double")).alias("grade"))
    joined = labelled_sample(docs, rated, rows, most_words).select("doc_id", "text", "grade")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in blocks(strings(batch.column(1))):
                index, row, value = features(data, at)
                key, where = np.unique(row * (1 << BITS) + index, return_inverse=True)
                value = np.bincount(where, value, len(key)).astype(np.float32)
                cut = np.searchsorted(key, np.arange(j - i + 1) * (1 << BITS))
                index = (key & ((1 << BITS) - 1)).astype(np.int32)
                packed = [(index[a:b].tobytes(), value[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array([p[0] for p in packed], pa.binary()), pa.array([p[1] for p in packed], pa.binary())], names=["doc_id", "grade", "index", "value"])

    found = map_arrow(joined, run, "doc_id long, grade double, index binary, value binary").orderBy("doc_id").collect()
    grades = sorted({r["grade"] for r in found})
    if len(grades) < 2:
        return Ordinal(np.zeros(1 << BITS), np.zeros(0), grades or [0.0])
    if len(grades) > 16:
        raise ValueError("ratings have more than 16 grades")
    index = [np.frombuffer(r["index"], np.int32) for r in found]
    row = np.repeat(np.arange(len(found)), [len(x) for x in index])
    value = np.concatenate([np.frombuffer(r["value"], np.float32) for r in found]).astype(np.float64)
    place = {g: k for k, g in enumerate(grades)}
    return fit_ordinal(np.concatenate(index).astype(np.int64), row, value, np.array([place[r["grade"]] for r in found]), grades)


def score(docs: DataFrame, model: Ordinal, good: float | None = None) -> DataFrame:
    """docs with expected_grade and good_probability = P(grade >= good) (good: the second grade if not given)."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # 2 ** BITS weights
    level = next((k for k, g in enumerate(model.grades) if g >= (model.grades[min(1, len(model.grades) - 1)] if good is None else good)), len(model.grades))
    added = ["expected_grade", "good_probability"]
    kept = [c for c in docs.columns if c not in added]
    at_text = kept.index("text")
    schema = type(docs.schema)([docs.schema[c] for c in kept]).add("expected_grade", "double").add("good_probability", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            f = np.zeros(batch.num_rows)
            for i, j, data, at in blocks(strings(batch.column(at_text))):
                index, row, value = features(data, at)
                f[i:j] = np.bincount(row, value * m.weights[index], j - i)
            tail = np.ones(len(f)) if level == 0 else np.zeros(len(f)) if level >= len(m.grades) else m.tails(f)[:, level - 1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(m.expected(f)), pa.array(tail)], names=[*kept, *added])

    return map_arrow(docs.select(*[F.col(f"`{c}`") for c in kept]), run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, least: float = KEEP) -> DataFrame:
    """docs that the classifier does not reject, with their own columns."""
    model = fit(docs, labels)
    names = docs.columns
    return score(docs, model).where(F.col("good_probability") >= least).select(*[F.col(f"`{c}`") for c in names])
