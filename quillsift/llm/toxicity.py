"""Toxicity by cumulative-link ordinal regression on sparse text features.

``labels`` has two classes only, so grades are formed from it: 0 for clean documents, and 1 to 3 for toxic ones by
the third in which the share of their marker words falls (words that labelled toxic documents use and clean ones hardly
do). The model has one weight a feature, shared by all thresholds, and ordered thresholds t1 < t2 < t3:
P(grade >= k) = sigmoid(w.x - t_k). Features are hashed lower-case letter runs with log(1 + count), so a few words in
a long text count as much as in a short one. The output is the expected grade, the sum of P(grade >= k).

The model is fitted on the driver from at most ``MAX_ROWS`` labelled documents, those of smallest hash of doc_id, so
the sample spreads over all data; a word gets a weight if ``LEAST`` of them have it. The grade from which a document counts
as toxic is fitted as well: each fold of the sample is scored by a model of the other folds, and the cut is the one of
least balanced error (the mean of the shares of toxic and of clean documents told wrongly) on these held-out scores. Scoring
is one pass over whole texts, without a shuffle.

Defined cases: a null or empty text scores as a text without features; labels that are null or lack a document are left out;
without labels of both classes every document scores 0; with fewer than ``2 * FOLDS`` labelled documents of a class the cut
is ``CUT``; repeated rows score alike; an empty table gives an empty
result; columns of other names are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsift.scratch import small_batches

#: The bound on labelled rows that the fit reads.
MAX_ROWS = 10_000
DIM = 1 << 18
GRADES = 3
LEAST, FOLDS = 3, 3
#: The cut of a model that has too few labelled rows to fit one.
CUT = 0.5
_WORD = re.compile(r"[^\W\d_]+")


@lru_cache(maxsize=100_000)
def bucket(word: str) -> int:
    return xxhash.xxh64_intdigest(word) % DIM


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and log counts of a whole text."""
    words = _WORD.findall((text or "").lower())
    ids, n = np.unique(np.fromiter(map(bucket, words), np.int64, len(words)), return_counts=True)
    return ids, np.log1p(n)


@dataclass
class Ordinal:
    """One weight a feature, the thresholds, and the expected grade from which a document is toxic."""

    weights: np.ndarray
    thresholds: np.ndarray
    cut: float = CUT

    def expected(self, ids: np.ndarray, values: np.ndarray) -> float:
        s = float(self.weights[ids] @ values) if len(ids) else 0.0
        return float((1 / (1 + np.exp(np.clip(self.thresholds - s, -60, 60)))).sum())


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def ordered(t: np.ndarray) -> np.ndarray:
    """Thresholds, from the first one and the logs of the gaps."""
    return t[0] + np.concatenate(([0], np.cumsum(np.exp(t[1:]))))


def likelihood(s: np.ndarray, t: np.ndarray, grade: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log likelihood of the grades at scores ``s``, and its gradients by each score and by ``t``."""
    n, row = len(s), np.arange(len(s))
    p = np.column_stack([np.ones(n), *(_sigmoid(s - x) for x in ordered(t)), np.zeros(n)])
    like = np.maximum(p[row, grade] - p[row, grade + 1], 1e-12)
    d = p * (1 - p)
    ds = -(d[row, grade] - d[row, grade + 1]) / like
    dth = np.array([(((grade == k + 1) * d[:, k + 1] - (grade == k) * d[:, k + 1]) / like).sum() for k in range(GRADES)])
    dt = np.concatenate(([dth.sum()], [dth[k:].sum() * np.exp(t[k]) for k in range(1, GRADES)]))
    return float(-np.log(like).mean()), ds / n, dt / n


def _grades(doc: np.ndarray, ids: np.ndarray, values: np.ndarray, toxic: np.ndarray, dim: int) -> np.ndarray:
    """0 for clean documents; 1 to 3 for toxic ones, by the third in which their share of marker words falls."""
    yes = np.bincount(ids, toxic[doc], dim) + 0.5
    no = np.bincount(ids, 1 - toxic[doc], dim) + 0.5
    marker = np.log(yes / (toxic.sum() + 1)) - np.log(no / ((1 - toxic).sum() + 1)) > 2.5
    share = np.bincount(doc, values * marker[ids], len(toxic)) / np.maximum(np.bincount(doc, values, len(toxic)), 1e-9)
    cuts = np.quantile(share[toxic > 0], [1 / 3, 2 / 3])
    return np.where(toxic > 0, 1 + np.searchsorted(cuts, share), 0)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, rounds: int = 120, l2: float = 1e-3, least: int = LEAST) -> Ordinal:
    """Maximum likelihood by full-batch Adam; the same rows in the same order give the same model."""
    if not len(toxic) or toxic.min() == toxic.max():
        return Ordinal(np.zeros(DIM, np.float32), np.full(GRADES, 60.0))
    doc = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    ids, values = np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]).astype(float)
    used = np.flatnonzero(np.bincount(ids, minlength=DIM) >= least)
    place = np.full(DIM, -1)
    place[used] = np.arange(len(used))
    some = place[ids] >= 0
    doc, ids, values = doc[some], place[ids[some]], values[some]
    grade = _grades(doc, ids, values, toxic, len(used))
    w, t = np.zeros(len(used)), np.array([1.0, 0.0, 0.0])
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, t)]
    for step in range(1, rounds + 1):
        _, ds, dt = likelihood(np.bincount(doc, w[ids] * values, len(rows)), t, grade)
        grads = (np.bincount(ids, values * ds[doc], len(used)) + l2 * w, dt)
        for x, g, m in zip((w, t), grads, moments, strict=True):
            m[0] += 0.1 * (g - m[0])
            m[1] += 0.001 * (g * g - m[1])
            x -= 0.1 * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(DIM, np.float32)
    weights[used] = w
    return Ordinal(weights, ordered(t))


def balanced_cut(scores: np.ndarray, toxic: np.ndarray) -> float:
    """Between two neighbouring scores, where the balanced error is least; of equal ones the middle one."""
    by = np.argsort(scores, kind="stable")
    s, y = scores[by], toxic[by]
    missed = np.concatenate(([0], np.cumsum(y))) / y.sum()
    wrong = np.concatenate((np.cumsum((1 - y)[::-1])[::-1], [0])) / (1 - y).sum()
    edge = np.concatenate(([False], s[1:] > s[:-1], [False]))  # a cut can't part equal scores
    if not edge.any():
        return CUT
    error = np.where(edge, missed + wrong, 9.0)
    best = np.flatnonzero(error <= error.min() + 1e-12)
    k = best[len(best) // 2]
    return float((s[k - 1] + s[k]) / 2)


def fit_with_cut(rows: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, folds: int = FOLDS) -> Ordinal:
    """A model of all rows, with the cut of least balanced error on scores of rows that the scoring model has not seen."""
    model = fit(rows, toxic)
    if min(toxic.sum(), (1 - toxic).sum()) < 2 * folds:
        return model
    fold = np.zeros(len(toxic), int)
    for kind in (0, 1):
        own = np.flatnonzero(toxic == kind)
        fold[own] = np.arange(len(own)) % folds
    held = np.zeros(len(toxic))
    for k in range(folds):
        other = fit([rows[i] for i in np.flatnonzero(fold != k)], toxic[fold != k])
        held[fold == k] = [other.expected(*rows[i]) for i in np.flatnonzero(fold == k)]
    return Ordinal(model.weights, model.thresholds, balanced_cut(held, toxic))


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [features(x.as_py()) for x in b["text"]]
        yield pa.RecordBatch.from_arrays([b["doc_id"], b["toxic"], pa.array([i.astype(np.int32).tobytes() for i, _ in got], pa.binary()), pa.array([v.astype(np.float32).tobytes() for _, v in got], pa.binary())], names=["doc_id", "toxic", "ids", "vals"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Ordinal:
    """A model from at most ``max_rows`` rows of ``labels`` (doc_id, toxic)."""
    small_batches(docs.sparkSession)
    some = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # at most max_rows rows of two numbers: small for any input
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("doc_id", "toxic", "text").mapInArrow(_featurize, "doc_id bigint, toxic bigint, ids binary, vals binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["ids"])))
    return fit_with_cut([(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["vals"], np.float32)) for r in rows], np.array([float(r["toxic"] > 0) for r in rows]))


def score(docs: DataFrame, model: Ordinal, cut: float | None = None, keep_toxic: bool = True) -> DataFrame:
    """The rows of ``docs`` with tox__severity and tox__flag (by the model's cut); without those flagged where ``keep_toxic`` is off."""
    cut = model.cut if cut is None else cut
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM floats, whatever the input
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            s = np.array([m.expected(*features(x.as_py())) for x in b["tox__text"]], float)
            b = pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(names))), pa.array(s), pa.array(s >= cut)], names=[*names, "tox__severity", "tox__flag"])
            yield b if keep_toxic else b.filter(pa.array(s < cut))

    schema = docs.select(*docs.columns, F.lit(0.0).alias("tox__severity"), F.lit(False).alias("tox__flag")).schema
    return docs.select(*docs.columns, F.col("text").alias("tox__text")).mapInArrow(run, schema)


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """doc_id, expected_severity (0 to 3) and toxic of all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, model)
    return scored.select("doc_id", F.round("tox__severity", 6).alias("expected_severity"), F.col("tox__flag").alias("toxic"))
