"""Toxicity: a factorization machine over hashed terms.

A term's weight adds up as in a linear model; its factors add the pairwise interactions, such as an insult
together with whom it names, that linear weights miss. Terms are words, their first letters, and how many
different words share those letters, hashed.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from .common import checkpointed, map_batches, slices
from .labelled import MAX_TRAINING_ROWS, crc_of_key, sample

BUCKETS = 1 << 18
#: Width of the model: terms kept of the training sample, by the chi-square of their presence and the label. Of the
#: bars below, about two hundred terms pass at sf0.1, so the width decides nothing there. A bar keeps out terms that
#: agree with the label by chance; among stems that several words share there are few enough for a lower one.
MAX_TERMS = 8192
MIN_CHI2 = 25.0
MIN_CHI2_SHARED = 12.0
FACTORS = 8
START = 0.3
PREFIXES = (4, 5)
#: A stem counts anew at each of these numbers of different words that share it; such terms have the upper buckets.
SHARED = (2, 3, 4)
HALF = BUCKETS // 2
MODULUS, HELD = 4, 2
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")


def terms(text: str) -> np.ndarray:
    """Distinct hashed terms of a whole text: lower-cased words, their first 4 and 5 letters, and stems of 2 to 4 words."""
    found = set(_WORD.findall(text.lower()))
    stems = Counter(w[:n] for n in PREFIXES for w in found if len(w) > n)
    own = {xxh32_intdigest(w) % HALF for w in found} | {xxh32_intdigest(f"{s}*") % HALF for s in stems}
    own |= {HALF + xxh32_intdigest(f"{s}*{k}") % HALF for s, n in stems.items() for k in SHARED if k <= n}
    return np.array(sorted(own), np.int32)


@dataclass
class FactorizationMachine:
    """place: bucket to row (-1: not kept); bias, weights (n), factors (n, FACTORS)."""

    place: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def rows(self, buckets: np.ndarray) -> np.ndarray:
        rows = self.place[buckets]
        return rows[rows >= 0]

    def score(self, buckets: np.ndarray) -> float:
        rows = self.rows(buckets)
        v = self.factors[rows]
        both = 0.5 * ((v.sum(0) ** 2).sum() - (v**2).sum()) if len(rows) else 0.0
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[rows].sum() + both, -30, 30))))


def telling(one: np.ndarray, zero: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Buckets of the terms to keep, best first, by how many texts of label 1 and of label 0 hold each."""
    n, held = n1 + n0, one + zero
    chi2 = n * (one * n0 - zero * n1) ** 2 / np.maximum(held * (n - held) * n1 * n0, 1)
    bar = np.where(np.arange(len(one)) < HALF, MIN_CHI2, MIN_CHI2_SHARED)
    kept = np.flatnonzero((held >= 2) & (chi2 >= bar))
    return kept[np.argsort(-chi2[kept], kind="stable")[:MAX_TERMS]]


def fit(docs: list[np.ndarray], labels: np.ndarray, epochs: int = 40, rate: float = 0.3, decay: float = 1e-4, seed: int = 7) -> FactorizationMachine:
    """Adagrad on the log loss. Without both labels the score is the share of 1 (0 without any label)."""
    place = np.full(BUCKETS, -1, np.int32)
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return FactorizationMachine(place, 30.0 if share else -30.0, np.zeros(0, np.float32), np.zeros((0, FACTORS), np.float32))
    one = np.bincount(np.concatenate([d for d, y in zip(docs, labels, strict=True) if y] or [np.zeros(0, np.int32)]), minlength=BUCKETS).astype(float)
    zero = np.bincount(np.concatenate([d for d, y in zip(docs, labels, strict=True) if not y] or [np.zeros(0, np.int32)]), minlength=BUCKETS).astype(float)
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    kept = telling(one, zero, n1, n0)
    place[kept] = np.arange(len(kept))
    random = np.random.default_rng(seed)
    # Weights start from damped log odds: a term that texts of label 1 share out among many still counts alone.
    w = START * np.log((one[kept] + 0.5) / (n1 + 1) * (n0 + 1) / (zero[kept] + 0.5))
    v, b = random.normal(0, 0.02, (len(kept), FACTORS)), float(np.log(share / (1 - share)))
    gw, gv, gb = np.full(len(kept), 1e-2), np.full(v.shape, 1e-2), 1e-2
    rows = [place[d][place[d] >= 0] for d in docs]
    for _ in range(epochs):
        order = random.permutation(len(docs))
        for at in range(0, len(order), 1024):
            batch = order[at : at + 1024]
            own = [rows[i] for i in batch]
            sizes = np.array([len(r) for r in own])
            flat, doc = np.concatenate(own), np.repeat(np.arange(len(batch)), sizes)
            sums = np.stack([np.bincount(doc, v[flat, f], len(batch)) for f in range(FACTORS)], 1)
            squares = np.bincount(doc, (v[flat] ** 2).sum(1), len(batch))
            raw = b + np.bincount(doc, w[flat], len(batch)) + 0.5 * ((sums**2).sum(1) - squares)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch]) / len(batch)
            e = error[doc]
            dw = np.bincount(flat, e, len(kept)) + decay * w
            dv = np.stack([np.bincount(flat, e * (sums[doc, f] - v[flat, f]), len(kept)) for f in range(FACTORS)], 1) + decay * v
            gw, gv, gb = gw + dw**2, gv + dv**2, gb + error.sum() ** 2
            w -= rate * dw / np.sqrt(gw)
            v -= rate * dv / np.sqrt(gv)
            b -= rate * error.sum() / np.sqrt(gb)
    return FactorizationMachine(place, b, w.astype(np.float32), v.astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING_ROWS) -> FactorizationMachine:
    """Fits on the bounded sample. Terms are hashed and counted where the texts are.

    The driver gets one count for each bucket (BUCKETS at most), chooses the terms to keep, and then gets of each
    sampled row those terms only: at most ``limit`` rows of MAX_TERMS numbers, however long the texts are.
    """

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [terms(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "label": batch.column("label"), "terms": pa.array(found, pa.list_(pa.int32()))})

    chosen = checkpointed(map_batches(sample(docs, labels, "toxic", MODULUS, HELD, limit), hashed, "doc_id long, label int, terms array<int>"))
    by_label = dict(chosen.groupBy("label").count().collect())
    n1, n0 = by_label.get(1, 0), by_label.get(0, 0)
    counts = chosen.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("label").alias("one"), F.count(F.lit(1)).alias("all")).toArrow()
    one, both = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = counts.column("term").to_numpy()
    one[at], both[at] = counts.column("one").to_numpy(), counts.column("all").to_numpy()
    kept = np.sort(telling(one, both - one, n1, n0)).astype(np.int32)
    shared = docs.sparkSession.sparkContext.broadcast(kept)

    def packed(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [np.intersect1d(np.array(t, np.int32), shared.value, assume_unique=True).tobytes() for t in batch.column("terms").to_pylist()]
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "label": batch.column("label"), "terms": pa.array(own, pa.binary())})

    rows = map_batches(chosen, packed, "doc_id long, label int, terms binary").collect()
    rows.sort(key=lambda r: (r.doc_id, r.label, bytes(r.terms)))
    return fit([np.frombuffer(bytes(r.terms), np.int32) for r in rows], np.array([r.label for r in rows], float))


def score(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole document.

    Null and empty texts have no terms: the bias alone. Repeated rows keep their rows; a null doc_id is never
    trained on. Other columns are not read. Scoring is a map; the model, at most MAX_TERMS rows, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, limit))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        scores = np.array([model.score(terms(t or "")) for t in batch.column(2).to_pylist()], float)
        return pa.RecordBatch.from_pydict(
            {"doc_id": batch.column(0), "held_out": batch.column(1), "score": scores, "predicted": pa.array((scores >= threshold).astype(np.int32))}
        )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_of_key() % MODULUS == HELD).alias("held_out"), F.col("text").cast("string").alias("text"))
    return map_batches(source, run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows whose score reaches the threshold; columns and other rows stay as they are.

    Null and empty texts have the bias alone, the share of label 1, and so stay unless that reaches the threshold.
    Every row is judged by itself, repeats and rows without a doc_id too; very long texts are read whole. Without
    labels, or without one of the two, the score is that share for all: no label keeps all. No rows: none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, limit))

    def run(batches):
        for part in (p for batch in batches for p in slices(batch)):
            scores = [shared.value.score(terms(t or "")) for t in part.column("text").to_pylist()]
            yield part.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
