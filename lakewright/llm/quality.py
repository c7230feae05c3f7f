"""Quality: a linear-chain conditional random field labels every line good or bad.

A line's features are its own, its neighbours' and its place; transitions tie it to the next line's label.
Forward-backward gives each line's probability of being good; weighted by length, they make the document's.
Only documents are labelled, so lines start from their document's label, and lines of bad documents are
labelled anew by the first model before the second fit: bad documents also hold good lines.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, checkpointed, map_batches, slices
from .labelled import crc_of_key, sample

MODULUS, HELD = 3, 1
#: Labelled documents that the field is fitted on, at most: a documented bound.
MAX_TRAINING_ROWS = 3_000
THRESHOLD = 0.5
SLOPE = 12.0
#: Partitions that the sampled documents' features lie in: fixed, so that sums come out the same on every cluster.
FIT_PARTITIONS = 8
#: Steps of a fit, at most, and the curvature pairs that its quasi-Newton steps remember.
STEPS = 25
MEMORY = 8
#: Bytes of text whose features are counted at once.
STRIP_BYTES = 8 << 20

# Classes of bytes: 0 other, 1 lower, 2 upper, 3 digit, 4 blank, 5 ending mark, 6 comma-like, 7 pipe or table,
# 8 odd mark, 9 first byte of a character beyond ASCII, 10 its other bytes, 11 exclamation or question mark.
_CLASS = np.zeros(256, np.uint8)
for _c, _set in {1: range(97, 123), 2: range(65, 91), 3: range(48, 58), 4: b" \t\r\v\f", 5: b".", 6: b",;:'\"()-", 7: b"|\\/_=<>{}[]~^`", 8: b"#$%&*+@", 9: range(0xC0, 256), 10: range(0x80, 0xC0), 11: b"!?"}.items():
    _CLASS[list(_set)] = _c
_N_OWN = 20
N_FEATURES = 3 * _N_OWN + 3


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line, lines of each text, bytes of every line). Blank lines are none; empty texts have no lines."""
    lines: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    repeated: list[float] = []
    for i, text in enumerate(texts):
        own = [s for s in text.split(b"\n") if s.strip()]
        counts[i] = len(own)
        seen: set[bytes] = set()
        for s in own:
            repeated.append(s in seen)
            seen.add(s)
        lines += own
    if not lines:
        return np.zeros((0, N_FEATURES), np.float32), counts, np.zeros(0)
    size = np.array([len(s) for s in lines], np.float64)
    held = _class_counts(lines)
    chars = np.maximum(size - held[:, 10], 1)
    letters = held[:, 1] + held[:, 2] + held[:, 9]
    words, unique, pairs, run, longest, short = _word_shape(lines)
    own = np.stack(
        [
            np.log1p(chars) / 5, np.log1p(words) / 4, letters / chars, held[:, 2] / np.maximum(letters, 1), held[:, 3] / chars,
            held[:, 5] / words, held[:, 6] / words, np.minimum(held[:, 7] / words, 2), np.minimum(held[:, 8] / words, 3), np.minimum(held[:, 11] / words, 3),
            unique / words, pairs, run, np.minimum(chars / words, 30) / 10, np.minimum(longest, 60) / 20, short / words,
            np.array(repeated, float), (words < 3).astype(float), (held[:, 8] + held[:, 7] + held[:, 11] > 0.3 * words).astype(float), np.ones(len(lines)),
        ],
        1,
    )
    first, last = np.zeros(len(lines), bool), np.zeros(len(lines), bool)
    ends = np.cumsum(counts)
    there = counts > 0
    first[(ends - counts)[there]] = True
    last[ends[there] - 1] = True
    before, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
    before[first], after[last] = 0, 0
    only = np.repeat(counts == 1, counts)
    place = np.stack([first, last, only], 1).astype(float)
    return np.concatenate([own, before, after, place], 1).astype(np.float32), counts, size


def _class_counts(lines: list[bytes]) -> np.ndarray:
    """Bytes of each class in each line; long inputs in strips."""
    out = np.zeros((len(lines), 12))
    at = 0
    while at < len(lines):
        stop, held = at, 0
        while stop < len(lines) and (stop == at or held + len(lines[stop]) <= STRIP_BYTES):
            held += len(lines[stop])
            stop += 1
        flat = _CLASS[np.frombuffer(b"".join(lines[at:stop]), np.uint8)]
        line = np.repeat(np.arange(stop - at, dtype=np.int32) * 12, [len(s) for s in lines[at:stop]])
        out[at:stop] = np.bincount(line + flat, minlength=12 * (stop - at)).reshape(-1, 12)
        at = stop
    return out


def _word_shape(lines: list[bytes]):
    n = len(lines)
    words, unique, pairs, run, longest, short = (np.zeros(n) for _ in range(6))
    for i, s in enumerate(lines):
        w = s.split()
        words[i] = k = len(w)
        unique[i] = len(set(w))
        if k > 1:
            again = sum(map(bytes.__eq__, w, w[1:]))
            run[i] = again / (k - 1)
            pairs[i] = len(set(zip(w, w[1:]))) / (k - 1)
        else:
            pairs[i] = 1
        lengths = list(map(len, w))
        longest[i] = max(lengths)
        short[i] = sum(x < 2 for x in lengths)
    return words, unique, pairs, run, longest, short


@dataclass
class Crf:
    """Two labels, 0 bad and 1 good: emission (features, 2), transition (2, 2); slope and shift map a document's
    length-weighted marginal to its score."""

    mean: np.ndarray
    scale: np.ndarray
    emission: np.ndarray
    transition: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    empty: float = 0.5

    def marginals(self, features: np.ndarray, counts: np.ndarray):
        """P(bad) and P(good) of each line; see chain() for the rest."""
        potentials = ((features - self.mean) / self.scale) @ self.emission
        return chain(potentials, counts, self.transition)

    def documents(self, features: np.ndarray, counts: np.ndarray, size: np.ndarray) -> np.ndarray:
        good = self.marginals(features, counts)[0][:, 1]
        owner = np.repeat(np.arange(len(counts)), counts)
        weight = np.maximum(np.bincount(owner, size, len(counts)), 1e-9)
        return np.bincount(owner, size * good, len(counts)) / weight

    def score(self, texts: list[bytes]) -> np.ndarray:
        features, counts, size = line_features(texts)
        share = self.documents(features, counts, size)
        out = 1 / (1 + np.exp(-np.clip(self.slope * (share - self.shift), -30, 30)))
        return np.where(counts > 0, out, self.empty)


def chain(potentials: np.ndarray, counts: np.ndarray, transition: np.ndarray):
    """Forward-backward over all chains together, one step of every chain at a time, longest first.

    Marginals of every line, pair marginals of every line but the chains' first, those lines' places, log partition.
    """
    n = len(counts)
    order = np.argsort(-counts, kind="stable")
    sizes, starts = counts[order], (np.cumsum(counts) - counts)[order]
    steps = int(sizes[0]) if n else 0
    alive = np.searchsorted(-sizes, -np.arange(1, steps + 1), side="right")  # chains with more than t lines
    alpha, beta = np.zeros_like(potentials, np.float64), np.zeros_like(potentials, np.float64)
    for t in range(steps):
        k = alive[t]
        here = starts[:k] + t
        if t == 0:
            alpha[here] = potentials[here]
        else:
            alpha[here] = potentials[here] + _logsum(alpha[here - 1][:, :, None] + transition[None])
    for t in range(steps - 2, -1, -1):
        k = alive[t + 1]
        here = starts[:k] + t
        beta[here] = _logsum((transition[None] + (potentials[here + 1] + beta[here + 1])[:, None, :]).transpose(0, 2, 1))
    both = alpha + beta
    logz = np.logaddexp(both[:, 0], both[:, 1])
    marginal = np.exp(both - logz[:, None])
    first = np.zeros(len(potentials), bool)
    first[starts[sizes > 0]] = True
    inner = np.flatnonzero(~first)
    pair = np.exp(alpha[inner - 1][:, :, None] + transition[None] + (potentials[inner] + beta[inner])[:, None, :] - logz[inner][:, None, None])
    return marginal, pair, inner, logz


def _logsum(x: np.ndarray) -> np.ndarray:
    """log of the sum over axis 1."""
    return np.logaddexp(x[:, 0], x[:, 1])


def _lines(column: pa.Array) -> list[np.ndarray]:
    """Features and size of the lines of each packed document."""
    return [np.frombuffer(v, np.float32).reshape(-1, N_FEATURES + 1) for v in column.to_pylist()]


def _chained(batch: pa.RecordBatch):
    """Features, counts, sizes and labels of documents that go through the chain together."""
    held = _lines(batch.column("lines"))
    flat = np.concatenate(held)
    return flat[:, :-1].astype(float), np.array([len(h) for h in held], np.int64), flat[:, -1].astype(float), batch.column("label").to_numpy()


class _Sample:
    """The sampled documents' features, kept as files; sums over their lines are taken where they lie.

    Every pass reads all lines of all sampled documents, and brings back some hundred numbers a partition.
    """

    def __init__(self, rows: DataFrame):
        self.rows = checkpointed(rows.repartition(FIT_PARTITIONS, "doc_id").sortWithinPartitions("doc_id"))

    def sums(self, part, width: int) -> np.ndarray:
        """part(batch) of every slice, added up."""

        def run(batches):
            total = np.zeros(width)
            for batch in batches:
                for own in slices(batch):
                    total += part(own)
            yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

        held = self.rows.mapInArrow(run, "sums binary").collect()
        return np.sum([np.frombuffer(bytes(r.sums), float) for r in held], axis=0) if held else np.zeros(width)

    def mapped(self, fn, schema: str) -> DataFrame:
        return map_batches(self.rows, fn, schema)


def fit(rows: DataFrame, steps: int = STEPS, decay: float = 1e-3) -> Crf:
    """Fits rows(doc_id, label, lines), then the map from documents' marginals to labels.

    A document weighs the same however many lines it has, in the emissions and in the transitions, and both labels
    weigh alike. Without both labels the score is constant. The first fit takes every line for its document's label;
    the second takes those lines of bad documents that the first calls good for good.
    """
    sample = _Sample(rows)
    width = N_FEATURES
    counted = sample.sums(_count_documents, 4)
    all_of, with_lines = counted[:2], counted[2:]
    n = all_of.sum()
    share = float(all_of[1] / n) if n else 0.5
    model = Crf(np.zeros(width), np.ones(width), np.zeros((width, 2)), np.zeros((2, 2)), 0.0, 0.0, share)
    if not with_lines.all():
        model.slope, model.shift = (0.0, 0.0) if not n else (60.0, -1.0 if share >= 0.5 else 2.0)
        return model
    of_label = 0.5 / with_lines

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x, counts, _, labels = _chained(batch)
        w = _line_weights(counts, labels, of_label)[:, None]
        return np.concatenate([(w * x).sum(0), (w * x**2).sum(0)])

    first = sample.sums(moments, 2 * width)
    model.mean = first[:width]
    model.scale = np.sqrt(np.maximum(first[width:] - model.mean**2, 0)) + 1e-3
    for again in (False, True):
        if again:
            sample = _Sample(sample.mapped(_relabelled(model), "doc_id long, label int, lines binary, own binary"))
        _ascend(model, sample, of_label, again, steps, decay)

    def means(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, counts, size, labels = _chained(batch)
        there = counts > 0
        return pa.RecordBatch.from_pydict({"mean": model.documents(x, counts, size)[there], "label": labels[there]})

    held = sample.mapped(means, "mean double, label int").collect()  # two numbers for each sampled document
    mean, y = np.array([r["mean"] for r in held]), np.array([r["label"] for r in held])
    # A logistic map: 0.5 falls where the fewest documents are wrong, both labels alike, in the widest gap there.
    order = np.lexsort((y, mean))
    mean, y = np.append(mean[order], 1.0 + 1e-6), y[order]
    wrong = np.cumsum(y == 1) / (y == 1).sum() + 1 - np.cumsum(y == 0) / (y == 0).sum()
    gap = np.diff(mean)
    at = max(range(len(gap)), key=lambda i: (-round(float(wrong[i]), 9), gap[i]))
    model.slope, model.shift = SLOPE, float(mean[at] + gap[at] / 2)
    return model


def _count_documents(batch: pa.RecordBatch) -> np.ndarray:
    """Documents of label 0 and 1, and of those, the ones with lines."""
    label, filled = batch.column("label").to_numpy(), np.array([len(v) > 0 for v in batch.column("lines").to_pylist()])
    return np.concatenate([np.bincount(label, minlength=2), np.bincount(label[filled], minlength=2)]).astype(float)


def _line_weights(counts: np.ndarray, labels: np.ndarray, of_label: np.ndarray) -> np.ndarray:
    return np.repeat(of_label[labels] / np.maximum(counts, 1), counts)


def _relabelled(model: Crf):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, counts, _, labels = _chained(batch)
        good = model.marginals(x, counts)[0][:, 1] > 0.9
        own = np.where(np.repeat(labels, counts) == 1, 1, good).astype(np.int8)
        packed = [o.tobytes() for o in np.split(own, np.cumsum(counts)[:-1])]
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "label": batch.column("label"), "lines": batch.column("lines"), "own": pa.array(packed, pa.binary())})

    return run


def objective(x, counts, own, weight, emission, transition) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted log likelihood of the lines' labels, and its gradients by the emission and transition weights.

    weight is a line's, the same for all lines of a document: it weighs the document's whole chain.
    """
    if not len(x):
        return 0.0, np.zeros_like(emission), np.zeros((2, 2))
    potentials = x @ emission
    marginal, pair, inner, logz = chain(potentials, counts, transition)
    ends = np.cumsum(counts)
    truth = np.eye(2)[own]
    scored = potentials[np.arange(len(x)), own] * weight
    seen, between = np.zeros((2, 2)), transition[own[inner - 1], own[inner]]
    np.add.at(seen, (own[inner - 1], own[inner]), weight[inner])
    value = scored.sum() + (between * weight[inner]).sum() - (logz[ends[counts > 0] - 1] * weight[ends[counts > 0] - 1]).sum()
    return float(value), x.T @ ((truth - marginal) * weight[:, None]), seen - (pair * weight[inner][:, None, None]).sum(0)


def _ascend(model: Crf, sample: _Sample, of_label: np.ndarray, relabelled: bool, steps: int, decay: float) -> None:
    """Quasi-Newton steps (limited memory) on the weighted log likelihood, halved until they gain."""
    width = len(model.mean)

    def at(theta: np.ndarray) -> tuple[float, np.ndarray]:
        emission, transition, mean, scale = theta[:-4].reshape(width, 2), theta[-4:].reshape(2, 2), model.mean, model.scale

        def part(batch: pa.RecordBatch) -> np.ndarray:
            x, counts, _, labels = _chained(batch)
            own = np.frombuffer(b"".join(batch.column("own").to_pylist()), np.int8).astype(int) if relabelled else np.repeat(labels, counts)
            value, e, t = objective((x - mean) / scale, counts, own, _line_weights(counts, labels, of_label), emission, transition)
            return np.concatenate([[value], e.ravel(), t.ravel()])

        out = sample.sums(part, 1 + len(theta))
        return -out[0] + decay / 2 * float(theta @ theta), -out[1:] + decay * theta

    theta = np.concatenate([model.emission.ravel(), model.transition.ravel()])
    value, slope = at(theta)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        step = -_curved(slope, pairs)
        size = 1.0 if pairs else 1 / max(1.0, float(np.linalg.norm(slope)))
        while True:
            now, turned = at(theta + size * step)
            if now <= value + 1e-4 * size * float(slope @ step) or size < 1e-4:
                break
            size /= 2
        if now >= value:
            break
        s, y = size * step, turned - slope
        if float(s @ y) > 1e-12:
            pairs = [*pairs[-MEMORY + 1 :], (s, y)]
        gained = value - now
        theta, value, slope = theta + s, now, turned
        if gained < 5e-3 * abs(value):
            break
    model.emission, model.transition = theta[:-4].reshape(width, 2), theta[-4:].reshape(2, 2)


def _curved(slope: np.ndarray, pairs) -> np.ndarray:
    """The inverse curvature that the remembered pairs tell, times the slope (two loops)."""
    out, kept = slope.copy(), []
    for s, y in reversed(pairs):
        a = float(s @ out) / float(s @ y)
        kept.append(a)
        out -= a * y
    if pairs:
        s, y = pairs[-1]
        out *= float(s @ y) / float(y @ y)
    for (s, y), a in zip(pairs, reversed(kept), strict=True):
        out += (a - float(y @ out) / float(s @ y)) * s
    return out


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING_ROWS) -> Crf:
    """Fits on every line of the bounded sample; neither texts nor features leave the executors."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed: list[bytes] = []
        for text in as_bytes(batch.column("text")):
            features, _, size = line_features([text or b""])
            packed.append(np.concatenate([features, size[:, None]], 1).astype(np.float32).tobytes())
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "label": batch.column("label"), "lines": pa.array(packed, pa.binary())})

    return fit(map_batches(sample(docs, labels, "quality", MODULUS, HELD, limit), run, "doc_id long, label int, lines binary"))


def score(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole document.

    Null, empty and blank texts have no lines: their score is the share of label 1 in the sample (0.5 without
    labels). Repeated rows keep their rows; a null doc_id is never trained on. Other columns are not read.
    Scoring is a map over every line; the model is some hundred numbers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, limit))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = shared.value.score([t or b"" for t in as_bytes(batch.column(2))])
        return pa.RecordBatch.from_pydict(
            {"doc_id": batch.column(0), "held_out": batch.column(1), "score": scores, "predicted": pa.array((scores >= threshold).astype(np.int32))}
        )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_of_key() % MODULUS == HELD).alias("held_out"), F.col("text").cast("string").alias("text"))
    return map_batches(source, run, "doc_id long, held_out boolean, score double, predicted int")
