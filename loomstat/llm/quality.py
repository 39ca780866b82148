"""Quality classifier: document statistics, random Fourier features, ridge regression, isotonic calibration.

Some thirty statistics of the whole text are standardised and mapped to cosines whose inner products approximate a
Gaussian kernel. Each task sums its part of the normal equations; only their sums, of a fixed size, reach the driver,
which solves for the ridge weights. Labelled rows left out of the sums then calibrate the scores: counts per score bin,
pooled until they rise, give the probability that goes with a score.

Defined cases: a null text counts as empty, and empty texts get the score that their statistics (all zero) lead to.
Without labels of both kinds the score is the share of label 1, 0.5 without any label.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from loomstat.llm.common import durable, slices, utf8
from loomstat.llm.labelled import labelled_sample

FOURIER = 256
RIDGE = 1.0
BINS = 2000
# Raw scores outside of this range share the outermost bins.
LOW, HIGH = -0.5, 1.5
# A raw score breaks ties of the calibrated one by this much at most.
TIE = 0.01
SEGMENTS = 6
SIGNS = np.zeros(256, bool)
SIGNS[list(b"#*$%&|<>~^_=+@{}[]\\/")] = True
STOPS = np.zeros(256, bool)
STOPS[list(b".!?;:")] = True
UPPER, LOWER, DIGIT, BLANK = (np.zeros(256, bool) for _ in range(4))
UPPER[65:91], LOWER[97:123], DIGIT[48:58] = True, True, True
BLANK[[9, 10, 11, 12, 13, 32]] = True
WIDE = np.arange(256) >= 128
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def statistics(text: bytes | None) -> list[float]:
    """Figures about the whole text that tell prose from junk."""
    text = text or b""
    raw = np.frombuffer(text, np.uint8)
    counts = np.bincount(raw, minlength=256)
    size = max(1, len(raw))
    words = text.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lines = text.split(b"\n")
    distinct = set(words)
    same = sum(map(bytes.__eq__, words, words[1:]))
    pairs = set(zip(words, words[1:]))
    ends = [line.rstrip()[-1:] for line in lines]
    full = [line for line in lines if line.strip()]
    shares = [
        counts[group].sum() / size for group in (SIGNS, STOPS, UPPER, LOWER, DIGIT, BLANK, WIDE, PUNCTUATION)
    ]
    # The worst stretch: junk may fill only part of a document.
    worst = [0.0, 0.0, 0.0, 0.0]
    step = max(1, -(-len(words) // SEGMENTS))
    for start in range(0, len(words), step):
        part = words[start:start + step]
        joined = np.frombuffer(b"".join(part), np.uint8)
        seen = np.bincount(joined, minlength=256)
        total = max(1, len(joined))
        for i, value in enumerate((
            seen[SIGNS].sum() / total, seen[UPPER].sum() / total, 1 - len(set(part)) / len(part),
            seen[ord("!")] / len(part),
        )):
            worst[i] = max(worst[i], value)
    return [
        np.log1p(len(raw)), np.log1p(len(words)), np.log1p(len(lines)), *shares, counts[33] / n, counts[124] / n,
        counts[44] / n, counts[46] / n, float(lengths.mean()) if len(words) else 0.0,
        float(lengths.std()) if len(words) else 0.0, float(lengths.max(initial=0)) / 100, float((lengths <= 3).mean()) if len(words) else 0.0,
        len(distinct) / n, same / n, 1 - len(pairs) / max(1, len(words) - 1) if len(words) > 1 else 0.0,
        1 - len(set(full)) / max(1, len(full)), len(full) / max(1, len(lines)),
        sum(e in (b".", b"!", b"?", b'"') for e in ends) / len(lines), np.log1p(n / len(lines)), *worst,
    ]


WIDTH = len(statistics(b""))


def matrix(texts: pa.Array) -> np.ndarray:
    return np.array([statistics(t) for t in utf8(texts)], np.float64).reshape(-1, WIDTH)


@dataclass
class QualityModel:
    """What :func:`fit` has learnt; of fixed size, so it goes to the tasks with the function that uses it."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray = field(default_factory=lambda: np.array([0.0]))
    values: np.ndarray = field(default_factory=lambda: np.array([0.5]))
    seed: int = 17

    def features(self, stats: np.ndarray) -> np.ndarray:
        """A constant, the standardised statistics and the Fourier features."""
        rng = np.random.default_rng(self.seed)
        slopes = rng.normal(size=(WIDTH, FOURIER)) / np.sqrt(WIDTH)
        shifts = rng.uniform(0, 2 * np.pi, FOURIER)
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        return np.hstack([np.ones((len(z), 1)), z, np.sqrt(2 / FOURIER) * np.cos(z @ slopes + shifts)])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = self.raw(stats)
        rank = np.clip((raw - LOW) / (HIGH - LOW), 0, 1)
        return (1 - TIE) * np.interp(raw, self.knots, self.values) + TIE * rank

    def column(self, text: Column | str) -> Column:
        """The score of a text column."""

        @F.arrow_udf(DoubleType())
        def run(texts: pa.Array) -> pa.Array:
            parts = [self.score(matrix(b.column(0))) for b in slices([pa.RecordBatch.from_arrays([texts], ["t"])])]
            return pa.array(np.concatenate(parts) if parts else np.zeros(0))

        return run(text)


def _vectors(rows: DataFrame, function, width: int) -> np.ndarray:
    """The sum over all rows of what ``function(stats, labels)`` gives per task: ``(n, width)``, as ``(i, row)``."""

    def run(batches):
        total = None
        for batch in batches:
            stats = np.array(batch.column("stats").to_pylist(), np.float64).reshape(-1, WIDTH)
            part = function(stats, batch.column("label").to_numpy(zero_copy_only=False).astype(np.float64))
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"]
            )

    def add(table: pa.Table) -> pa.Table:
        summed = np.array(table.column("row").to_pylist()).sum(axis=0)
        return pa.table({"i": table.column("i").slice(0, 1), "row": pa.array([summed.tolist()], pa.list_(pa.float64()))})

    schema = "i int, row array<double>"
    summed = rows.mapInArrow(run, schema).groupBy("i").applyInArrow(add, schema).orderBy("i").collect()
    return np.array([r.row for r in summed]).reshape(-1, width)


def pooled(counts: np.ndarray, positives: np.ndarray) -> np.ndarray:
    """Isotonic fit of shares in order: neighbours that fall are pooled."""
    blocks: list[list[float]] = []
    for n, p in zip(counts.tolist(), positives.tolist()):
        blocks.append([n, p, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n, p, k = blocks.pop()
            blocks[-1][0] += n
            blocks[-1][1] += p
            blocks[-1][2] += k
    return np.concatenate([np.full(int(k), p / n) for n, p, k in blocks]) if blocks else np.zeros(0)


def fit(labelled: DataFrame, *, calibrate_fold: int = 4) -> QualityModel:
    """A model of ``label`` from ``text, label, fold``; rows of ``calibrate_fold`` only calibrate."""
    def stats(batches):
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(matrix(batch.column("text")).tolist(), pa.list_(pa.float64())), batch.column("label"), batch.column("fold")],
                ["stats", "label", "fold"],
            )

    known = durable(labelled.mapInArrow(stats, "stats array<double>, label int, fold int"), "quality-statistics")
    model = QualityModel(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(1 + WIDTH + FOURIER))
    own = known.filter(F.col("fold") != calibrate_fold)

    def moments(x, y):
        return np.vstack([x.sum(axis=0), (x**2).sum(axis=0), np.full(WIDTH, len(x)), np.full(WIDTH, y.sum())])

    sums = _vectors(known, moments, WIDTH)
    if not len(sums):
        return model
    total, positive = sums[2, 0], sums[3, 0]
    model.values = np.array([positive / total])
    if positive in (0, total):
        return model
    model.mean = sums[0] / total
    model.scale = np.maximum(np.sqrt(np.maximum(sums[1] / total - model.mean**2, 0)), 1e-6)

    def normal(x, y):
        f = model.features(x)
        return np.hstack([f.T @ f, (f.T @ y)[:, None]])

    width = 1 + WIDTH + FOURIER
    equations = _vectors(own, normal, width + 1)
    if not len(equations):
        equations, own = _vectors(known, normal, width + 1), known
    model.weights = np.linalg.solve(equations[:, :-1] + RIDGE * np.eye(width), equations[:, -1])

    def histogram(x, y):
        at = np.clip((model.raw(x) - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int64)
        return np.vstack([np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)])

    counts = _vectors(known.filter(F.col("fold") == calibrate_fold), histogram, BINS)
    if not len(counts):
        counts = _vectors(known, histogram, BINS)
    filled = np.flatnonzero(counts[0])
    model.knots = LOW + (filled + 0.5) * (HIGH - LOW) / BINS
    model.values = pooled(counts[0][filled], counts[1][filled])
    return model


def fit_documents(docs: DataFrame, labels: DataFrame, label: str = "quality", **options) -> QualityModel:
    """A model from a bounded sample of the labelled documents that are not held out."""
    return fit(labelled_sample(docs, labels, label, **options))


def keep_good(docs: DataFrame, model: QualityModel, *, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` without those that score below ``threshold``."""
    scored = docs.select(F.struct("*").alias("row"), model.column(text_col).alias("score"))
    return scored.filter(F.col("score") >= threshold).select("row.*")
