"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from docweir.llm.batches import bounded
from docweir.llm.labelled import is_held_out, training_documents
from docweir.storage import materialize

#: Labelled documents that the classifier is fitted on, at most about.
SAMPLE_BOUND = 20_000
N_FOURIER = 256
RIDGE = 1.0
THRESHOLD = 0.7
N_BINS = 256

_CLASSES = {
    "upper": range(0x41, 0x5B),
    "lower": range(0x61, 0x7B),
    "digit": range(0x30, 0x3A),
    "space": b" \t\r\v\f",
    "stop": b".,;:?'\"-()",
    "shout": b"!",
    "table": b"|<>[]{}_=/\\~^`",
    "symbol": b"#$%&*@+",
    "high": range(0x80, 0x100),
}
_CLASS_ROWS = np.array([[b in members for b in range(256)] for members in map(set, _CLASSES.values())], dtype=np.float64)
_ENDED = re.compile(r"[.!?…。]['\")\]]*\s*$", re.MULTILINE)


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a whole text, whatever its language; an empty text gives zeros."""
    text = text or ""
    data = text.encode()
    words = text.split()
    if not words:
        return [0.0] * N_STATISTICS
    n, m = len(data), len(words)
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=m)
    lines = [line for line in text.split("\n") if line.strip()]
    distinct_words = len(set(words))
    shapes = _CLASS_ROWS @ np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256) / n
    letters = sum(map(str.isalpha, words))
    return [
        np.log1p(n),
        np.log1p(m),
        lengths.mean(),
        np.log1p(lengths.max()),
        lengths.std(),
        *shapes.tolist(),
        letters / m,
        sum(map(str.isupper, words)) / m,
        sum(map(str.istitle, words)) / m,
        distinct_words / m,
        np.log1p(m) - np.log1p(distinct_words),
        len(set(zip(words, words[1:], words[2:], strict=False))) / max(m - 2, 1),
        len(set(lines)) / len(lines),
        np.log1p(m / len(lines)),
        len(_ENDED.findall(text)) / len(lines),
        (lengths <= 2).mean(),
        len(zlib.compress(data, 1)) / n,
        np.log1p(sum(map(text.count, ".!?")) / m),
    ]


N_STATISTICS = 5 + len(_CLASSES) + 12


@dataclass
class QualityModel:
    """What scoring needs; ``center`` is None where there was nothing to learn from."""

    prior: float
    center: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    steps: np.ndarray | None = None
    levels: np.ndarray | None = None

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return _fourier(stats, self.center, self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.center is None:
            return np.full(len(stats), self.prior)
        return np.interp(self.raw(stats), self.steps, self.levels)


def _fourier(stats: np.ndarray, center: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Features whose inner products approximate a Gaussian kernel on the standardized statistics, and a constant."""
    rng = np.random.default_rng(7)
    frequencies = rng.standard_normal((N_STATISTICS, N_FOURIER)) / np.sqrt(N_STATISTICS)
    shifts = rng.uniform(0, 2 * np.pi, N_FOURIER)
    x = np.clip((stats - center) / scale, -8, 8)
    return np.c_[np.sqrt(2 / N_FOURIER) * np.cos(x @ frequencies + shifts), np.ones(len(x))]


def _summed(train: DataFrame, sums, size: int) -> np.ndarray:
    """The sum over partitions of ``sums(stats, y)``, one array of ``size`` doubles from each partition."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            stats = batch.column("stats").flatten().to_numpy().reshape(-1, N_STATISTICS)
            total += sums(stats, batch.column("y").to_numpy().astype(np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    parts = train.select("stats", "y").coalesce(16).mapInArrow(run, "total binary").collect()
    return np.sum([np.frombuffer(p.total) for p in parts], axis=0) if parts else np.zeros(size)


def _isotonic(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The non-decreasing level of each bin that fits its mean best, by pooling neighbours that fall."""
    pools: list[list[float]] = []
    for s, c in zip(sums, counts, strict=True):
        pools.append([s, c, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s1, c1, k1 = pools.pop()
            pools[-1] = [pools[-1][0] + s1, pools[-1][1] + c1, pools[-1][2] + k1]
    return np.concatenate([np.full(int(k), s / c) for s, c, k in pools])


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = SAMPLE_BOUND) -> QualityModel:
    """Ridge weights from normal equations summed over partitions, then calibration on rows kept apart for it.

    Three quarters of the sample (at most about ``bound`` documents) give the weights, one
    quarter the calibration. With no labelled rows, or labels of one kind only, the model
    scores every text with the share of label 1 (0.5 if there are none).
    """

    def described(batches):
        for batch in bounded(batches):
            stats = np.array([statistics(t) for t in batch.column("text").to_pylist()], dtype=np.float64)
            offsets = np.arange(0, stats.size + 1, N_STATISTICS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), batch.column("part"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(stats.ravel()))],
                names=["y", "part", "stats"],
            )

    train = materialize(
        training_documents(docs, labels, label, bound).mapInArrow(described, "y int, part int, stats array<double>"), "quality-train"
    )
    moments = _summed(train, lambda x, y: np.r_[len(y), y.sum(), x.sum(axis=0), (x * x).sum(axis=0)], 2 + 2 * N_STATISTICS)
    n, positive = moments[:2]
    if positive in (0, n):
        return QualityModel(positive / n if n else 0.5)
    center, square = moments[2:].reshape(2, -1) / n
    scale = np.sqrt(np.maximum(square - center**2, 1e-12)) + 1e-6
    width = N_FOURIER + 1

    def normal_equations(x, y):
        z = _fourier(x, center, scale)
        return np.r_[(z.T @ z).ravel(), z.T @ y]

    fitted, kept = train.where("part > 0"), train.where("part = 0")
    sums = _summed(fitted, normal_equations, width * width + width)
    penalty = RIDGE * np.diag(np.r_[np.ones(N_FOURIER), 0])
    model = QualityModel(positive / n, center, scale)
    model.weights = np.linalg.solve(sums[: width * width].reshape(width, width) + penalty + 1e-9 * np.eye(width), sums[width * width :])
    # Raw scores lie near 0 to 1; what lies outside counts in the end bins.
    edges = np.linspace(-0.5, 1.5, N_BINS + 1)

    def histogram(x, y):
        at = np.clip(np.digitize(model.raw(x), edges) - 1, 0, N_BINS - 1)
        return np.r_[np.bincount(at, y, N_BINS), np.bincount(at, minlength=N_BINS)]

    hits, counts = _summed(kept, histogram, 2 * N_BINS).reshape(2, -1)
    # One pseudo-row at the overall share keeps every bin's level off 0 and 1.
    filled = counts > 0
    middles = (edges[:-1] + edges[1:]) / 2
    if not filled.any():
        model.steps, model.levels = middles, np.clip(middles, 0, 1)
    else:
        levels = _isotonic(hits[filled] + 0.05 * positive / n, counts[filled] + 0.05)
        model.steps, model.levels = middles[filled], np.clip(levels, 0, 1)
    return model


def quality_scores(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` with ``score`` (0 to 1) and ``predicted`` after its own columns, which must not have these names."""

    def run(batches):
        for batch in bounded(batches):
            stats = np.array([statistics(t) for t in batch.column("text").to_pylist()], dtype=np.float64).reshape(-1, N_STATISTICS)
            score = np.clip(model.score(stats), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"],
            )

    schema = StructType([*docs.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return docs.mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Only the text is an input of a score, and all of it, however long. Null and empty
    texts have the score of a text without words. Without labels every score is 0.5; an
    empty table gives an empty result. Each row stands alone: repeated rows, ties and null doc_ids give a row
    each (a null doc_id is not held out). Other columns are ignored.
    """
    model = fit_quality(docs, labels)
    return quality_scores(docs.select("doc_id", is_held_out().alias("held_out"), "text"), model).drop("text")
