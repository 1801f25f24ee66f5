"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Each whole text gives a vector of statistics (shares of letters, digits, capitals
and signs, word and line figures, repetition). Standardised, it goes through
``FEATURES`` random cosines, which approximate a Gaussian kernel. Each partition
sums its part of the normal equations; the parts are added up by a few
streaming tasks, so the driver gets one matrix of fixed size however
many rows there are. The ridge scores of a fold of their own are counted in
``_BINS`` bins and made monotone (pool adjacent violators): the result is the
share of good rows at that score.

Labels are learned from rows whose crc32(id as text) mod 4 is 0 or 1 (ridge)
and 3 (calibration); rows with 2 are held out. Label, language, source and id
are never inputs of a score.

Defined results: a null text counts as empty and is scored; a null id counts as
an empty string; of repeated labels of one id the mean counts; labels other
than 0 and 1 are left out; with no usable label in either fold nothing is known
against any text and all scores are 1. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import free_name, utf8, written

FEATURES = 256
RIDGE = 1e-4
WIDTH = 4.0
SEED = 20
THRESHOLD = 0.7
HELD_OUT = 2
_SLOTS = 16
_BINS = 512

_CLASS = np.zeros(256, dtype=np.int64)  # byte classes: 0 sign, 1 lower, 2 capital, 3 digit, 4 white, 5 stop, 6 other than ASCII
_CLASS[ord("a"):ord("z") + 1] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[ord(c) for c in ".,;:!?'\""]] = 5
_CLASS[128:] = 6
STATISTICS = 22


def statistics(text: bytes) -> list[float]:
    """The ``STATISTICS`` figures of one UTF-8 text."""
    n = len(text)
    words = text.split()
    if not words:
        return [0.0] * STATISTICS
    count = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    by_class = np.bincount(_CLASS, weights=count, minlength=7)
    share = count[count > 0] / n
    lines = [x for x in text.split(b"\n") if x.strip()]
    seen = Counter(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    common = seen.most_common(4)
    return [np.log1p(n), *(by_class / n).tolist(), float(-(share * np.log(share)).sum()),
            np.log1p(len(words)), float(lengths.mean()), float(lengths.std()), np.log1p(float(lengths.max())),
            float((lengths <= 3).mean()), len(seen) / len(words), len(seen) / np.sqrt(len(words)),
            common[0][1] / len(words), sum(c for _, c in common) / len(words),
            len(set(lines)) / len(lines), len(words) / len(lines), float(len(lines[0]) / n),
            sum(1 for w in words if not w[:1].isalpha() and w[0] < 128) / len(words)]


def fold(id_column: Column) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 4


def with_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, fold, x (the statistics) for each row."""
    slim = docs.select(docs[id_col].cast("long").alias("doc_id"), fold(docs[id_col]).cast("int").alias("fold"),
                       docs[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([statistics(t) for t in utf8(b.column("text"))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("fold"), x], names=["doc_id", "fold", "x"])

    return slim.mapInArrow(run, "doc_id long, fold int, x array<double>")


class Model:
    """Standardisation, cosines, ridge weights and the calibration's knots."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(0, 1 / WIDTH, (len(mean), FEATURES))
        self.b = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.knots: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.cos(z @ self.w + self.b) * np.sqrt(2 / FEATURES), np.ones((len(x), 1))])

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.features(x[i:i + 4096]) @ self.weights for i in range(0, len(x), 4096)] or [np.zeros(0)])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.knots is None:
            return np.ones(len(x))
        return np.clip(np.interp(self.ridge(x), *self.knots), 0, 1)


def isotonic(at: np.ndarray, value: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the knots (mean place, value) of the best rising fit."""
    blocks: list[list[float]] = []
    for a, v, w in zip(at, value, weight):
        blocks.append([a, v, w])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            (a1, v1, w1), (a2, v2, w2) = blocks[-2:]
            blocks[-2:] = [[(a1 * w1 + a2 * w2) / (w1 + w2), (v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2]]
    return np.array([x[0] for x in blocks]), np.array([x[1] for x in blocks])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, STATISTICS))


def _normal_equations(train: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    size = FEATURES + 1

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            total = np.zeros((size, size + 1)) if total is None and b.num_rows else total
            x, y = _matrix(b.column("x")), b.column("y").to_numpy()
            for i in range(0, len(x), 4096):
                z = model.features(x[i:i + 4096])
                total += z.T @ np.hstack([z, y[i:i + 4096, None]])
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % _SLOTS], pa.int32()),
                                              pa.array([total.tobytes()], pa.binary())], names=["slot", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for raw in b.column("sums"):
                one = np.frombuffer(raw.as_buffer(), dtype=np.float64)
                total = one.copy() if total is None else np.add(total, one, out=total)
        if total is not None:  # a partition without rows adds nothing
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    # summed by slot, then the slots' sums (at most _SLOTS rows) in one task: one row comes to the driver
    parts = train.mapInArrow(part, "slot int, sums binary").repartition(_SLOTS, "slot").mapInArrow(add, "sums binary")
    parts = parts.repartition(1).mapInArrow(add, "sums binary")
    total = sum((np.frombuffer(r["sums"]) for r in parts.collect()), np.zeros(size * (size + 1))).reshape(size, size + 1)
    return total[:, :-1], total[:, -1]


def fit(stats: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> Model:
    """The model of the statistics' labelled rows outside the held-out fold."""
    y = (labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("double").alias("y"))
         .where("y in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.avg("y").alias("y")))
    train, _ = written(stats.where(f"fold <> {HELD_OUT}").join(y, "doc_id"), "quality")
    learn, check = train.where("fold < 2"), train.where("fold = 3")
    at = [F.col("x")[i] for i in range(STATISTICS)]
    row = learn.agg(F.count("*"), *[F.avg(c) for c in at], *[F.stddev_pop(c) for c in at]).first()
    n = row[0]
    if not n or check.isEmpty():
        return Model(np.zeros(STATISTICS), np.ones(STATISTICS))
    mean, scale = np.array(row[1:1 + STATISTICS], dtype=float), np.array(row[1 + STATISTICS:], dtype=float)
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0))
    gram, moment = _normal_equations(learn, model)
    model.weights = np.linalg.solve(gram + RIDGE * n * np.eye(len(gram)), moment)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.clip((model.ridge(_matrix(b.column("x"))) + 0.5) / 2, 0, 1) * (_BINS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.rint(at).astype(np.int32)), b.column("y")], names=["bin", "y"])

    bins = (check.mapInArrow(binned, "bin int, y double").groupBy("bin")
            .agg(F.avg("y").alias("y"), F.count("*").alias("n")).orderBy("bin").collect())  # at most _BINS rows
    place = np.array([r["bin"] for r in bins]) * 2 / (_BINS - 1) - 0.5
    model.knots = isotonic(place, np.array([r["y"] for r in bins]), np.array([r["n"] for r in bins], dtype=float))
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row."""
    stats, _ = written(with_statistics(docs, id_col, text_col), "quality")
    model = fit(stats, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.score(_matrix(b.column("x")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("fold"), pa.array(score)],
                                             names=["doc_id", "fold", "score"])

    scored = stats.mapInArrow(run, "doc_id long, fold int, score double")
    return scored.select("doc_id", (F.col("fold") == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score is below the threshold (all columns kept)."""
    y = labels.select(labels[id_col].cast("long").alias("doc_id")).distinct()
    model = fit(with_statistics(docs, id_col, text_col).join(y, "doc_id", "left_semi"), labels)
    source = free_name(docs, "_text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(source)
            x = np.array([statistics(t) for t in utf8(b.column(at))]).reshape(-1, STATISTICS)
            left = [i for i in range(b.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in left],
                                             names=[b.schema.names[i] for i in left]).filter(pa.array(model.score(x) >= threshold))

    return docs.withColumn(source, docs[text_col].cast("string")).mapInArrow(keep, docs.schema)
