"""Quality scores: ridge regression on random Fourier features, calibrated by isotonic regression.

1. Each text becomes a few statistics of its bytes, words and lines, stored once.
2. Random Fourier features: cosines of random projections of the standardised
   statistics, whose products approximate a Gaussian kernel.
3. Every task adds up the normal equations of its labelled rows.  Features are
   rounded to whole 4096ths, so sums are integers and do not depend on the
   partitioning.  Spark adds the tasks' matrices row by row; the driver receives two
   of a fixed size, one for each half of the training rows, and solves.
4. Each half is scored by the model of the other.  The scores are counted in bins and
   pooled until the share of good labels never falls (isotonic regression); the curve
   through the pools turns the score of the model of all rows into a probability.

All labelled rows take part, none are sampled.  One pass reads the texts; the passes
after it read the statistics.

Cases: NULL and empty texts have the statistics of a text without bytes and are
scored by them; labels without doc_id, or other than 0 and 1, are not used, several
labels of a doc_id are averaged; without any usable label every score is 0.5;
repeated rows are rows of their own; a NULL doc_id has no label and is not held out;
columns beyond doc_id, text and quality are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimstrata.llm.bottom_sketches import word_hashes
from claimstrata.llm.shared import stored

STATISTICS = (
    "log_bytes",
    "log_words",
    "word_bytes",
    "upper",
    "digits",
    "symbols",
    "marks",
    "sentence_ends",
    "other_punctuation",
    "beyond_ascii",
    "line_breaks",
    "entropy",
    "distinct_words",
    "most_frequent_word",
    "repeated_triples",
    "repeated_lines",
    "words_a_line",
    "words_ending_in_symbols",
)
# Features are whole multiples of 1 / UNIT.
UNIT = 4096


@dataclass(frozen=True)
class KernelRidge:
    features: int = 256
    # Width of the kernel, in standard deviations for each statistic.
    width: float = 1.0
    ridge: float = 1e-3
    seed: int = 13
    # Scores of the halves are counted in bins between -reach and reach.
    bins: int = 2048
    reach: float = 2.0


def _classes() -> np.ndarray:
    """Which bytes belong to which class of characters."""
    groups = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b"!?", b".", b",;:\"'()[]{}-_/\\+=@^`~", bytes(range(128, 256)), b"\n"]
    table = np.zeros((256, len(groups)))
    for k, group in enumerate(groups):
        table[list(group), k] = 1
    return table


_CLASSES = _classes()
_SYMBOL = (_CLASSES[:, 2] + _CLASSES[:, 3]) > 0
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _repeated(values: np.ndarray) -> float:
    """Share of values equal to an earlier one."""
    return 1 - len(np.unique(values)) / len(values) if len(values) else 0.0


def statistics(text: bytes) -> list[float]:
    """The numbers named in STATISTICS."""
    data = np.frombuffer(text, np.uint8)
    counts = np.bincount(data, minlength=256)
    share = counts / max(len(data), 1)
    present = share[share > 0]
    words = word_hashes(text)
    frequency = np.unique(words, return_counts=True)[1]
    n_words = max(len(words), 1)
    with np.errstate(over="ignore"):
        triples = (words[:-2] * np.uint64(3) + words[1:-1]) * np.uint64(5) + words[2:] if len(words) > 2 else words[:0]
    lines = [line for line in text.split(b"\n") if line.strip()]
    space = _SPACE[data]
    word_end = np.flatnonzero(~space & np.append(space[1:], True)) if len(data) else np.zeros(0, np.int64)
    return [
        math.log1p(len(data)),
        math.log1p(len(words)),
        min(len(data) / n_words, 100.0) / 10,
        *(share @ _CLASSES),
        float(-(present * np.log2(present)).sum()),
        len(frequency) / n_words,
        float(frequency.max(initial=0)) / n_words,
        _repeated(triples),
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        math.log1p(len(words) / max(len(lines), 1)),
        float(_SYMBOL[data[word_end]].sum()) / n_words,
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, x (the statistics)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(text.as_py() or b"") for text in batch["__text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "x"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("__text")).mapInArrow(
        measure, f"doc_id {id_type}, x array<double>"
    )


def usable_labels(labels: DataFrame) -> DataFrame:
    """doc_id, y: the mean of each document's labels 0 and 1."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    return usable.groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("y"))


class Features:
    """Maps statistics to cosines of random projections, and a constant."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, settings: KernelRidge) -> None:
        random = np.random.default_rng(settings.seed)
        n = len(mean)
        self.mean, self.scale = mean, scale
        self.directions = random.standard_normal((n, settings.features)) / (settings.width * math.sqrt(n))
        self.phases = random.uniform(0, 2 * math.pi, settings.features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """One row of whole numbers of 1 / UNIT for each row of `x`."""
        cosines = np.cos((x - self.mean) / self.scale @ self.directions + self.phases)
        return np.round(UNIT * np.column_stack([cosines, np.ones(len(x))]))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def standard(training: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each statistic, to six places."""
    columns = [F.get("x", F.lit(k)) for k in range(len(STATISTICS))]
    row = training.agg(*(F.avg(c) for c in columns), *(F.stddev_pop(c) for c in columns)).first()
    mean, scale = np.array([v or 0.0 for v in row], float).reshape(2, -1).round(6)
    return mean, np.where(scale > 0, scale, 1.0)


def normal_equations(training: DataFrame, features: Features, half_of_row: str, size: int) -> np.ndarray:
    """Z'Z and Z'y of both halves: an array of (2, size, size + 1) whole numbers."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, size, size + 1), np.int64)
        for batch in batches:
            z = features(_matrix(batch["x"], len(STATISTICS)))
            y = np.round(UNIT * (2 * batch["y"].to_numpy() - 1))
            half = batch[half_of_row].to_numpy()
            for k in (0, 1):
                # Whole numbers below 2^53, so the products are exact.
                sums[k] += (z[half == k].T @ np.column_stack([z, y])[half == k]).astype(np.int64)
        for k in (0, 1):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, k, np.int32)), pa.array(np.arange(size, dtype=np.int32)), pa.array(list(sums[k]), pa.list_(pa.int64()))],
                names=["half", "i", "sums"],
            )

    parts = training.select("x", "y", half_of_row).mapInArrow(add_up, "half int, i int, sums array<bigint>")
    added = parts.groupBy("half", "i").agg(F.array(*(F.sum(F.get("sums", F.lit(j))) for j in range(size + 1))).alias("sums"))
    total = np.zeros((2, size, size + 1))
    for row in added.collect():  # 2 * size rows
        total[row["half"], row["i"]] = row["sums"]
    return total


def solve(equations: np.ndarray, ridge: float) -> np.ndarray:
    """Weights that minimise the mean squared error plus `ridge` times their squared length."""
    size = len(equations)
    n = equations[-1, -2] / UNIT**2  # the constant's square, once for each row
    if n < 0.5:
        return np.zeros(size)
    scaled = equations / (n * UNIT**2)
    return np.linalg.solve(scaled[:, :-1] + ridge * np.eye(size), scaled[:, -1])


def pooled(weights: np.ndarray, means: np.ndarray) -> np.ndarray:
    """The nearest sequence that never falls, by pooling adjacent violators."""
    pools: list[list[float]] = []
    for w, m in zip(weights.tolist(), means.tolist()):
        pools.append([w, m, 1])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            w2, m2, n2 = pools.pop()
            w1, m1, n1 = pools[-1]
            pools[-1] = [w1 + w2, (w1 * m1 + w2 * m2) / (w1 + w2), n1 + n2]
    return np.repeat([m for _, m, _ in pools], [int(n) for *_, n in pools])


@dataclass(frozen=True)
class Model:
    features: Features
    # Weights of all rows, and of the rows outside each half.
    weights: np.ndarray
    of_others: np.ndarray
    # Raw scores and the probabilities there.
    knots: np.ndarray
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights / UNIT

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0.0, 1.0)


def calibration(training: DataFrame, model: Model, half_of_row: str, settings: KernelRidge) -> tuple[np.ndarray, np.ndarray]:
    """Raw scores and probabilities there, from each half scored by the model of the other."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = model.features(_matrix(batch["x"], len(STATISTICS)))
            raw = (z * model.of_others[batch[half_of_row].to_numpy()]).sum(axis=1) / UNIT
            place = np.floor((raw + settings.reach) / (2 * settings.reach) * settings.bins)
            place = np.clip(place, 0, settings.bins - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(place), batch["y"]], names=["bin", "y"])

    placed = training.select("x", "y", half_of_row).mapInArrow(place, "bin int, y double")
    rows = placed.groupBy("bin").agg(F.count("*").alias("n"), F.avg("y").alias("y")).orderBy("bin").collect()  # `bins` at most
    if not rows:
        return np.zeros(1), np.full(1, 0.5)
    knots = (np.array([r["bin"] for r in rows]) + 0.5) / settings.bins * 2 * settings.reach - settings.reach
    return knots, pooled(np.array([r["n"] for r in rows], float), np.array([r["y"] for r in rows]))


def fit(training: DataFrame, half_of_row: str, settings: KernelRidge) -> Model:
    """A model of rows (x, y, half 0 or 1)."""
    features = Features(*standard(training), settings)
    halves = normal_equations(training, features, half_of_row, settings.features + 1)
    everything = halves.sum(axis=0)
    # A half without rows leaves nothing to hold out.
    others = [other if other.any() else everything for other in halves[::-1]]
    of_others = np.array([solve(other, settings.ridge) for other in others])
    model = Model(features, solve(everything, settings.ridge), of_others, np.zeros(1), np.full(1, 0.5))
    return Model(features, model.weights, of_others, *calibration(training, model, half_of_row, settings))


def score_quality(docs: DataFrame, training_labels: DataFrame, settings: KernelRidge | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, score, predicted (1 from score 0.5 on).

    `training_labels` (doc_id, quality) are the only rows learned from.
    """
    settings = settings or KernelRidge()
    measured = stored(document_statistics(docs), "statistics")
    half = "__half"
    training = stored(
        measured.join(usable_labels(training_labels), "doc_id").withColumn(
            half, F.crc32(F.concat(F.lit("half "), F.col("doc_id").cast("string"))).bitwiseAND(1).cast("int")
        ),
        "training",
    )
    model = docs.sparkSession.sparkContext.broadcast(fit(training, half, settings))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.value.scores(_matrix(batch["x"], len(STATISTICS)))
            predicted = pa.array((score >= 0.5).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(score), predicted], names=["doc_id", "score", "predicted"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return measured.mapInArrow(judge, f"doc_id {id_type}, score double, predicted int")
