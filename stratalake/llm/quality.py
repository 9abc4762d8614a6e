"""Quality classifier (operator 1): kernel ridge by random Fourier features, isotonic scores.

Each whole text is turned into statistics of its characters, words and lines. Random Fourier
features of the standardised statistics approximate a Gaussian kernel; every partition of the
labelled rows sums its part of the normal equations, and the sums give ridge weights. Ridge
outputs on rows that were held back from the sums are calibrated by isotonic regression.

The fit uses at most ``FIT_ROWS`` labelled rows, chosen by a hash of their key. Rows whose
crc32(key) mod 5 is 0 are never learned from. Null, empty and blank texts have the statistics
of an empty text and get a score like any other. Repeated labels of a document are averaged,
null labels left out; without any label every score is 0.5. Other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalake.llm.common import crc_remainder, map_arrow, texts
from stratalake.session import keep

FIT_ROWS = 200_000
FIT_TASKS = 16
FEATURES = 256
RIDGE = 1e-3
WIDTH = 3.0  # of the kernel, in standard deviations of the statistics
CUT = 0.3
SYMBOLS = "#*$%&|<>"
BLOCK = 1 << 20  # characters looked at together


def statistics(text: str) -> list[float]:
    """Fixed-length description of a text; every entry is bounded or a logarithm."""
    chars = max(len(text), 1)
    upper = lower = digit = space = symbol = mark = wide = 0
    for start in range(0, len(text), BLOCK):
        part = text[start : start + BLOCK]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        tally = np.bincount(np.minimum(codes, 255), minlength=256)
        upper += int(tally[65:91].sum())
        lower += int(tally[97:123].sum())
        digit += int(tally[48:58].sum())
        space += int(tally[9:14].sum() + tally[32])
        symbol += sum(int(tally[ord(c)]) for c in SYMBOLS)
        mark += sum(int(tally[ord(c)]) for c in ".,;:!?")
        wide += int(tally[128:].sum())
    words = text.encode("utf-8", "surrogatepass").split()
    n = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split("\n") if x.strip()]
    ends = odd = capital = 0
    if words:
        joined = np.frombuffer(b" ".join(words), np.uint8)
        after = np.cumsum(lengths + 1)
        last = np.bincount(joined[after - 2], minlength=256)
        first = np.bincount(joined[after - lengths - 1], minlength=256)
        ends, odd = (sum(int(last[ord(c)]) for c in marks) for marks in (".!?", SYMBOLS + "!"))
        capital = int(first[65:91].sum())
    return [
        np.log1p(len(words)),
        float(lengths.mean()),
        float(lengths.std()),
        upper / chars,
        lower / chars,
        digit / chars,
        space / chars,
        symbol / chars,
        mark / chars,
        wide / chars,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        pairs / max(len(words) - 1, 1),
        len(set(lines)) / max(len(lines), 1),
        np.log1p(len(words) / max(len(lines), 1)),
        ends / n,
        odd / n,
        capital / n,
        float((lengths == 1).mean()),
        float((lengths > 15).mean()),
    ]


@dataclass
class Model:
    """Everything that scoring needs; its size does not depend on the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, rows: np.ndarray) -> np.ndarray:
        scaled = np.clip((rows - self.mean) / self.scale, -8, 8)
        return np.sqrt(2 / len(self.phases)) * np.cos(scaled @ self.waves + self.phases)

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.features(rows) @ self.weights[:-1] + self.weights[-1]

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(rows), self.knots, self.levels), 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and levels of the increasing fit (pool adjacent violators), one prior row per class."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, sum of x
    for value, goal in zip(x[order], y[order]):
        blocks.append([goal, 1.0, value])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, w, s = blocks.pop()
            p = blocks[-1]
            blocks[-1] = [(p[0] * p[1] + m * w) / (p[1] + w), p[1] + w, p[2] + s]
    knots = np.array([s / w for _, w, s in blocks])
    levels = np.array([(m * w + 0.5) / (w + 1) for m, w, _ in blocks])
    return knots, np.maximum.accumulate(levels)


def _constant(width: int) -> Model:
    zero = np.zeros(width)
    return Model(zero, zero + 1, np.zeros((width, 1)), np.zeros(1), np.zeros(2), np.array([0.0, 1.0]), np.array([0.5, 0.5]))


def _sums(rows: DataFrame, columns: list[str], part) -> list[np.ndarray]:
    """Sum over partitions of the arrays that ``part(x, y)`` returns; only the sums travel."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column(0).to_pylist(), float)
                y = np.array(batch.column(1).to_pylist(), float)
                got = part(x, y)
                total = got if total is None else [a + b for a, b in zip(total, got)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([a.ravel().tolist()]) for a in total], [f"s{i}" for i in range(len(total))])

    shapes = part(np.zeros((1, len(statistics("")))), np.zeros(1))
    schema = T.StructType([T.StructField(f"s{i}", T.ArrayType(T.DoubleType())) for i in range(len(shapes))])
    found = rows.select(*columns).mapInArrow(run, schema).toArrow()  # one row per fit task
    sums = [found.column(i).combine_chunks().flatten().to_numpy().reshape(-1, zero.size).sum(0) for i, zero in enumerate(shapes)]
    return [total.reshape(zero.shape) for total, zero in zip(sums, shapes)]


def described(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and the statistics ``_x`` of each text."""

    def start():
        return lambda batch: {"_x": [statistics(t) for t in texts(batch, "_text")]}

    added = T.StructType([T.StructField("_x", T.ArrayType(T.DoubleType()))])
    return map_arrow(df, [F.col(key), F.col(text).cast("string").alias("_text")], added, start).drop("_text")


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Learn from the labelled rows of ``df`` that are not held out."""
    return fit_described(described(df.where(crc_remainder(F.col(key), 5) != 0), key, text), labels, key, label)


def fit_described(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> Model:
    """The same from a table that ``described`` made."""
    width = len(statistics(""))
    goal = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.avg(label).alias("_y"))
    goal = goal.where(crc_remainder(F.col(key), 5) != 0)
    rows = stats.where(crc_remainder(F.col(key), 5) != 0).join(goal, key)
    rows = keep(rows.select("_x", "_y", F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30)).alias("_h")), "labelled")
    count = rows.count()
    if not count:
        return _constant(width)
    bound = int((1 << 30) * min(1.0, FIT_ROWS / count))
    rows = rows.where(F.col("_h") < bound).coalesce(FIT_TASKS)  # few rows: each task sends its sums to the driver
    train, tune = rows.where(F.col("_h") % 4 != 0), rows.where(F.col("_h") % 4 == 0)
    n, first, second = _sums(train, ["_x", "_y"], lambda x, y: [np.array([float(len(x))]), x.sum(0), (x * x).sum(0)])
    if not n[0]:
        return _constant(width)
    mean = first / n[0]
    scale = np.sqrt(np.maximum(second / n[0] - mean**2, 0)) + 1e-6
    random = np.random.default_rng(1)
    waves = random.normal(0, 1 / WIDTH, (width, FEATURES)) / np.sqrt(width / 8)
    phases = random.uniform(0, 2 * np.pi, FEATURES)
    model = Model(mean, scale, waves, phases, np.zeros(FEATURES + 1), np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def equations(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        z = np.hstack([model.features(x), np.ones((len(x), 1))])
        return [z.T @ z, z.T @ y]

    gram, right = _sums(train, ["_x", "_y"], equations)
    model.weights = np.linalg.solve(gram + RIDGE * n[0] / FEATURES * np.eye(FEATURES + 1), right)
    held = tune.select("_x", "_y").collect()  # at most a quarter of FIT_ROWS
    if held:
        x, y = np.array([r[0] for r in held]), np.array([r[1] for r in held])
        model.knots, model.levels = isotonic(model.raw(x), y)
    return model


def score(df: DataFrame, model: Model, text: str = "text", columns: list[str | Column] | None = None) -> DataFrame:
    """``columns`` and ``score`` (0 to 1; higher: label 1 is likelier)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        known = shared.value

        def step(batch: pa.RecordBatch):
            return {"score": known.score(np.array([statistics(t) for t in texts(batch, "_text")], float))}

        return step

    added = T.StructType([T.StructField("score", T.DoubleType())])
    return map_arrow(df, [*(columns or ["doc_id"]), F.col(text).cast("string").alias("_text")], added, start).drop("_text")


def score_described(stats: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``key`` and ``score`` from a table that ``described`` made."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def start():
        known = shared.value
        return lambda batch: {"score": known.score(batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1))}

    return map_arrow(stats, [key, "_x"], T.StructType([T.StructField("score", T.DoubleType())]), start).drop("_x")
