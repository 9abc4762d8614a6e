"""Language identification (operator 6): multinomial logistic regression on character n-grams.

Texts are lower-cased, everything but letters becomes one blank, and runs of one to three
characters are counted in ``BUCKETS`` hashed places; weights are log counts times inverse
document frequency, of length one. Document frequencies cover all learnable rows. Shards of a
bounded labelled sample train with follow-the-regularised-leader under an elastic net; their
weights are averaged, and a temperature fitted on rows that no shard saw calibrates the scores.

Rows whose crc32(key) mod 4 is 2 are never learned from. At most about ``FIT_PER_LANG`` rows per
language, chosen by hash, are fitted on; their whole texts are used. A null text, or one without
a letter, is ``und`` with score 0. With nothing to learn from, every text is ``und``. Rows with a
null language are only predicted. Repeated rows get equal results; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalake.llm.common import crc_remainder, map_arrow, texts
from stratalake.session import keep

BUCKETS = 1 << 15
FIT_PER_LANG = 3000
SHARDS = 6
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
UNKNOWN = "und"
BLOCK = 1 << 20  # characters looked at together


@cache
def letters_of_unicode() -> np.ndarray:
    """Whether each code point is a letter; built once a process."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


class Grams:
    """Counts of hashed character runs of a text."""

    def __init__(self):
        self.letter = letters_of_unicode()

    def counts(self, text: str) -> np.ndarray | None:
        """Counts per bucket, or None if the text has no letter."""
        total, letters, tail, last = np.zeros(BUCKETS, np.int64), False, np.zeros(0, np.uint64), np.array([32], np.uint64)
        text = text.lower()  # whole, as a letter's form can depend on its neighbours
        for start in range(0, len(text), BLOCK):
            codes = np.frombuffer(text[start : start + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)
            known = self.letter[codes]
            letters = letters or bool(known.any())
            row = np.where(known, codes, 32).astype(np.uint64)
            row = row[(row != 32) | (np.concatenate([last, row[:-1]]) != 32)]
            last = row[-1:] if len(row) else last
            row = np.concatenate([tail, row])
            mixed = row
            for order in (1, 2, 3):
                # a block begins with the last two characters of the one before it
                fresh = mixed[max(len(tail) - order + 1, 0) :]
                spread = (fresh + np.uint64(order << 40)) * np.uint64(0x9E3779B97F4A7C15)
                total += np.bincount((spread >> np.uint64(64 - 15)).astype(np.int64), minlength=BUCKETS)
                if order < 3:
                    mixed = mixed[:-1] * np.uint64(0x1000193) + row[order:] if len(mixed) > 1 else mixed[:0]
            tail = row[-2:]
        return total if letters else None


def frequencies(df: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and how many texts have letters; sums per task first."""

    def run(batches):
        grams, seen, rows = Grams(), np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for value in texts(batch, "_text"):
                found = grams.counts(value)
                if found is not None:
                    seen += found > 0
                    rows += 1
        places = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(places, -1)), pa.array(np.append(seen[places], rows))], ["place", "n"])

    sums = df.select(F.col(text).cast("string").alias("_text")).mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    result, rows = np.zeros(BUCKETS), 0
    for place, n in sums.collect():  # at most BUCKETS + 1 rows
        if place < 0:
            rows = n
        else:
            result[place] = n
    return result, rows


@dataclass
class Model:
    """Languages, inverse document frequencies, weights (one row more for the bias), temperature."""

    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float = 1.0

    def vector(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = np.flatnonzero(found)
        values = np.log1p(found[places]) * self.idf[places]
        length = np.sqrt((values * values).sum())
        return np.append(places, BUCKETS), np.append(values / max(length, 1e-12), 0.3)

    def logits(self, found: np.ndarray) -> np.ndarray:
        places, values = self.vector(found)
        return values @ self.weights[places]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_shard(places: int, classes: int, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    """Follow the regularised leader over the rows; weights are sparse through L1."""
    z = np.zeros((places, classes))
    n = np.zeros_like(z)

    def weights(places: np.ndarray | slice) -> np.ndarray:
        zi, ni = z[places], n[places]
        return np.where(np.abs(zi) > L1, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2), 0.0)

    for _ in range(EPOCHS):
        for places, values, goal in rows:
            w = weights(places)
            miss = softmax(values @ w)
            miss[goal] -= 1
            g = values[:, None] * miss[None, :]
            squares = n[places]
            z[places] += g - (np.sqrt(squares + g * g) - np.sqrt(squares)) / ALPHA * w
            n[places] = squares + g * g
    return weights(slice(None))


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Learn from rows with a language that are not held out; None if there are none."""
    learn = df.where((crc_remainder(F.col(key), 4) != 2) & F.col(lang).isNotNull())
    learn = learn.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"), F.col(lang).cast("string").alias("_lang"))
    sizes = {r[0]: r[1] for r in learn.groupBy("_lang").count().collect()}  # one row per language
    seen, total = frequencies(learn, "_text")
    if not total:
        return None
    langs = sorted(sizes)
    model = Model(langs, np.log((1 + total) / (1 + seen)) + 1, np.zeros((BUCKETS + 1, len(langs))))
    share = F.create_map(*[F.lit(x) for name in langs for x in (name, float(min(1.0, FIT_PER_LANG / sizes[name])))])
    place = F.pmod(F.xxhash64("_key", F.lit("fit")), F.lit(1 << 30))
    sample = keep(learn.withColumn("_h", place).where(F.col("_h") < F.element_at(share, F.col("_lang")) * (1 << 30)), "sample")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def shard(batches):
        base, grams, rows = shared.value, Grams(), []
        for batch in batches:
            for value, name in zip(texts(batch, "_text"), batch.column(1).to_pylist()):
                found = grams.counts(value)
                if found is not None:
                    rows.append((*base.vector(found), base.langs.index(name)))
        if rows:
            order = np.random.default_rng(3).permutation(len(rows))
            weights = train_shard(BUCKETS + 1, len(base.langs), [rows[i] for i in order]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([len(rows)])], ["w", "n"])

    parts = sample.where("_h % 5 != 0").repartition(SHARDS, F.col("_h")).select("_text", "_lang").mapInArrow(shard, "w binary, n long").collect()
    if parts:
        n = sum(r.n for r in parts)
        model.weights = sum(np.frombuffer(r.w, np.float32).reshape(model.weights.shape) * (r.n / n) for r in parts)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def outputs():
        base, grams = shared.value, Grams()

        def step(batch: pa.RecordBatch):
            found = [grams.counts(t) for t in texts(batch, "_text")]
            return {"_logits": [None if f is None else base.logits(f) for f in found]}

        return step

    added = T.StructType([T.StructField("_logits", T.ArrayType(T.DoubleType()))])
    tune = map_arrow(sample.where("_h % 5 = 0"), ["_text", "_lang"], added, outputs).where("_logits is not null").select("_logits", "_lang").collect()
    if tune:  # a fifth of the bounded sample
        x, y = np.array([r[0] for r in tune]), np.array([langs.index(r[1]) for r in tune])
        losses = {t: -np.log(softmax(x / t)[np.arange(len(y)), y] + 1e-300).mean() for t in np.geomspace(0.02, 20, 120)}
        model.temperature = float(min(losses, key=losses.get))
    return model


def predict(df: DataFrame, model: Model | None, columns: list[str | Column] | None = None, text: str = "text") -> DataFrame:
    """``columns``, ``lang_pred`` and ``score``, the calibrated probability of that language."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        base, grams = shared.value, Grams()

        def step(batch: pa.RecordBatch):
            names, scores = [], []
            for value in texts(batch, "_text"):
                found = grams.counts(value) if base else None
                p = softmax(base.logits(found) / base.temperature) if found is not None else None
                names.append(UNKNOWN if p is None else base.langs[int(p.argmax())])
                scores.append(0.0 if p is None else float(p.max()))
            return {"lang_pred": names, "score": scores}

        return step

    added = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return map_arrow(df, [*(columns or ["doc_id"]), F.col(text).cast("string").alias("_text")], added, start).drop("_text")
