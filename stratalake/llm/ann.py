"""Approximate nearest neighbours by learned partitions (operator 10).

On a bounded sample the exact neighbour graph is built and cut into equally large partitions: a
first cut halves the points along their main directions, then points move to the partition that
holds most of their neighbours while the sizes stay balanced. A small neural classifier learns
each point's distribution of neighbours over partitions. Every row is indexed under its likeliest
partition; a query is compared with the rows of its most probable partitions. How many it probes
is fixed by the recall on sample points held back from training (``RECALL``).

Equal vectors are indexed once, with their ``k + 1`` smallest different ids, which is all a result can
show. Found entries are cut to ``k + 1`` different ids with at most ``k`` entries each, so that the own
id, however often it occurs, leaves ``k`` others.
Rows of a partition and queries are compared in blocks of bounded size, so a partition or a
vector with a third of all rows is no single task. Scores are summed dimension by dimension in
double precision.

Vectors that are null, zero, of another length than the sample's most common one, or that hold
null or non-finite components take no part, nor do rows with a null id. Rows that repeat id
and vector count once; an id with several vectors is a candidate with each of them, but none for the
query of that id, and asks with each of them: a candidate then has its best score. No usable rows give
no result.
Other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from stratalake.llm.common import map_arrow
from stratalake.session import keep

SAMPLE = 6000
PARTS = 16
NEIGHBOURS = 20  # in the graph
SLACK = 1.1  # largest partition over the mean
HIDDEN = 96
RECALL = 0.95
INDEX_BLOCK, QUERY_BLOCK = 4000, 1000


def usable(column: Column) -> Column:
    """Vectors that can be compared."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return column.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(column, lambda x: x != 0)


def neighbour_graph(points: np.ndarray, k: int) -> np.ndarray:
    """Ids of the k largest inner products of each point, itself left out; in blocks."""
    near = np.empty((len(points), min(k, len(points) - 1)), np.int64)
    for start in range(0, len(points), 1000):
        scores = points[start : start + 1000] @ points.T
        scores[np.arange(len(scores)), start + np.arange(len(scores))] = -np.inf
        near[start : start + 1000] = np.argpartition(-scores, near.shape[1] - 1, axis=1)[:, : near.shape[1]]
    return near


def balanced_parts(points: np.ndarray, near: np.ndarray, parts: int) -> np.ndarray:
    """Partition of the graph into ``parts`` (a power of two) of nearly equal size."""
    part = np.zeros(len(points), np.int64)
    for _ in range(parts.bit_length() - 1):
        new = part * 2
        for p in np.unique(part):
            mine = np.flatnonzero(part == p)
            centred = points[mine] - points[mine].mean(0)
            axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            new[mine[np.argsort(centred @ axis, kind="stable")[len(mine) // 2 :]]] += 1
        part = new
    room = int(np.ceil(SLACK * len(points) / parts))
    sizes = np.bincount(part, minlength=parts)
    # both directions of the graph count
    back = [[] for _ in range(len(points))]
    for i, row in enumerate(near):
        for j in row:
            back[j].append(i)
    both = [np.concatenate([near[i], np.array(back[i], np.int64)]) for i in range(len(points))]
    random = np.random.default_rng(5)
    for _ in range(12):
        moved = 0
        for i in random.permutation(len(points)):
            votes = np.bincount(part[both[i]], minlength=parts).astype(float)
            votes[(sizes >= room) & (np.arange(parts) != part[i])] = -1
            best = int(votes.argmax())
            if votes[best] > votes[part[i]]:
                sizes[part[i]] -= 1
                sizes[best] += 1
                part[i], moved = best, moved + 1
        if moved * 100 < len(points):
            break
    return part


@dataclass
class Router:
    """Two-layer classifier from vectors to partitions, and how many of them a query probes."""

    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x * self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def train_router(points: np.ndarray, goals: np.ndarray, epochs: int = 30, batch: int = 128, rate: float = 3e-3) -> Router:
    """Cross entropy with the neighbours' distribution, by Adam."""
    random = np.random.default_rng(6)
    width, parts = points.shape[1], goals.shape[1]
    scale = float(np.sqrt(width) / (np.sqrt((points**2).sum(1)).mean() + 1e-12))
    model = Router(scale, random.normal(0, np.sqrt(2 / width), (width, HIDDEN)), np.zeros(HIDDEN), random.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts))
    weights = [model.w1, model.b1, model.w2, model.b2]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        order = random.permutation(len(points))
        for start in range(0, len(order), batch):
            rows = order[start : start + batch]
            x = points[rows] * scale
            hidden = np.maximum(x @ model.w1 + model.b1, 0)
            out = hidden @ model.w2 + model.b2
            p = np.exp(out - out.max(1, keepdims=True))
            miss = (p / p.sum(1, keepdims=True) - goals[rows]) / len(rows)
            inner = (miss @ model.w2.T) * (hidden > 0)
            step += 1
            speed = rate * (1 - epoch / epochs) + 1e-5
            for w, g, m, v in zip(weights, [x.T @ inner, inner.sum(0), hidden.T @ miss, miss.sum(0)], first, second):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                w -= speed * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def fit(points: np.ndarray) -> Router:
    """Learn the partitions and the number of probes from sample points (one row each)."""
    if len(points) < 4 * PARTS:
        width = points.shape[1]
        return Router(1.0, np.zeros((width, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    near = neighbour_graph(points, NEIGHBOURS)
    part = balanced_parts(points, near, PARTS)
    goals = np.zeros((len(points), PARTS))
    np.add.at(goals, (np.repeat(np.arange(len(points)), near.shape[1]), part[near].ravel()), 1 / near.shape[1])
    held = np.arange(len(points)) % 5 == 0
    model = train_router(points[~held], goals[~held])
    out = model.logits(points)
    home = out.argmax(1)  # where rows are indexed
    ranks = np.argsort(np.argsort(-out[held], axis=1), axis=1)
    depth = np.take_along_axis(ranks, home[near[held]], axis=1)  # probes needed for each neighbour
    shares = [(depth < n).mean() for n in range(1, PARTS + 1)]
    model.probes = next((n for n, s in enumerate(shares, 1) if s >= RECALL), PARTS)
    return model


def _best(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best entries of a block for every query vector, with exact scores: k + 1 ids, at most k entries each."""
    x, y = np.stack(queries["_vector"]).astype(float), np.stack(rows["_vector"]).astype(float)
    scores = x @ y.T
    parts = []
    ids, classes = rows["_ids"].to_numpy(), rows["_c"].to_numpy()
    # rounding of the product cannot hide a row: it stays far below the margin
    margin = 1e-12 * (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1).max())) * x.shape[1]
    most, pending = min(k + 1, len(y)), np.arange(len(x))
    while len(pending):
        part = scores[pending]
        least = np.partition(part, len(y) - most, axis=1)[:, len(y) - most]
        q, c = np.nonzero(part >= (least - margin[pending])[:, None])
        q = pending[q]
        exact = np.zeros(len(q))
        for d in range(x.shape[1]):
            exact += x[q, d] * y[c, d]
        many = np.fromiter(map(len, ids[c]), np.int64, len(c))
        found = pd.DataFrame({"_at": np.repeat(q, many), "vec_id": np.concatenate(ids[c]), "_c": np.repeat(classes[c], many), "score": np.repeat(exact, many)})
        if most < len(y):  # ids with several vectors can leave too few different ones: these queries look at more rows
            different = found.drop_duplicates(["_at", "vec_id"]).groupby("_at").size().reindex(pending, fill_value=0).to_numpy()
            again = pending[different < k + 1]
            found = found[~found["_at"].isin(again)]
        else:
            again = pending[:0]
        parts.append(found)
        pending, most = again, min(2 * most, len(y))
    found = pd.concat(parts).sort_values(["_at", "score", "vec_id", "_c"], ascending=[True, False, True, True], kind="stable")
    found = found[found.groupby(["_at", "vec_id"], sort=False).cumcount() < k]
    first = ~found.duplicated(["_at", "vec_id"])
    found = found[first.groupby(found["_at"], sort=False).cumsum() <= k + 1]
    found["_q"] = queries["_q"].to_numpy()[found["_at"]]
    return found[["_q", "vec_id", "_c", "score"]]


def nearest(df: DataFrame, query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the k nearest found for rows where ``query``."""
    rows = df.where(query.isNotNull()).select(F.col(key).cast("long").alias("_id"), F.col(vector).cast("array<float>").alias("_vector"), query.alias("_asks"))
    rows = rows.where(F.col("_id").isNotNull() & usable(F.col("_vector")))
    same = Window.partitionBy("_vector").orderBy("_id")
    few = rows.select("_id", "_vector").distinct().withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1)
    distinct = keep(few.groupBy("_vector").agg(F.sort_array(F.collect_list("_id")).alias("_ids")).withColumn("_q", F.monotonically_increasing_id()), "vectors")  # _q numbers vectors; stored
    total = distinct.count()
    place = F.pmod(F.xxhash64("_vector"), F.lit(1 << 30))
    sample = distinct.where(place < int((1 << 30) * min(1.0, SAMPLE / max(total, 1)))).select("_vector").collect()  # about SAMPLE
    if not sample:  # so few rows that the hash chose none: all of them are few
        sample = distinct.select("_vector").limit(SAMPLE).collect()
    if not sample:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = pd.Series([len(r[0]) for r in sample]).mode()[0]
    points = np.array(sorted(r[0] for r in sample if len(r[0]) == width), float)
    router = df.sparkSession.sparkContext.broadcast(fit(points))
    distinct = distinct.where(F.size("_vector") == int(width))

    def routes():
        model = router.value

        def step(batch: pa.RecordBatch):
            x = np.array(batch.column(batch.schema.get_field_index("_vector")).to_pylist(), float)
            return {"_parts": np.argsort(-model.logits(x), axis=1, kind="stable")[:, : model.probes].astype(np.int32).tolist()}

        return step

    added = T.StructType([T.StructField("_parts", T.ArrayType(T.IntegerType()))])
    placed = keep(map_arrow(distinct, ["_q", "_vector", "_ids"], added, routes), "placed")
    index = placed.withColumn("_part", F.get("_parts", F.lit(0)))
    asking = rows.where("_asks").groupBy("_vector").agg(F.count(F.lit(1)).alias("_n"))
    asking = keep(placed.join(asking, "_vector").select("_q", "_vector", F.explode("_parts").alias("_part")), "asking")
    sizes = index.groupBy("_part").agg(F.ceil(F.count(F.lit(1)) / INDEX_BLOCK).alias("_rows"))
    sizes = sizes.join(asking.groupBy("_part").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("_asked")), "_part")
    sizes = F.broadcast(sizes)  # one row per partition of the router
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("_q"), F.col(n))
    left = asking.join(sizes, "_part").withColumn("_qb", mine("_asked")).withColumn("_cb", every("_rows")).select("_part", "_cb", "_qb", "_q", "_vector")
    right = index.join(sizes, "_part").withColumn("_cb", mine("_rows")).withColumn("_qb", every("_asked")).select("_part", "_cb", "_qb", "_ids", F.col("_q").alias("_c"), "_vector")
    block = ["_part", "_cb", "_qb"]

    def compare(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if len(queries) and len(candidates):
            return _best(queries, candidates, k)
        return pd.DataFrame({"_q": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "_c": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

    found = left.groupBy(*block).cogroup(right.groupBy(*block)).applyInPandas(compare, "_q long, vec_id long, _c long, score double")
    # again at most k entries of an id, and k + 1 ids in the order of their best entries
    best = Window.partitionBy("_q", "vec_id").orderBy(F.desc("score"), "_c")
    found = found.repartition("_q").withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k)
    ids = Window.partitionBy("_q").orderBy(F.desc("score"), "vec_id", "_c").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("_n", F.sum((F.col("_r") == 1).cast("int")).over(ids)).where(F.col("_n") <= k + 1).drop("_r", "_n")
    asks = rows.where("_asks").join(placed.select("_vector", "_q"), "_vector").select(F.col("_id").alias("query_id"), "_q").distinct()
    result = asks.join(found, "_q").where("vec_id <> query_id")
    result = result.groupBy("query_id", "vec_id", "_c").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "_c")
    return result.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
