"""Hard-negative mining by anchor-clustered shared lists (operator 13).

Anchors are clustered by direction (centroids from a bounded sample of anchors). For every cluster
each row gets one upper bound of its inner product with any member: its norm times the cosine of
its angle to the centroid less the cluster's widest angle. In the order of that bound the rows are
the cluster's list, cut into segments that grow fourfold. Members walk it segment by segment: a member
is done when its norm times the next bound lies below everything it still needs, so its result
is certified exact; the others go on, to the end if need be.

The list is walked twice: first for the positives, rows of the anchor's label (kept apart by label);
then, with their scores known, for the best rows of other labels within each positive's range of
scores. Within a segment, anchors and rows meet in blocks of bounded size, so neither a label nor a
cluster that holds a third of all rows is one task.

Components become floor(scale * x), so scores are whole numbers; they are exact while they stay
below 2^56. Rows with a null id, label or vector, with null or non-finite components, or of another
length than the commonest (of equally common ones the shortest) take no part. Rows equal in id, label
and vector count once; rows that share only the id are rows of their own, as anchors too. Empty tables
give no rows; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from stratalake.llm.common import map_arrow
from stratalake.session import keep

CLUSTERS = 8
SAMPLE = 4096  # anchors the centroids are fitted on
FIRST_SEGMENT, GROWTH = 8192, 4
ANCHOR_BLOCK, ROW_BLOCK, STEP = 512, 4000, 1000
MARGIN = 1e-7  # of the cosine: far above its rounding
LOWEST, HIGHEST = -(1 << 60), 1 << 60


def finite(column: Column) -> Column:
    """Vectors all of whose components are numbers."""
    return F.coalesce(F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def centroids(points: np.ndarray) -> np.ndarray:
    """Unit centroids by spherical k-means, from evenly spaced points of the sample."""
    norms = np.sqrt((points * points).sum(1, keepdims=True))
    unit = points[norms[:, 0] > 0] / norms[norms[:, 0] > 0]
    if not len(unit):
        return np.eye(1, points.shape[1])
    found = unit[np.linspace(0, len(unit) - 1, min(CLUSTERS, 1 + len(unit) // 16)).astype(int)]
    for _ in range(15):
        nearest = (unit @ found.T).argmax(1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, unit)
        lengths = np.sqrt((sums * sums).sum(1, keepdims=True))
        found = np.where(lengths > 0, sums / np.maximum(lengths, 1e-300), found)
    return found


def _angles(vectors: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles to all centroids and norms; zero vectors get angle 0."""
    norms = np.sqrt((vectors * vectors).sum(1))
    cosines = vectors @ centres.T / np.where(norms > 0, norms, 1)[:, None]
    cosines[norms == 0] = 1
    return np.arccos(np.clip(cosines, -1, 1)), norms


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy().astype(float).reshape(len(column), -1)


def _scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whole inner products, exact: as doubles where no sum can pass 2^53, else as integers."""
    if x.shape[1] * float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) < 2.0**53:
        return (x.astype(float) @ y.T.astype(float)).astype(np.int64)
    return x @ y.T


def _walk_block(anchors: pd.DataFrame, rows: pd.DataFrame, k: int, same: bool) -> pd.DataFrame:
    """The best ``k`` rows of a block for every range of every anchor, in the list's order, until certified."""
    rows = rows.sort_values("_bound", ascending=False, kind="stable")
    x, y = np.stack(anchors["_v"].to_numpy()), np.stack(rows["_v"].to_numpy())
    norm, bound = anchors["_norm"].to_numpy(), rows["_bound"].to_numpy()
    ids, numbers, labels = (rows[c].to_numpy() for c in ("_id", "_row", "_label"))
    own, label = anchors["_row"].to_numpy(), anchors["_label"].to_numpy()
    slots = anchors["_slots"].tolist()
    most = max(map(len, slots))
    low, high, need, name = (np.full((len(x), most), v, np.int64) for v in (HIGHEST, LOWEST, HIGHEST, 0))
    for i, parts in enumerate(slots):
        for j, part in enumerate(parts):
            low[i, j], high[i, j], need[i, j], name[i, j] = part["_low"], part["_high"], part["_need"], part["_slot"]
    found = []
    for start in range(0, len(y), STEP):
        active = np.flatnonzero((norm * bound[start])[:, None].repeat(most, 1).__ge__(need).any(1))
        if not len(active):
            break
        part = slice(start, start + STEP)
        scores = _scores(x[active], y[part])
        fits = (label[active][:, None] == labels[part][None, :]) == same
        if same:
            fits &= own[active][:, None] != numbers[part][None, :]
        for j in range(most):
            least, top = need[active, j], high[active, j]
            if (low[active, j] > top).all():
                continue
            value = np.where(fits & (scores <= top[:, None]) & (scores >= least[:, None]), scores, LOWEST)
            kth = np.partition(value, -k, axis=1)[:, -k] if value.shape[1] >= k else np.full(len(active), LOWEST)
            need[active, j] = np.maximum(least, kth)
            a, c = np.nonzero((value > LOWEST) & (value >= kth[:, None]))
            found.append(pd.DataFrame({"_anchor": own[active[a]], "_slot": name[active[a], j], "_row": numbers[part][c], "_id": ids[part][c], "_score": value[a, c]}))
    if not found:
        return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("_anchor", "_slot", "_row", "_id", "_score")})
    best = pd.concat(found).sort_values(["_anchor", "_slot", "_score", "_id", "_row"], ascending=[True, True, False, True, True])
    return best[best.groupby(["_anchor", "_slot"]).cumcount() < k]


class Lists:
    """Anchors with their clusters, and rows with one bound per cluster, cut into segments."""

    def __init__(self, rows: DataFrame, is_anchor: Column):
        spark = rows.sparkSession
        sample = rows.where(is_anchor).orderBy(F.xxhash64("_id"), "_row").limit(SAMPLE).select("_v").collect()
        centres = centroids(np.array([r[0] for r in sample], float))
        clusters = len(centres)

        def nearest():
            def step(batch: pa.RecordBatch):
                angles, norms = _angles(_matrix(batch, "_v"), centres)
                return {"_cluster": angles.argmin(1).astype(np.int32), "_angle": angles.min(1), "_norm": norms}

            return step

        added = T.StructType([T.StructField("_cluster", T.IntegerType()), T.StructField("_angle", T.DoubleType()), T.StructField("_norm", T.DoubleType())])
        self.anchors = keep(map_arrow(rows.where(is_anchor), ["_row", "_id", "_label", "_v"], added, nearest), "anchors")
        wide = np.zeros(clusters)
        for cluster, angle in self.anchors.groupBy("_cluster").agg(F.max("_angle")).collect():  # CLUSTERS rows
            wide[cluster] = angle

        def bounds():
            def step(batch: pa.RecordBatch):
                angles, norms = _angles(_matrix(batch, "_v"), centres)
                bound = norms[:, None] * (np.cos(np.maximum(0, angles - wide)) + MARGIN)
                return {"_bounds": pa.array(list(bound), pa.list_(pa.float64()))}

            return step

        added = T.StructType([T.StructField("_bounds", T.ArrayType(T.DoubleType()))])
        self.rows = keep(map_arrow(rows, ["_row", "_id", "_label", "_v"], added, bounds), "bounds")
        total, shares, size = self.rows.count(), [], FIRST_SEGMENT
        while size < total:
            shares.append(1 - size / total)
            size *= GROWTH
        self.cuts = [[float("inf")] for _ in range(clusters)]
        if shares:
            found = self.rows.agg(*[F.percentile_approx(F.get("_bounds", F.lit(c)), shares, 10000) for c in range(clusters)]).first()
            self.cuts = [[float("inf"), *part] for part in found]
        self.segments = len(shares) + 1

    def cut(self, segment: int) -> Column:
        """Upper end of a segment, by ``_cluster``; below the last one there is nothing."""
        ends = [c[segment] if segment < len(c) else float("-inf") for c in self.cuts]
        return F.get(F.array(*[F.lit(e) for e in ends]), F.col("_cluster"))

    def walk(self, slots: DataFrame, k: int, same: bool) -> DataFrame:
        """``_anchor``, ``_slot``, ``_row``, ``_id``, ``_score``: the ``k`` best rows of every range of scores.

        ``slots``: ``_anchor``, ``_slot``, ``_low``, ``_high``; ``same`` asks for rows of the anchor's label.
        """
        spark = slots.sparkSession
        kind = "_anchor long, _slot long, _row long, _id long, _score long"
        order = Window.partitionBy("_anchor", "_slot").orderBy(F.desc("_score"), "_id", "_row")
        key = ["_cluster", "_label"] if same else ["_cluster"]
        found = spark.createDataFrame([], kind)
        for segment in range(self.segments):
            reached = found.groupBy("_anchor", "_slot").agg(F.count("*").alias("_n"), F.min("_score").alias("_worst")).where(F.col("_n") >= k)
            needs = slots.join(reached.drop("_n"), ["_anchor", "_slot"], "left").withColumn("_need", F.greatest("_low", F.coalesce("_worst", "_low")))
            state = needs.groupBy("_anchor").agg(F.collect_list(F.struct("_slot", "_low", "_high", "_need")).alias("_slots"), F.min("_need").alias("_least"))
            state = self.anchors.join(state, self.anchors["_row"] == state["_anchor"]).where(F.col("_norm") * self.cut(segment) >= F.col("_least"))
            state = keep(state.select("_row", "_label", "_v", "_norm", "_cluster", "_slots"), "open")
            if state.isEmpty():
                break
            asked = state.groupBy(*key).agg(F.ceil(F.count("*") / ANCHOR_BLOCK).alias("_asked"))
            listed = self.rows.select("_row", "_id", "_label", "_v", F.posexplode("_bounds").alias("_cluster", "_bound"))
            listed = listed.where((F.col("_bound") <= self.cut(segment)) & (F.col("_bound") > self.cut(segment + 1)))
            blocks = listed.groupBy(*key).agg(F.ceil(F.count("*") / ROW_BLOCK).alias("_blocks")).join(asked, key)
            every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
            mine = lambda n: F.pmod(F.xxhash64("_row"), F.col(n))
            left = state.join(blocks, key).withColumn("_a", mine("_asked")).withColumn("_b", every("_blocks")).drop("_asked", "_blocks")
            right = listed.join(blocks, key).withColumn("_b", mine("_blocks")).withColumn("_a", every("_asked")).drop("_asked", "_blocks")

            def compare(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
                if len(anchors) and len(rows):
                    return _walk_block(anchors, rows, k, same)
                return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("_anchor", "_slot", "_row", "_id", "_score")})

            block = [*key, "_a", "_b"]
            new = left.groupBy(*block).cogroup(right.groupBy(*block)).applyInPandas(compare, kind)
            best = found.unionByName(new).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k)
            found = keep(best.drop("_r"), "best")
        return found


def hard_negatives(
    df: DataFrame, anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``anchor`` marks the rows to mine for; a negative's score lies between ``low`` and ``high`` percent
    of its positive's.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = df.where(finite(F.col(vector)) & F.col(key).isNotNull() & label.isNotNull())
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = rows.select(F.col(key).cast("long").alias("_id"), label.cast("long").alias("_label"), whole.alias("_v"), F.coalesce(anchor, F.lit(False)).alias("_asks"))
    rows = keep(rows.distinct().withColumn("_row", F.monotonically_increasing_id()), "vectors")
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    width = rows.groupBy(F.size("_v").alias("_w")).count().orderBy(F.desc("count"), "_w").first()
    if width is None or width[0] == 0:
        return df.sparkSession.createDataFrame([], out)
    rows = rows.where(F.size("_v") == width[0])
    if rows.where("_asks").isEmpty():
        return df.sparkSession.createDataFrame([], out)
    lists = Lists(rows, F.col("_asks"))
    slots = lists.anchors.select(F.col("_row").alias("_anchor"), F.lit(0).cast("long").alias("_slot"), F.lit(LOWEST + 1).cast("long").alias("_low"), F.lit(HIGHEST).cast("long").alias("_high"))
    near = lists.walk(slots, positives, same=True)
    near = near.withColumns({
        "_slot": F.col("_row"),  # a positive's range of scores
        "_low": F.expr(f"(_score * {low} + pmod(-_score * {low}, 100)) div 100"),
        "_high": F.expr(f"(_score * {high} - pmod(_score * {high}, 100)) div 100"),
    })
    found = lists.walk(near.where("_low <= _high").select("_anchor", "_slot", "_low", "_high"), negatives, same=False)
    found = found.select("_anchor", "_slot", F.col("_id").alias("negative_id"), F.col("_score").alias("negative_score"), F.col("_row").alias("_n"))
    pairs = near.select("_anchor", "_slot", F.col("_id").alias("positive_id"), F.col("_score").alias("positive_score")).join(found, ["_anchor", "_slot"])
    pairs = pairs.join(lists.anchors.select(F.col("_row").alias("_anchor"), F.col("_id").alias("anchor_id")), "_anchor")
    order = Window.partitionBy("_anchor", "_slot").orderBy(F.desc("negative_score"), "negative_id", "_n")
    return pairs.withColumn("rank", F.row_number().over(order)).select(*[c.split()[0] for c in out.split(", ")])
