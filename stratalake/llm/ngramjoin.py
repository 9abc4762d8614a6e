"""N-gram Jaccard join in the metric space of Jaccard distances (operator 12).

A document's set is that of its distinct ``size``-word shingles, or its whole word sequence if it
has fewer words. Documents with equal sets form one class. Jaccard distance is a metric, and two
sets are linked if theirs is at most e = 1 - ``percent`` / 100.

Most sets are at distance 1 from every pivot that could be drawn, where the triangle inequality
says nothing. So a pivot is only compared with sets that can be near it: linked sets share one of their rarest
shingles (the first n - ceil(percent * n / 100) + 1 in an order all share), each such shingle has one
of its holders as pivot, and a pivot's region holds all sets that share one of its shingles so.
Hash places cannot tell a shingle of one document from a passage that a few dozen share. So sets of which too few
shingles occur in any other set leave before, by exact counts: first of a prefix longer by a tenth of the set
(``overlap``), before full sets are built, then of half of all shingles (``covered_sets``).
Linked sets share a region. In it:

* sets at distance e or less from the pivot are linked with it;
* sets of different components that remain can only be linked where their distances to the pivot
  differ by e at most, so regions are cut into rings of that width, each with the next ring's rows;
* rings of over ``REGION_ROWS`` sets become Voronoi cells around new pivots; a set is copied to
  every cell whose pivot is no more than 2e farther than its nearest one, so linked sets meet in
  the cell of either. Cells are split again until they are small; rows of a cell that no longer
  shrinks meet in blocks;
* a task joins a small cell the same way: Voronoi cells down to ``LEAF_ROWS`` sets, then full sets.

All links are confirmed on full sets. A cell yields only links that join components.

The order of rarity comes from counts over all documents in 2^24 hash places of shingles; places
of about equal counts are ordered by hash. Any order keeps the join exact.

Results for special cases: null, empty and blank texts have an empty set and stay alone; each row gets the
result of its own text, so a doc_id with several texts gives several rows; rows with a null doc_id
take their class's component (null if no member has an id). Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from stratalake.llm.common import map_arrow
from stratalake.llm.components import components
from stratalake.llm.neardup import shingler
from stratalake.session import discard, keep

PLACES, SLICE = 1 << 24, 1 << 18
REGION_ROWS, LEAF_ROWS = 1000, 24
PIVOTS = 8
TENTH = 10  # of this part of a set, prefixes are longer than linked sets need to meet
BITS = 1 << 24  # of the bitmap of documents whose full sets are built
SHRINK = 0.7  # a cell over this share of its parent is no progress
CLOSE = 1e-9  # far above the rounding of distances


def class_key(found: np.ndarray) -> tuple[int, int]:
    """A set's 128-bit digest as two numbers."""
    whole = xxhash.xxh3_128_digest(found.tobytes())
    return int.from_bytes(whole[:8], "big", signed=True), int.from_bytes(whole[8:], "big", signed=True)


def packed(counts: np.ndarray) -> bytes:
    """Counts of one slice for a shuffle: most of a task's places are empty or small."""
    return zstandard.ZstdCompressor(level=1).compress(counts.tobytes())


def unpacked(value: pa.BinaryScalar, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(value.as_py()), kind)


def described(docs: DataFrame, size: int) -> DataFrame:
    """``_doc``, ``n_shingles``, ``_s1``, ``_s2`` of each row; and one row per task and slice of the places with ``_slice`` and ``_counts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts = shingler(size), np.zeros(PLACES, np.int32)
        names = ["_doc", "n_shingles", "_s1", "_s2", "_slice", "_counts"]
        for batch in batches:
            out: list[list] = [[], [], []]
            for value in batch.column(1):
                found = shingles(value.as_py())
                counts[(found & np.uint64(PLACES - 1)).astype(np.int64)] += 1
                a, b = class_key(found) if len(found) else (None, None)
                for column, part in zip(out, (len(found), a, b)):
                    column.append(part)
            none = [pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in out), *none], names)
        for i in range(PLACES // SLICE if counts.any() else 0):
            part = [pa.array([i], pa.int32()), pa.array([packed(counts[i * SLICE : (i + 1) * SLICE])], pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), *[pa.nulls(1, pa.int64())] * 3, *part], names)

    return docs.select(F.col("_doc").cast("string"), "_text").mapInArrow(run, "_doc string, n_shingles long, _s1 long, _s2 long, _slice int, _counts binary")


def place_ranks(rows: DataFrame) -> np.ndarray:
    """Rank of each place by its count, on a scale of an eighth of a doubling: one byte a place."""
    kind = "_slice int, _counts binary"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[i] = sums.get(i, 0) + unpacked(value, np.int32).astype(np.int64)
        for i, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([packed(total)], pa.binary())], ["_slice", "_counts"])

    def ranked(part: pa.Table) -> pa.Table:
        total = sum(unpacked(v, np.int64) for v in part.column("_counts"))
        rank = np.floor(8 * np.log2(np.maximum(total, 1))).clip(0, 255).astype(np.uint8)
        return pa.table({"_slice": pa.array([part.column("_slice")[0].as_py()], pa.int32()), "_counts": pa.array([rank.tobytes()], pa.binary())})

    parts = rows.where("_slice is not null").select("_slice", "_counts").mapInArrow(partial, kind).groupBy("_slice").applyInArrow(ranked, kind)
    ranks = np.zeros(PLACES, np.uint8)
    for i, part in parts.collect():  # PLACES bytes in all
        ranks[i * SLICE : (i + 1) * SLICE] = np.frombuffer(part, np.uint8)
    return ranks


def prefix_length(n: int, percent: int) -> int:
    """Shingles, rarest first, of which linked sets share one."""
    return n - (n * percent + 99) // 100 + 1


def overlap(n: int) -> int:
    """By how many shingles less one the prefix of a set of n is longer than ``prefix_length``.

    Linked sets of n and m shingles hold the first ``overlap(min(n, m))`` of their common ones in both
    prefixes so lengthened; as m is at least ceil(percent * n / 100), that many of a set's prefix others share.
    """
    return max(1, n // TENTH)


def prefixes(docs: DataFrame, ranks, size: int, percent: int) -> DataFrame:
    """``_s1``, ``_s2``, ``_tokens``: the rarest shingles of each row's set, rarest first, ``overlap`` - 1 more than linked sets need to meet."""

    def start():
        shingles, order = shingler(size), ranks.value

        def step(batch: pa.RecordBatch):
            out: dict[str, list] = {"_s1": [], "_s2": [], "_tokens": []}
            for value in batch.column(batch.schema.get_field_index("_text")):
                found = shingles(value.as_py())
                a, b = class_key(found) if len(found) else (None, None)
                rank = order[(found & np.uint64(PLACES - 1)).astype(np.int64)]
                length = prefix_length(len(found), percent) + overlap(len(found)) - 1
                first = found[np.lexsort((found, rank))[:length]] if len(found) else found
                for name, part in zip(out, (a, b, first.view(np.int64))):
                    out[name].append(part)
            return out

        return step

    added = T.StructType().add("_s1", "long").add("_s2", "long").add("_tokens", T.ArrayType(T.LongType()))
    return map_arrow(docs, ["_text"], added, start).drop("_text")


def bit(key: Column) -> Column:
    """A key's place in a bitmap of ``BITS``, from 1."""
    return F.xxhash64(key).bitwiseAND(BITS - 1) + 1


def bitmap(keys: DataFrame, key: str) -> np.ndarray:
    """Bitmap of the keys' places: ``BITS`` bits, however many keys."""
    at = bit(F.col(key))
    rows = keys.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    bits = np.zeros(BITS // 8, np.uint8)
    for bucket, part in rows.collect():
        start = (bucket - 1) * len(part)
        bits[start : start + len(part)] = np.frombuffer(part, np.uint8)
    return bits


def set_table(docs: DataFrame, size: int, wanted=None) -> DataFrame:
    """``_s1``, ``_s2``, ``_set``: full sets, of the rows whose ``_doc`` has its bit in the broadcast ``wanted``, if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, bits = shingler(size), None if wanted is None else wanted.value
        for batch in batches:
            if bits is not None:
                at = batch.column(0).to_numpy() - 1
                batch = batch.filter(pa.array((bits[at >> 3] >> (at & 7) & 1).astype(bool)))
            sets = [shingles(v.as_py()) for v in batch.column(1)]
            keys = [class_key(s) if len(s) else (None, None) for s in sets]
            columns = [pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["_s1", "_s2", "_set"])

    return docs.select(bit(F.col("_doc")), "_text").mapInArrow(run, "_s1 long, _s2 long, _set array<long>")


def covered_sets(sets: DataFrame, percent: int) -> DataFrame:
    """``_c`` of the sets that can have a link by how many of their shingles other sets hold.

    A link leaves at most n - ceil(percent * n / 100) of a set's n shingles unshared. Looked at are the u
    shingles with an even hash; of these, other sets must then hold all but that many.
    """
    even = F.filter("_set", lambda t: t.bitwiseAND(F.lit(1)) == 0)
    rows = sets.select("_c", F.size("_set").alias("_n"), even.alias("_even"))
    need = (F.size("_even") - F.col("_n") + F.ceil(F.col("_n") * percent / 100)).cast("int")
    held = rows.select("_c", F.explode("_even").alias("_token"))
    shared = held.groupBy("_token").agg(F.count("*").alias("_held")).where("_held > 1").select("_token")
    found = held.join(shared, "_token", "left_semi").groupBy("_c").agg(F.count("*").alias("_found"))
    needed = rows.select("_c", need.alias("_need"))
    return needed.join(found, "_c", "left").where(F.coalesce("_found", F.lit(0)) >= F.col("_need")).select("_c")


def distance(common: Column, n: Column, m: Column) -> Column:
    return 1 - common / (n + m - common)


# --- small cells, inside a task -------------------------------------------------------------------


class Cell:
    """Sets of one cell, their components, and the links found between components."""

    def __init__(self, rows: pd.DataFrame, percent: int):
        self.percent, self.reach = percent, 1 - percent / 100
        self.names, self.sets = rows["_c"].to_numpy(), [np.sort(np.asarray(s, np.int64)) for s in rows["_set"]]
        self.sizes = np.array([len(s) for s in self.sets])
        _, self.root = np.unique(rows["_comp"].to_numpy(), return_inverse=True)
        self.links: list[tuple[int, int]] = []

    def common(self, one: int, rows: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of one set with others."""
        sizes = self.sizes[rows]
        tokens = np.concatenate([self.sets[r] for r in rows])
        place = np.minimum(np.searchsorted(self.sets[one], tokens), len(self.sets[one]) - 1)
        hit = self.sets[one][place] == tokens
        return np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))

    def link(self, one: int, rows: np.ndarray, common: np.ndarray) -> None:
        """Links of one set with rows of other components; joined components count as one."""
        for r in rows[100 * common >= self.percent * (self.sizes[one] + self.sizes[rows] - common)]:
            if self.root[r] != self.root[one]:
                self.links.append((self.names[one], self.names[r]))
                self.root[self.root == self.root[r]] = self.root[one]

    def blocked(self, rows: np.ndarray) -> None:
        """Each set with the following ones that its size allows."""
        for i, one in enumerate(rows[:-1]):
            rest = rows[i + 1 :]
            rest = rest[self.root[rest] != self.root[one]]
            rest = rest[100 * np.minimum(self.sizes[rest], self.sizes[one]) >= self.percent * np.maximum(self.sizes[rest], self.sizes[one])]
            if len(rest):
                self.link(one, rest, self.common(one, rest))

    def join(self, rows: np.ndarray) -> None:
        """Voronoi cells around pivots far from each other, and again, down to small ones."""
        if len(np.unique(self.root[rows])) < 2:
            return
        if len(rows) <= LEAF_ROWS:
            return self.blocked(rows)
        pivot, far = rows[0], []
        for _ in range(PIVOTS):
            common = self.common(pivot, rows)
            self.link(pivot, rows, common)
            far.append(1 - common / (self.sizes[pivot] + self.sizes[rows] - common))
            least = np.min(far, axis=0)
            if least.max() <= 0:
                break
            pivot = rows[least.argmax()]
        far, nearest = np.array(far), np.min(far, axis=0)
        cells = [rows[d <= nearest + 2 * self.reach + CLOSE] for d in far]
        if max(map(len, cells)) > SHRINK * len(rows):
            return self.blocked(rows)
        for cell in cells:
            self.join(cell)


def _joined(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links ``a``, ``b`` that join components of one cell."""
    cell = Cell(rows.drop_duplicates("_c").sort_values("_c"), percent)
    cell.join(np.arange(len(cell.names)))
    return pd.DataFrame(cell.links, columns=["a", "b"]).astype("int64")


# --- regions and large cells, as tables -----------------------------------------------------------


def rings(regions: DataFrame, reach: float) -> DataFrame:
    """``_cell``, ``_c``, ``_n``, ``_comp``: rings of a region by distance to its pivot, each with the next ring's rows."""
    ring = F.floor((F.col("_d") + CLOSE) / (reach + 2 * CLOSE)).cast("long")
    rows = regions.select("_p", "_c", "_n", "_comp", F.explode(F.array(ring, ring + 1)).alias("_ring"))
    cells = rows.groupBy("_p", "_ring").agg(F.min("_comp").alias("_x"), F.max("_comp").alias("_y")).where("_x < _y").select("_p", "_ring")
    return rows.join(cells, ["_p", "_ring"]).select(F.xxhash64("_p", "_ring").alias("_cell"), "_c", "_n", "_comp")


def split_cells(cells: DataFrame, sets: DataFrame, percent: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Small cells (``_cell``, ``_c``, ``_comp``) and links found with the pivots on the way."""
    reach = 1 - percent / 100
    small, links = [], []
    while True:
        sizes = keep(cells.groupBy("_cell").agg(F.count("*").alias("_rows")), "sizes")
        small.append(cells.join(sizes.where(F.col("_rows") <= limit).select("_cell"), "_cell").select("_cell", "_c", "_comp"))
        large = keep(cells.join(sizes.where(F.col("_rows") > limit), "_cell"), "large")
        if large.isEmpty():
            break
        first = Window.partitionBy("_cell").orderBy(F.xxhash64("_c", "_cell"), "_c")
        pivots = large.withColumn("_j", F.row_number().over(first)).where(F.col("_j") <= PIVOTS)
        pivots = pivots.select("_cell", "_j", F.col("_c").alias("_p"), F.col("_n").alias("_pn"), F.col("_comp").alias("_pcomp"))
        met = large.join(pivots, "_cell").join(sets, "_c").join(sets.select(F.col("_c").alias("_p"), F.col("_set").alias("_pset")), "_p")
        common = F.size(F.array_intersect("_set", "_pset")).cast("long")
        met = keep(met.select("_cell", "_rows", "_c", "_n", "_comp", "_j", "_p", "_pn", "_pcomp", common.alias("_common")), "met")
        linked = 100 * F.col("_common") >= percent * (F.col("_n") + F.col("_pn") - F.col("_common"))
        links.append(met.where(linked & (F.col("_comp") != F.col("_pcomp"))).select(F.col("_c").alias("a"), F.col("_p").alias("b")))
        far = met.withColumn("_d", distance(F.col("_common"), F.col("_n"), F.col("_pn")))
        nearest = far.groupBy("_cell", "_c").agg(F.min("_d").alias("_least"))
        within = far.join(nearest, ["_cell", "_c"]).where(F.col("_d") <= F.col("_least") + 2 * reach + CLOSE)
        within = keep(within.select(F.xxhash64("_cell", "_j").alias("_child"), "_cell", "_rows", "_c", "_n", "_comp"), "within")
        grown = within.groupBy("_child").agg(F.count("*").alias("_now"), F.min("_comp").alias("_x"), F.max("_comp").alias("_y"), F.max("_rows").alias("_rows"))
        # a cell stays whole, to meet in blocks, if one of its children does not shrink
        stuck = grown.where(F.col("_now") > SHRINK * F.col("_rows")).select("_child").join(within.select("_child", "_cell").distinct(), "_child").select("_cell").distinct()
        stuck = keep(stuck, "stuck")
        use = grown.where("_x < _y").select("_child")
        cells = keep(
            within.join(stuck, "_cell", "left_anti").join(use, "_child").select(F.col("_child").alias("_cell"), "_c", "_n", "_comp"), "cells"
        )
        blocks = large.join(stuck, "_cell").withColumn("_n_blocks", F.ceil(2 * F.col("_rows") / limit))
        blocks = blocks.withColumn("_own", F.pmod(F.xxhash64("_c"), F.col("_n_blocks"))).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n_blocks") - 1)))
        small.append(blocks.select(F.xxhash64("_cell", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("_cell"), "_c", "_comp"))
    every = small[0]
    for part in small[1:]:
        every = every.unionByName(part)
    found = sets.sparkSession.createDataFrame([], "a long, b long")
    for part in links:
        found = found.unionByName(part)
    return every, found


def jaccard_join(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, percent: int = 85, limit: int = REGION_ROWS) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` (smallest key reachable by links) of each row."""
    spark, kind = df.sparkSession, df.schema[key].dataType
    reach = 1 - percent / 100
    docs = df.select(F.col(key).alias("_doc"), F.col(text).cast("string").alias("_text"))
    stored = keep(described(docs, size), "sets")
    ranks = spark.sparkContext.broadcast(place_ranks(stored))  # PLACES bytes
    rows = stored.where("_slice is null").select(F.col("_doc").cast(kind).alias("_doc"), "n_shingles", "_s1", "_s2")
    classes = rows.where("n_shingles > 0").groupBy("_s1", "_s2").agg(F.min("_doc").alias("_rep"), F.first("n_shingles").alias("_n"))
    classes = keep(classes.withColumn("_c", F.monotonically_increasing_id()), "classes")

    tokens = prefixes(docs, ranks, size, percent).dropDuplicates(["_s1", "_s2"]).join(classes, ["_s1", "_s2"])
    tokens = keep(tokens.select("_c", "_n", "_tokens"), "tokens")
    least = F.ceil(F.col("_n") * percent / 100)  # of a set's shingles a linked one holds
    members = tokens.select("_c", F.posexplode("_tokens").alias("_at", "_token"), (F.col("_n") - least).alias("_last"))
    members = members.select("_c", "_token", (F.col("_at") <= F.col("_last")).alias("_meets"))
    several = members.groupBy("_token").agg(F.count("*").alias("_held")).where("_held > 1").select("_token")
    shared = keep(members.join(several, "_token", "left_semi"), "shared")
    discard(tokens)
    found = shared.groupBy("_c").agg(F.count("*").alias("_found")).join(classes.select("_c", "_n"), "_c")
    enough = keep(found.where(F.col("_found") >= F.greatest(F.floor(least / TENTH), F.lit(1))).select("_c"), "enough")
    met = keep(shared.where("_meets").drop("_meets").join(enough, "_c", "left_semi"), "holders")
    discard(shared, enough)

    def fitting(holders: DataFrame) -> DataFrame:
        """``_token`` and smallest ``_c``; two holders of too different sizes cannot be linked."""
        sized = holders.join(classes.select("_c", "_n"), "_c")
        found = [F.count("*").alias("_held"), F.min("_n").alias("_low"), F.max("_n").alias("_high"), F.min("_c").alias("_p")]
        fits = (F.col("_held") > 2) | ((F.col("_held") == 2) & (100 * F.col("_low") >= percent * F.col("_high")))
        return sized.groupBy("_token").agg(*found).where(fits).select("_token", "_p")

    wanted = met.join(fitting(met).select("_token"), "_token", "left_semi").select("_c").distinct()
    wanted = keep(classes.join(wanted, "_c", "left_semi"), "wanted")

    # other texts are not shuffled: rows leave by a bitmap where they are read, the few too many by the join
    full = set_table(docs, size, spark.sparkContext.broadcast(bitmap(wanted, "_rep"))).dropDuplicates(["_s1", "_s2"])
    full = keep(full.join(wanted, ["_s1", "_s2"]).select("_c", "_set"), "full")
    covered = keep(covered_sets(full, percent), "covered")
    sets = keep(full.join(covered, "_c", "left_semi"), "sets_left")
    discard(full)

    met = keep(met.join(covered, "_c", "left_semi"), "holders_left")
    pivots = keep(fitting(met), "pivots")
    near = keep(met.join(pivots, "_token").where("_c <> _p").select("_p", "_c").distinct(), "near")
    discard(met, pivots)

    met = near.join(sets, "_c").join(sets.select(F.col("_c").alias("_p"), F.col("_set").alias("_pset")), "_p")
    met = met.select("_p", "_c", F.size("_set").cast("long").alias("_n"), F.size("_pset").cast("long").alias("_pn"), F.size(F.array_intersect("_set", "_pset")).cast("long").alias("_common"))
    met = keep(met, "distances")
    discard(near)
    linked = 100 * F.col("_common") >= percent * (F.col("_n") + F.col("_pn") - F.col("_common"))
    links = keep(met.where(linked).select(F.col("_c").alias("a"), F.col("_p").alias("b")), "links")
    found = keep(components(links), "components")
    regions = met.select("_p", "_c", "_n", distance(F.col("_common"), F.col("_n"), F.col("_pn")).alias("_d"))
    own = met.select("_p", F.col("_p").alias("_c"), F.col("_pn").alias("_n"), F.lit(0.0).alias("_d")).distinct()
    regions = regions.unionByName(own).join(found, F.col("_c") == found["node"], "left").withColumn("_comp", F.coalesce("root", "_c")).drop("node", "root")
    cells, more = split_cells(keep(rings(regions, reach), "rings"), sets, percent, limit)
    cells = keep(cells.join(sets, "_c"), "small")
    inside = cells.groupBy("_cell").applyInPandas(lambda part: _joined(part, percent), "a long, b long")
    found = components(keep(links.unionByName(more).unionByName(inside), "links"))

    rooted = classes.join(found, classes["_c"] == found["node"], "left").withColumn("_root", F.coalesce("root", "_c"))
    smallest = rooted.groupBy("_root").agg(F.min("_rep").alias("_component"))
    rooted = rooted.join(smallest, "_root").select("_s1", "_s2", "_component")
    result = rows.join(rooted, ["_s1", "_s2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("_doc"))
    return result.select(F.col("_doc").alias(key), "n_shingles", component.alias("component_id"))
