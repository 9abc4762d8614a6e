"""Near duplicates by b-bit MinHash (operator 3).

A document's set is that of its distinct five-word shingles, or its whole word sequence if it
has fewer words. Documents with equal sets form one class; classes are compared through their
smallest doc_id. 128 minima per class make 32 band keys of four; of each minimum four bits are
kept and packed. Classes that share a band key are candidates. Their similarity is estimated by
counting equal four-bit fields and correcting for chance equality; only pairs far below the
threshold (five standard deviations) are left out. The others are confirmed on their full sets.

Buckets are never expanded into all their pairs. First each member is tried with the bucket's
member that shares most buckets; pairs within one component need no further look. What is left
between components is then tried completely, in blocks that yield only confirmed links, so no
link between components is lost.

Results for special cases: null, empty and blank texts have an empty set and stay alone; rows
with a null doc_id take their class's component and are never kept; repeated rows get the same
result (doc_id is expected to name one text). Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalake.llm.common import map_arrow, may_be_in
from stratalake.llm.components import components
from stratalake.session import keep

MINIMA, BANDS, BITS = 128, 32, 4
DEVIATIONS = 5.0
CHUNK = 2048
BLOCK_ROWS, COLUMNS = 500, 2048
CACHED_WORDS = 500_000
PACKED = MINIMA * BITS // 64


def shingler(size: int) -> Callable[[str | None], np.ndarray]:
    """Function from a text to the sorted distinct hashes of its word shingles."""
    known: dict[bytes, int] = {}
    powers = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64)) for k in range(size)]
    digest = xxhash.xxh3_64_intdigest

    def shingles(text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII white space only
        if not words:
            return np.zeros(0, np.uint64)
        if len(words) < size:
            return np.array([digest(b" ".join(words), seed=1)], np.uint64)
        if len(known) > CACHED_WORDS:
            known.clear()
        hashes = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = digest(w)
            hashes.append(h)
        row = np.array(hashes, np.uint64)
        n = len(row) - size + 1
        mixed = row[:n] * powers[0]
        for k in range(1, size):
            mixed += row[k : k + n] * powers[k]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)

    return shingles


def minima(hashes: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set, 32 bits each."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), CHUNK):
        values = hashes[start : start + CHUNK, None] * factors[None, :]
        values += offsets
        np.minimum(least, values.min(axis=0), out=least)
    return least >> np.uint64(32)


def signatures(df: DataFrame, text: str, keys: list[str], size: int) -> DataFrame:
    """``keys``, ``n_shingles``, set digest ``_s1``/``_s2``, packed bits and band keys of each row."""

    def start():
        shingles = shingler(size)
        random = np.random.default_rng(20)
        factors = random.integers(0, 1 << 64, MINIMA, dtype=np.uint64) | np.uint64(1)
        offsets = random.integers(0, 1 << 64, MINIMA, dtype=np.uint64)
        rows = MINIMA // BANDS
        fold = np.array([pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(rows)], np.uint64)
        salt = random.integers(0, 1 << 64, BANDS, dtype=np.uint64)
        shifts = np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)

        def step(batch: pa.RecordBatch):
            out: dict[str, list] = {"n_shingles": [], "_s1": [], "_s2": [], "_bits": [], "_bands": []}
            for value in batch.column(batch.schema.get_field_index("_text")):
                found = shingles(value.as_py())
                out["n_shingles"].append(len(found))
                if not len(found):
                    for name in ("_s1", "_s2", "_bits", "_bands"):
                        out[name].append(None)
                    continue
                whole = xxhash.xxh3_128_digest(found.tobytes())
                least = minima(found, factors, offsets)
                low = (least & np.uint64((1 << BITS) - 1)).reshape(PACKED, -1) << shifts
                bands = (least.reshape(BANDS, rows) * fold).sum(axis=1, dtype=np.uint64) + salt
                bands ^= bands >> np.uint64(31)
                bands *= np.uint64(0x94D049BB133111EB)
                out["_s1"].append(int.from_bytes(whole[:8], "big", signed=True))
                out["_s2"].append(int.from_bytes(whole[8:], "big", signed=True))
                out["_bits"].append(np.bitwise_or.reduce(low, axis=1).view(np.int64))
                out["_bands"].append(bands.view(np.int64))
            return out

        return step

    long = T.LongType()
    added = T.StructType([T.StructField("n_shingles", long), T.StructField("_s1", long), T.StructField("_s2", long)])
    added = added.add("_bits", T.ArrayType(long)).add("_bands", T.ArrayType(long))
    columns = [F.col(k) for k in keys] + [F.col(text).cast("string").alias("_text")]
    return map_arrow(df, columns, added, start).drop("_text")


def equal_fields(a: Column, b: Column) -> Column:
    """How many of the packed fields of two signatures are equal."""
    ones = sum(1 << k for k in range(0, 64, BITS))
    ones = F.lit(ones - (1 << 64) if ones >> 63 else ones).cast("long")
    differ = F.lit(0)
    for i in range(PACKED):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        for k in range(1, BITS):
            x = x.bitwiseOR(F.shiftrightunsigned(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))), k))
        differ = differ + F.bit_count(x.bitwiseAND(ones))
    return F.lit(MINIMA) - differ


def least_equal(similarity: float) -> int:
    """Equal fields below which a pair is left out.

    A field is equal with probability p = J + (1 - J) / 2^bits; the bound lies ``DEVIATIONS``
    standard deviations below p at the threshold.
    """
    p = similarity + (1 - similarity) / (1 << BITS)
    return int(MINIMA * (p - DEVIATIONS * (p * (1 - p) / MINIMA) ** 0.5))


def named(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose ``_doc`` is in ``ids``; the other texts are not shuffled."""
    return may_be_in(docs, ids, ["_doc"]).where("_may").drop("_may").join(ids, "_doc", "left_semi")


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int, size: int) -> DataFrame:
    """Pairs ``a``, ``b`` whose full sets have 100 * intersection >= percent * union."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct()
    texts = named(docs, ends.select(F.col("_id").alias("_doc")))
    both = pairs.join(texts.select(F.col("_doc").alias("a"), F.col("_text").alias("_ta")), "a")
    both = both.join(texts.select(F.col("_doc").alias("b"), F.col("_text").alias("_tb")), "b")

    def start():
        shingles = shingler(size)

        def step(batch: pa.RecordBatch):
            left, right = (batch.column(batch.schema.get_field_index(n)) for n in ("_ta", "_tb"))
            out, last, kept = [], None, np.zeros(0, np.uint64)
            for x, y in zip(left, right):
                x, y = x.as_py(), shingles(y.as_py())
                if x != last:
                    last, kept = x, shingles(x)
                common = len(np.intersect1d(kept, y, assume_unique=True))
                out.append(100 * common >= percent * (len(kept) + len(y) - common))
            return {"_linked": out}

        return step

    added = T.StructType([T.StructField("_linked", T.BooleanType())])
    return map_arrow(both, ["a", "b", "_ta", "_tb"], added, start).where("_linked").select("a", "b").distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` (smallest key reachable) and ``kept`` of each row."""
    docs = df.select(F.col(key).alias("_doc"), F.col(text).cast("string").alias("_text"))
    rows = keep(signatures(docs, "_text", ["_doc"], size), "signatures")
    classes = rows.where("n_shingles > 0").groupBy("_s1", "_s2").agg(
        F.min("_doc").alias("_rep"), F.first("_bits").alias("_bits"), F.first("_bands").alias("_bands")
    )
    classes = keep(classes, "classes")
    known = classes.where("_rep is not null")
    members = known.select("_rep", F.explode("_bands").alias("_band"))
    shared = members.groupBy("_band").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    members = keep(members.join(shared, "_band"), "buckets")
    # the pivot of a bucket is the member that shares most buckets: of edited copies, their origin
    degree = members.groupBy("_rep").agg(F.sum("_n").alias("_degree"))
    members = members.drop("_n")
    pivots = members.join(degree, "_rep").groupBy("_band").agg(F.max(F.struct("_degree", (-F.col("_rep")).alias("_m"))).alias("_p"))
    ends = members.join(pivots.select("_band", (-F.col("_p._m")).alias("_pivot")), "_band").where("_pivot <> _rep")
    stars = ends.select(F.least("_pivot", "_rep").alias("a"), F.greatest("_pivot", "_rep").alias("b")).distinct()
    signs = known.select("_rep", "_bits")
    stars = stars.join(signs.select(F.col("_rep").alias("a"), F.col("_bits").alias("_ba")), "a")
    stars = stars.join(signs.select(F.col("_rep").alias("b"), F.col("_bits").alias("_bb")), "b")
    least = least_equal(percent / 100)
    stars = keep(stars.where(equal_fields(F.col("_ba"), F.col("_bb")) >= least).select("a", "b"), "stars")
    links = keep(confirmed(stars, docs, percent, size), "links")
    found = keep(components(links), "components")
    links = links.unionByName(_between(members, known, found, docs, least, percent, size))
    found = components(links)
    roots = classes.join(found, classes["_rep"] == found["node"], "left").select("_s1", "_s2", F.coalesce("root", "_rep").alias("_root"))
    result = rows.select("_doc", "n_shingles", "_s1", "_s2").join(roots, ["_s1", "_s2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("_root")).otherwise(F.col("_doc"))
    return result.select(
        F.col("_doc").alias(key), "n_shingles", component.alias("component_id"), F.coalesce(F.col("_doc") == component, F.lit(False)).alias("kept")
    )


def _between(members: DataFrame, known: DataFrame, found: DataFrame, docs: DataFrame, least: int, percent: int, size: int) -> DataFrame:
    """All further links ``a``, ``b`` of one bucket between different components.

    Only buckets that hold several components are looked at. A first join asks of each member
    whether any partner of another component passes the estimate; only members with one get
    their full sets, which then meet in blocks that yield the confirmed links alone. A pair that
    shares several buckets opens the first of them.
    """
    placed = members.join(found, members["_rep"] == found["node"], "left").select("_band", "_rep", F.coalesce("root", "_rep").alias("_root"))
    mixed = placed.groupBy("_band").agg(F.min("_root").alias("_r0"), F.max("_root").alias("_r1")).where("_r0 < _r1").select("_band")
    rows = keep(placed.join(mixed, "_band").join(known.select("_rep", "_bits", "_bands"), "_rep"), "mixed")

    def meet(x: DataFrame, y: DataFrame) -> Column:
        apart = x["_rep"] != y["_rep"]
        first = F.get(F.array_intersect(x["_bands"], y["_bands"]), F.lit(0)) == x["_band"]
        return (x["_band"] == y["_band"]) & apart & (x["_root"] != y["_root"]) & (equal_fields(x["_bits"], y["_bits"]) >= least) & first

    x, y = rows, rows.select(*[F.col(c).alias(f"_y{c}") for c in rows.columns]).toDF(*rows.columns)  # columns of its own
    open_rows = keep(x.join(y, meet(x, y), "left_semi").select(*rows.columns), "open")
    wanted = open_rows.select(F.col("_rep").alias("_doc")).distinct()

    def start():
        shingles = shingler(size)
        return lambda batch: {"_set": [shingles(t.as_py()).view(np.int64) for t in batch.column(batch.schema.get_field_index("_text"))]}

    added = T.StructType([T.StructField("_set", T.ArrayType(T.LongType()))])
    texts = named(docs, wanted).dropDuplicates(["_doc"])
    sets = keep(map_arrow(texts, ["_doc", "_text"], added, start).select(F.col("_doc").alias("_rep"), "_set"), "sets")
    # members of a bucket meet in blocks: (i, j) holds the rows of its blocks i and j
    blocks = open_rows.groupBy("_band").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("_n"))
    own = F.pmod(F.xxhash64("_rep"), F.col("_n"))
    spread = open_rows.select("_band", "_rep", "_root").join(blocks, "_band").withColumn("_own", own)
    spread = spread.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    spread = spread.select("_band", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "_rep", "_root")
    parts = spread.join(sets, "_rep").groupBy("_band", "_i", "_j")
    return keep(parts.applyInPandas(lambda rows: _linked(rows, percent), "a long, b long").distinct(), "links")


def _linked(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Confirmed links between different components of one block.

    Intersection sizes are the product of the 0/1 matrix of sets and shared shingles with itself,
    summed over slices of its columns; whole numbers below 2^24 are exact.
    """
    sizes = rows["_set"].map(len).to_numpy()
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    _, column, count = np.unique(np.concatenate(rows["_set"].to_numpy()), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    use = shared[column]
    owner, column = owner[use], place[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(rows), len(rows)), np.float32)
    for start in range(0, int(shared.sum()), COLUMNS):
        low, high = np.searchsorted(column, [start, start + COLUMNS])
        cells = np.zeros((len(rows), COLUMNS), np.float32)
        cells[owner[low:high], column[low:high] - start] = 1
        common += cells @ cells.T
    root, rep = rows["_root"].to_numpy(), rows["_rep"].to_numpy()
    union = sizes[:, None] + sizes[None, :] - common
    a, b = np.nonzero((100 * common >= percent * union) & (root[:, None] != root[None, :]) & (rep[:, None] < rep[None, :]))
    return pd.DataFrame({"a": rep[a], "b": rep[b]})
