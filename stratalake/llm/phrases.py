"""Phrase collocations by a weighted de Bruijn graph (operator 11).

A text (A-Z lower-cased) is cut into pieces, a piece into words. Every word starts one edge: itself and
the three words after it, cut short where the piece ends. A whole edge runs from the node of its
first three words to that of its last three; a short one is the correction of a node at a piece's end.
Tasks add up equal edges before they leave, and send each bucket of edges as a few arrays.

Only the edges are counted. How often a shorter phrase occurs is the flow of the edges that start
with it, ends included: three words from edges, two from three, one from two. Words rank among the
counts of their language (null: ``und``).

Edges seen ``least`` times or more are joined to paths wherever they meet at a node with one way in and
one way out of the same weight; the windows of such a path, and three-word phrases, give the weight
of the longer phrases that a candidate lies in. Paths are kept in stretches of ``STRETCH`` edges;
edges on a ring without an entry stay single.

A bucket holds the edges of a pair of first words. Pairs that take a large share of a bounded sample
(``SAMPLE_ROWS`` rows; it decides only where rows go, never a count) are spread over all buckets by
their whole edges. Numbers of buckets follow ``spark.sql.shuffle.partitions``.

Results for special cases: null and blank texts have no words; rows that repeat count each time;
an empty table gives no rows; columns other than the text and the language are not looked at, so
their names do not matter. Texts of any length are read whole: edges leave a task whenever
``FLUSH_WORDS`` words are gathered.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.session import keep

MOST_WORDS = 4
FLUSH_WORDS = 2_000_000
ROW_EDGES = 8000  # of at most 32,000 different words, so numbers of words in a row are short
STRETCH = 64
SAMPLE_ROWS = 2000
HOT_SHARE = 500  # a pair is spread if it starts more than one in so many edges of the sample
ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)

EDGES = "lang string, bucket int, words string, w1 array<short>, w2 array<short>, w3 array<short>, w4 array<short>, n array<int>"
COUNTS = "lang string, size int, phrase string, f long"


class Words(dict):
    """Numbers of words from 1 on, in the order they are first met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


def _sorted_sums(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of four columns in their order, with the sums of ``n``."""
    size = int(max(c.max() for c in columns)) + 1
    first, pair = np.unique(columns[0].astype(np.int64) * size + columns[1], return_inverse=True)
    second, rest = np.unique(columns[2].astype(np.int64) * size + columns[3], return_inverse=True)
    key = pair * len(second) + rest
    order = np.argsort(key, kind="stable")
    key = key[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    first, second = first[key[start] // len(second)], second[key[start] % len(second)]
    return [first // size, first % size, second // size, second % size], np.add.reduceat(n[order], start)


def _edges_of(gathered: array) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct edges of a row of word numbers in which 0 ends a piece, with their counts."""
    s = np.concatenate([np.frombuffer(gathered, np.int32), np.zeros(3, np.int32)])
    at = np.flatnonzero(s[:-3])
    columns = [s[at], s[at + 1]]
    columns.append(np.where(columns[1] > 0, s[at + 2], 0))
    columns.append(np.where(columns[2] > 0, s[at + 3], 0))
    return _sorted_sums(columns, np.ones(len(at), np.int64))


def _packed(lang: str, words: Words, gathered: array, buckets: int, hot: set[bytes]) -> Iterator[tuple]:
    """Rows of ``EDGES``, one per bucket."""
    columns, n = _edges_of(gathered)
    hashes = np.array([0, *map(zlib.crc32, words)], np.uint64)
    mix = np.uint64(0x9E3779B97F4A7C15)
    key = hashes[columns[0]] * mix + hashes[columns[1]]
    if hot:
        named = np.array([0, *((words[a] << 32) + words[b] for a, b in (h.split(b" ") for h in hot) if a in words and b in words)], np.int64)
        spread = np.isin((columns[0] << 32) + columns[1], named)
        key = np.where(spread, (key * mix + hashes[columns[2]]) * mix + hashes[columns[3]], key)
    key *= mix
    bucket = ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket, columns, n = bucket[order], [c[order].astype(np.int32) for c in columns], n[order]
    texts = ["", *(w.decode() for w in words)]
    del key, order
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    starts = np.unique(np.concatenate([np.arange(a, b, ROW_EDGES) for a, b in zip(starts, [*starts[1:], len(bucket)])]))
    for low, high in zip(starts, [*starts[1:], len(bucket)]):
        used, places = np.unique(np.concatenate([np.zeros(1, np.int32), *(c[low:high] for c in columns)]), return_inverse=True)
        own = places[1:].reshape(MOST_WORDS, -1).astype(np.int16)
        yield lang, bucket[low], " ".join([texts[u] for u in used[1:]]), *own, n[low:high]


def edges(df: DataFrame, text: str, lang: str, buckets: int, hot: dict[str, list[str]]) -> DataFrame:
    """Edges added up within tasks, packed per bucket."""
    rows = df.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    hot_words = {name: {p.encode() for p in pairs} for name, pairs in hot.items()}
    names = [c.split()[0] for c in EDGES.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.string()] + [pa.list_(pa.int16())] * 4 + [pa.list_(pa.int32())]

    def batch(packed: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*packed), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[str, tuple[Words, array]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for name, (words, gathered) in state.items():
                if words:
                    packed = _packed(name, words, gathered, buckets, hot_words.get(name, set()))
                    while part := list(islice(packed, 4)):
                        yield batch(part)
            state.clear()

        waiting = 0
        for rows in batches:
            for name, value in zip(rows.column(0), rows.column(1)):
                value = value.as_py()
                if not value:
                    continue
                words, gathered = state.setdefault(name.as_py(), (Words(), array("i")))
                for piece in value.encode().lower().translate(ENDS).split(b"\n"):
                    found = piece.split()
                    if found:
                        gathered.extend(map(words.__getitem__, found))
                        gathered.append(0)
                        waiting += len(found)
                        if waiting >= FLUSH_WORDS:
                            yield from flush()
                            waiting = 0
                            words, gathered = state.setdefault(name.as_py(), (Words(), array("i")))
        yield from flush()

    return rows.mapInArrow(run, EDGES)


def _flows(packed: pa.Table, least: int, hot: dict[str, list[str]]) -> pa.Table:
    """Rows of ``COUNTS`` of one bucket: parts of the count of words and of spread pairs, the rest whole."""
    out: dict[str, list] = {"lang": [], "size": [], "phrase": [], "f": []}
    single: list[pa.Table] = []
    for lang in packed.column("lang").unique().to_pylist():
        rows = packed.filter(pa.compute.equal(packed.column("lang"), lang)).combine_chunks()
        lists = pa.compute.split_pattern(rows.column("words").combine_chunks(), " ")
        coded = lists.flatten().dictionary_encode()
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        codes, words = coded.indices.to_numpy() + 1, coded.dictionary
        shift = np.repeat(np.cumsum([0, *lists.value_lengths().to_numpy()[:-1]]), rows.column("n").combine_chunks().value_lengths().to_numpy())
        columns = []
        for name in ("w1", "w2", "w3", "w4"):
            own = rows.column(name).combine_chunks().flatten().to_numpy().astype(np.int64)
            columns.append(np.where(own > 0, codes[np.maximum(own - 1, 0) + shift], 0))
        columns, n = _sorted_sums(columns, rows.column("n").combine_chunks().flatten().to_numpy().astype(np.int64))
        texts = words.to_pylist()
        numbers = {t: i for i, t in enumerate(texts, 1)} if hot.get(lang) else {}
        pairs = [pair.split(" ") for pair in hot.get(lang, ())]
        spread = [numbers[a] * (len(texts) + 1) + numbers[b] for a, b in pairs if a in numbers and b in numbers]
        for size in range(MOST_WORDS, 0, -1):
            # rows are in the order of their words, so those of one phrase follow each other
            new = np.zeros(len(n), bool)
            new[0] = True
            for c in columns[:size]:
                new[1:] |= c[1:] != c[:-1]
            start = np.flatnonzero(new)
            columns, n = [c[start] for c in columns[:size]], np.add.reduceat(n, start)
            whole = columns[-1] > 0
            if size == 1:
                single.append(pa.table({"lang": pa.array([lang] * len(n)), "size": pa.array([1] * len(n), pa.int32()), "phrase": words.take(pa.array(columns[0] - 1)), "f": pa.array(n)}))
                break
            use = whole & (n >= least)
            if spread:
                use |= whole & np.isin(columns[0].astype(np.int64) * (len(texts) + 1) + columns[1], spread)
            for i in np.flatnonzero(use):
                out["lang"].append(lang)
                out["size"].append(size)
                out["phrase"].append(" ".join(texts[c[i] - 1] for c in columns))
                out["f"].append(n[i])
    kinds = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])
    return pa.concat_tables([pa.table(out, kinds), *(t.cast(kinds) for t in single)])


def counted(df: DataFrame, text: str, lang: str, least: int, hot: dict[str, list[str]] | None = None) -> DataFrame:
    """``lang``, ``size``, ``phrase``, ``f``: all words, and phrases of 2 to 4 words seen ``least`` times or more."""
    spread = hot or {}
    buckets = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # evens out partitions
    packed = edges(df, text, lang, buckets, spread)
    parts = packed.groupBy("bucket").applyInArrow(lambda rows: _flows(rows, least, spread), COUNTS)
    whole = parts.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return whole.where((F.col("size") == 1) | (F.col("f") >= least))


def hot_pairs(df: DataFrame, text: str, lang: str) -> dict[str, list[str]]:
    """Pairs of words that start a large share of a sample's edges: at most ``HOT_SHARE`` of them."""
    sample = df.sample(min(1.0, SAMPLE_ROWS / max(df.count(), 1)), seed=11)
    found = keep(counted(sample, text, lang, 30), "sample")
    total = found.where("size = 1").agg(F.sum("f")).first()[0] or 0
    hot: dict[str, list[str]] = {}
    for name, pair in found.where((F.col("size") == 2) & (F.col("f") * HOT_SHARE > total)).select("lang", "phrase").collect():
        hot.setdefault(name, []).append(pair)
    return hot


def first_words(phrase: str, n: int) -> Column:
    return F.substring_index(phrase, " ", n)


def last_words(phrase: str, n: int) -> Column:
    return F.substring_index(phrase, " ", -n)


def paths(grams: DataFrame) -> DataFrame:
    """``lang``, ``words`` (array), ``weight``: the edges joined to unary paths, in stretches."""
    node = MOST_WORDS - 1
    edge = grams.where(F.col("size") == MOST_WORDS).select("lang", "phrase", "f", first_words("phrase", node).alias("_from"), last_words("phrase", node).alias("_to"))
    ways_in = edge.groupBy("lang", F.col("_to").alias("_node")).agg(F.count("*").alias("_in"), F.min("phrase").alias("_before"), F.min("f").alias("_f_in"))
    ways_out = edge.groupBy("lang", F.col("_from").alias("_node")).agg(F.count("*").alias("_out"), F.min("phrase").alias("_after"), F.min("f").alias("_f_out"))
    unary = ways_in.join(ways_out, ["lang", "_node"]).where("_in = 1 and _out = 1 and _f_in = _f_out and _before <> _after")
    links = unary.select("lang", F.col("_after").alias("phrase"), F.col("_before").alias("_head"))
    # pointer doubling: _head is an edge _steps before this one on its path
    state = keep(edge.join(links, ["lang", "phrase"], "left").select("lang", "phrase", "f", "_head", F.when(F.col("_head").isNull(), 0).otherwise(1).alias("_steps"), F.col("_head").isNull().alias("_done")), "paths")
    left = state.where("not _done").count()
    while left:
        ahead = state.select("lang", F.col("phrase").alias("_head"), F.col("_head").alias("_next"), F.col("_steps").alias("_more"), F.col("_done").alias("_first"))
        joined = state.join(ahead, ["lang", "_head"], "left")
        moved = ~F.col("_done") & F.col("_next").isNotNull()  # else the edge ahead starts the path
        state = keep(
            joined.select(
                "lang", "phrase", "f", F.when(moved, F.col("_next")).otherwise(F.col("_head")).alias("_head"),
                F.when(moved, F.col("_steps") + F.col("_more")).otherwise(F.col("_steps")).alias("_steps"),
                (F.col("_done") | F.col("_first")).alias("_done"),
            ), "paths",
        )
        now = state.where("not _done").count()
        if now == left:  # only rings are left
            break
        left = now
    placed = state.select(
        "lang", "phrase", "f", F.when(F.col("_done"), F.coalesce("_head", "phrase")).otherwise(F.col("phrase")).alias("_head"),
        F.when(F.col("_done"), F.col("_steps")).otherwise(0).alias("_steps"),
    )
    parts = placed.groupBy("lang", "_head", F.floor(F.col("_steps") / STRETCH).alias("_part")).agg(
        F.sort_array(F.collect_list(F.struct("_steps", "phrase"))).alias("_edges"), F.first("f").alias("weight")
    )
    words = F.concat(F.split(F.col("_edges")[0]["phrase"], " "), F.transform(F.slice("_edges", 2, STRETCH), lambda e: F.substring_index(e["phrase"], " ", -1)))
    return parts.select("lang", words.alias("words"), "weight")


def _windows(table: DataFrame, words: Column, size: int, weight: str) -> DataFrame:
    """Windows of ``size`` words of longer sequences, each with the sequence's weight."""
    places = F.sequence(F.lit(1), F.size(words) - (size - 1))
    return table.select("lang", F.explode(F.transform(places, lambda i: F.array_join(F.slice(words, i, size), " "))).alias("phrase"), F.col(weight).alias("_longer"))


def collocations(
    df: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, scale: int = 2_000_000, percent: int = 80, most: int = 2000
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of each language's first phrases.

    ``score`` is the least floor(scale * a / (l + r)) over the cuts of a phrase. Phrases whose words
    lie in a longer one with at least ``percent`` of their count are left out.
    """
    counts = keep(counted(df, text, lang, least, hot_pairs(df, text, lang)), "phrases")
    total = counts.where("size = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    grams = keep(counts.where(F.col("f") >= least), "grams")
    chains = keep(paths(grams), "chains")
    threes = grams.where(F.col("size") == 3).select("lang", F.split("phrase", " ").alias("words"), "f")
    longer = _windows(chains, F.col("words"), 3, "weight").unionByName(_windows(chains, F.col("words"), 2, "weight"))
    longer = longer.unionByName(_windows(threes, F.col("words"), 2, "f")).groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    found = grams.where("size >= 2").join(longer, ["lang", "phrase"], "left")
    found = found.where(F.col("_longer").isNull() | (100 * wide("_longer") < percent * wide("f"))).select("lang", "phrase", "size", F.col("f").alias("a"))
    cuts = found.withColumn("_cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"_left": F.expr("substring_index(phrase, ' ', _cut)"), "_right": F.expr("substring_index(phrase, ' ', _cut - size)")})
    cuts = cuts.join(grams.select("lang", F.col("phrase").alias("_left"), F.col("f").alias("l")), ["lang", "_left"])
    cuts = cuts.join(grams.select("lang", F.col("phrase").alias("_right"), F.col("f").alias("r")), ["lang", "_right"])
    score = F.expr(f"cast(cast(a as decimal(20,0)) * cast({scale} as decimal(10,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as long)")
    cuts = cuts.withColumn("score", score)
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "_cut", "l", "r")).alias("_least"))
    scored = scored.select("lang", "phrase", "a", "_least.l", "_least.r", "_least.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
