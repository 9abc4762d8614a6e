"""Helpers of the operators: reading, Arrow maps over batches, words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

# a word is a run without ASCII white space: blank, tab, line feed, vertical tab, form feed, return
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

MOST_BITS = 27  # powers of two: 16 MB

Batch = Callable[[pa.RecordBatch], dict[str, "pa.Array | list"]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, columns: list[str | Column], added: T.StructType, start: Callable[[], Batch]) -> DataFrame:
    """Columns of ``df`` followed by ``added`` ones that ``start()(batch)`` computes per Arrow batch.

    ``start`` runs once per task, for state such as tokenizers; the added names must be new.
    """
    rows = df.select(*columns)
    out = T.StructType(rows.schema.fields + added.fields)
    kinds = [(f.name, to_arrow_type(f.dataType)) for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            if batch.num_rows:
                new = step(batch)
                arrays = [a if isinstance(a := new[n], pa.Array) else pa.array(a, k) for n, k in kinds]
                yield pa.RecordBatch.from_arrays(list(batch.columns) + arrays, batch.schema.names + [n for n, _ in kinds])

    return rows.mapInArrow(run, out)


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[str]:
    """The texts of a batch one by one, null as empty."""
    for value in batch.column(batch.schema.get_field_index(name)):
        yield value.as_py() or ""


def may_be_in(rows: DataFrame, keys: DataFrame, on: list[str], bits: int = 8) -> DataFrame:
    """``rows`` and ``_may``: false if the row's ``on`` is certainly in no row of ``keys``.

    Tells rows that need no join apart before they are shuffled. The keys are marked in a bitmap of ``bits`` to twice
    as many a key, 2 to the power ``MOST_BITS`` at most, which is broadcast; fuller ones leave more rows to the join. ``keys`` is read twice.
    """
    n_bits = 1 << min(max((bits * keys.count()).bit_length(), 12), MOST_BITS)
    place = F.xxhash64(*on).bitwiseAND(n_bits - 1)
    word, bit = F.shiftright(place, 6), place.bitwiseAND(63).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    marks = keys.select(word.alias("_word"), one.alias("_one")).groupBy("_word").agg(F.bit_or("_one").alias("_marks"))
    found = rows.withColumns({"_at": word, "_bit": bit}).join(F.broadcast(marks), F.col("_at") == F.col("_word"), "left")
    return found.withColumn("_may", F.coalesce(F.getbit("_marks", F.col("_bit")), F.lit(0)) == 1).drop("_at", "_bit", "_word", "_marks")


def word_array(text: Column) -> Column:
    """Words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), GAP), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words without building them: starts of words."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def crc_remainder(key: Column, divisor: int) -> Column:
    """crc32 of the decimal text of a key, modulo; null counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor
