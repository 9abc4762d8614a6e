"""Training-data pipeline: quality, line dedup, near-dedup, mixing, BPE.

Every stage takes ``(spark, docs, sf_dir)`` with the columns of ``documents`` and works on all that
the stage before kept; all but the last return those columns. Rows that repeat a doc_id are
treated alike. Empty tables pass through as empty tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.llm import bpe, linedup, mixing, neardup, quality
from stratalake.llm.common import table
from stratalake.llm.queries import digest, vocabulary
from stratalake.session import configure, discard, keep, recorded, remove

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_LEFT: list[str] = []  # tables that earlier stages stored for themselves


def tidy(stage: Stage) -> Stage:
    """A stage that first deletes what earlier ones stored for themselves, unless its input still reads it."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles() if _LEFT else []
        for path in [p for p in _LEFT if not any(p in name for name in read)]:
            remove(spark, path)
            _LEFT.remove(path)
        with recorded() as paths:
            result = stage(configure(spark), docs, sf_dir)
        _LEFT.extend(paths)
        return result

    return run_stage


@tidy
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the classifier's cut."""
    docs = docs.select(COLUMNS)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, columns=COLUMNS).where(F.col("score") >= quality.CUT).select(COLUMNS)


@tidy
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat earlier ones; n_chars follows the text.

    Documents that lose lines and have no word left go; those that had none before stay.
    """
    rows = linedup.line_dedup(docs.select(COLUMNS))
    rows = rows.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return rows.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


@tidy
def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the smallest doc_id, null last, and one of rows that repeat it.

    Rows are numbered, so that the operator tells rows without an id and with a repeated one apart. The rows to
    drop are stored by number: unless they are very many, no text is shuffled to take them out.
    """
    docs = docs.select(COLUMNS)
    docs = keep(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    groups = neardup.near_duplicates(docs, key="_row").select("_row", "component_id")
    groups = keep(groups.join(docs.select("_row", "doc_id"), "_row"), "groups")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    first = groups.groupBy("component_id").agg(F.min_by("_row", order).alias("_first"), F.count(F.lit(1)).alias("_n"))
    gone = groups.join(first.where("_n > 1"), "component_id").where("_row != _first").select("_row")
    return docs.join(keep(gone, "gone"), "_row", "left_anti").select(COLUMNS)


@tidy
def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    The document at which a source's budget ends is repeated whole, so no text is cut; documents
    without words are taken once.
    """
    mixed = mixing.mix(docs.select(COLUMNS), carry=["text", "lang", "n_chars"])
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.ceil(F.col("taken") / F.col("size")).cast("int"))
    return mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times))).select(COLUMNS)


@tidy
def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each row's ids and of the text decoded from them."""
    words = vocabulary("word_bpe_49k.json")
    return digest(bpe.decode(bpe.encode(docs, words), words))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_stage),
    ("mixing sources to target weights", mix_stage),
    ("BPE encoding and decoding", bpe_stage),
]

# the classifier is no SQL expression: the stages are tested against brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is stored and read again by the next stage."""
    docs, before = table(spark, sf_dir, "documents"), None
    for place, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES):
            docs = keep(docs, "stage")
            if before is not None:
                discard(before)
            before = docs
    return docs
