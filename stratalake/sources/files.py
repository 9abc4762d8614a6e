"""Scans and sinks. Reads use an explicit schema wherever raw JSON is involved."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from stratalake.sources.schemas import infer_jsonl_schema

CORRUPT = "_corrupt_record"
BAD_LINES = "n_bad_lines"
SOURCE_FILE = "source_file"
CHUNK = 100


def has_input(spark: SparkSession, glob: str) -> bool:
    """Whether at least one file matches, asked of the file system itself."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def as_struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def scan_jsonl(
    spark: SparkSession, glob: str, schema: T.StructType | str | None = None, seen: Observation | None = None
) -> DataFrame:
    """JSON lines of all matching files; a key missing in a file is null.

    Without a schema the union of all keys is found first. The path is given twice, as
    ``filename`` and ``source_file``, because both columns are part of the bronze layout.
    Lines that are no JSON object are no rows: ``scan_jsonl_tolerant`` gives them as well.
    """
    schema = infer_jsonl_schema(spark.read.text(glob)) if schema is None else schema
    good, _ = scan_jsonl_tolerant(spark, glob, schema, seen)
    rest = [c for c in good.columns if c != SOURCE_FILE]
    return good.select(*[F.col(f"`{c}`") for c in rest], F.col(SOURCE_FILE).alias("filename"), SOURCE_FILE)


def parse_lines(lines: DataFrame, schema: T.StructType | str, column: str = "value") -> DataFrame:
    """Parse a text column of JSON lines; blank lines drop out.

    Adds ``_corrupt_record`` with the raw line where it is no JSON object. A value of the
    wrong type only nulls its own field.
    """
    struct = as_struct(schema)
    with_mark = T.StructType([*struct.fields, T.StructField(CORRUPT, T.StringType())])
    typed = F.from_json(column, with_mark, {"columnNameOfCorruptRecord": CORRUPT})
    # a filter on the marks would parse every line once more below a projection, but cannot go below an explode
    parsed = lines.filter(F.trim(F.col(column)) != "").withColumn("_parsed", F.explode(F.array(typed)))
    flagged = F.col(f"_parsed.{CORRUPT}")
    # only lines the typed parser objected to are parsed a second time
    not_object = ~F.coalesce(
        F.schema_of_variant(F.try_parse_json(column)).startswith("OBJECT"), F.lit(False)
    )
    rest = [c for c in lines.columns if c != column]
    return parsed.select(
        *[F.col(f"_parsed.`{f.name}`") for f in struct],
        *rest,
        F.when(flagged.isNotNull() & not_object, F.col(column)).alias(CORRUPT),
    )


def scan_jsonl_tolerant(
    spark: SparkSession, glob: str, schema: T.StructType | str, seen: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """Good rows and bad lines, each with the file they came from.

    ``seen`` gets the number of bad lines (``BAD_LINES``) when the good rows are computed.
    """
    lines = spark.read.text(glob).select("value", F.col("_metadata.file_path").alias(SOURCE_FILE))
    parsed = parse_lines(lines, schema)
    counted = parsed if seen is None else parsed.observe(seen, F.count(CORRUPT).alias(BAD_LINES))
    good = counted.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = parsed.filter(F.col(CORRUPT).isNotNull()).select(SOURCE_FILE, CORRUPT)
    return good, bad


def bad_lines_path(layer: str) -> str:
    """Folder beside a layer with the lines its build set aside."""
    return layer.rstrip("/") + "_bad_lines"


def store_bad_lines(bad: DataFrame, layer: str) -> int:
    """Write the bad lines of a layer beside it; returns how many there are."""
    path = bad_lines_path(layer)
    write_layer(bad, path)
    return bad.sparkSession.read.parquet(path).count()


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a layer with ZSTD Parquet."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_by_date(df: DataFrame, path: str, date_col: str) -> None:
    """One folder per day; only the days present in ``df`` are replaced.

    The rebalance hint lets Spark size the files and split a day that is much larger than
    the others over several tasks.
    """
    date = F.col(date_col)
    dated = df.select(
        "*",
        F.date_format(date, "yyyy").alias("year"),
        F.date_format(date, "MM").alias("month"),
        F.date_format(date, "dd").alias("day"),
    )
    (
        dated.hint("rebalance", "year", "month", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("year", "month", "day")
        .parquet(path)
    )


def append_records(df: DataFrame, path: str, chunk: int | None = None) -> None:
    """Append rows as JSON lines; ``chunk`` limits the records of one file (the source
    system appends in groups of ``CHUNK``)."""
    writer = df.write.mode("append")
    (writer.option("maxRecordsPerFile", chunk) if chunk else writer).json(path)


def scan_batches(spark: SparkSession, glob: str) -> DataFrame:
    """Raw lines of files named ``<date>_batch_<n>…`` with date, batch name and line position."""
    path = F.col("_metadata.file_path")
    return spark.read.text(glob).select(
        "value",
        F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})_batch_\d+", 1).alias("date"),
        F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2}_batch_\d+)", 1).alias("batch"),
        F.col("_metadata.file_path").alias("part_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
    )


def compact_by_date(
    spark: SparkSession, glob: str, out: str, order: Sequence[Column] | None = None, drop_parts: bool = False
) -> None:
    """Merge batch files into one folder per date, batches in name order.

    Range partitioning on (date, order) keeps the order across files and spreads a large
    date over many tasks; the part numbers of the written files follow the order.
    Only the dates that occur are replaced. ``drop_parts`` removes, after the write, the files
    that were read; a file name without a date is refused before anything is written.
    """
    rows = scan_batches(spark, glob)
    parts = rows.inputFiles()
    unnamed = [p for p in parts if not re.search(r"\d{4}-\d{2}-\d{2}_batch_\d+", p)]
    if unnamed:
        raise ValueError(f"{len(unnamed)} files have no date in their names, the first: {unnamed[0]}")
    order = list(order or [F.col("batch"), F.col("part_file"), F.col("block_start"), F.col("line_id")])
    (
        rows.repartitionByRange(F.col("date"), *order)
        .sortWithinPartitions(F.col("date"), *order)
        .select("value", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .text(out)
    )
    if drop_parts:
        delete_files(spark, parts)


def delete_files(spark: SparkSession, names: Sequence[str]) -> int:
    """Remove files by name; returns how many there were."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name)) for name in names]
    return sum(bool(path.getFileSystem(conf).delete(path, False)) for path in paths)


def scan_dim_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV dimension with a header; all columns are text unless a schema is given."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def scan_dim_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A file holding one JSON array of records; codes stay text by schema."""
    return spark.read.option("multiLine", True).schema(schema).json(path)


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all frames; columns one of them lacks are null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def concat_pages(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Pages of one result, same layout, one after the other."""
    for other in others:
        first = first.union(other)
    return first
