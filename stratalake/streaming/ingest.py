"""Incremental loading: new files go to bronze, and only their days are rebuilt in silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from stratalake.functions.dates import parse_ts
from stratalake.plans.silver import to_silver
from stratalake.sources.files import CORRUPT, SOURCE_FILE, bad_lines_path, has_input, parse_lines

DAY = "hearing_day"
BATCH = "batch_id"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # folder of rows without a day


def with_day(df: DataFrame) -> DataFrame:
    """Day of the hearing: all copies of a (case, hearing) key share it."""
    return df.withColumn(DAY, F.date_format(parse_ts(F.col("hearingDate")), "yyyy-MM-dd"))


def _write_days(df: DataFrame, path: str, *partition: str) -> None:
    (
        df.hint("rebalance", *partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*partition)
        .parquet(path)
    )


def _landed_type(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [*schema.fields, T.StructField(SOURCE_FILE, T.StringType()), T.StructField(DAY, T.StringType()), T.StructField(BATCH, T.LongType())]
    )


def read_bronze(spark: SparkSession, bronze: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(_landed_type(schema)).parquet(bronze)


def manifest_path(bronze: str) -> str:
    """Folder beside bronze that names the days of every landed batch."""
    return bronze.rstrip("/") + "_manifest"


def read_manifest(spark: SparkSession, bronze: str) -> DataFrame:
    """``hearing_day``, ``batch_id`` of all landed batches: which bronze folders there are."""
    return spark.read.schema(f"{DAY} string, {BATCH} long").parquet(manifest_path(bronze))


def _commit(spark: SparkSession, bronze: str, batch_id: int, days: list[str | None]) -> None:
    rows = spark.createDataFrame([(day,) for day in days], f"{DAY} string").coalesce(1)
    rows.write.mode("overwrite").parquet(f"{manifest_path(bronze)}/{BATCH}={batch_id}")


def read_days(spark: SparkSession, bronze: str, schema: T.StructType, days: list[str | None]) -> DataFrame:
    """Bronze rows of some days, from the folders the manifest names; other folders are not listed."""
    named = [d for d in days if d is not None]
    wanted = F.col(DAY).isin(named) if named else F.lit(False)
    if None in days:
        wanted = wanted | F.col(DAY).isNull()
    # as many folders as batches touched these days
    found = read_manifest(spark, bronze).filter(wanted).select(F.coalesce(DAY, F.lit(NO_DAY)), BATCH).distinct().collect()
    folders = [f"{bronze}/{DAY}={day}/{BATCH}={batch}" for day, batch in found]
    return spark.read.schema(_landed_type(schema)).option("basePath", bronze).parquet(*folders)


def read_bad_lines(spark: SparkSession, bronze: str) -> DataFrame:
    return spark.read.schema(f"{SOURCE_FILE} string, {CORRUPT} string, {BATCH} long").parquet(bad_lines_path(bronze))


def ingest_stream(
    spark: SparkSession,
    source_dir: str,
    bronze: str,
    schema: T.StructType | str,
    checkpoint: str,
    silver: str | None = None,
    max_files: int = 1000,
):
    """Load the files that arrived since the last run and stop.

    A micro-batch replaces its own (day, batch) folders, so a replay after a failure writes
    the same data again instead of twice. Its days are then written to the manifest
    (``read_manifest``), the record that the batch has landed. With ``silver`` given, the days a batch touched are
    rebuilt from bronze; other days are not read. Lines that are no JSON object go beside
    bronze (``bad_lines_path``), in a folder per batch.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = (
        spark.readStream.option("maxFilesPerTrigger", max_files)
        .text(source_dir)
        .select("value", F.col("_metadata.file_path").alias(SOURCE_FILE))
    )
    raw = parse_lines(lines, struct)

    def land(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        numbered = batch.withColumn(BATCH, F.lit(batch_id))
        good, bad = numbered.where(F.col(CORRUPT).isNull()).drop(CORRUPT), numbered.where(F.col(CORRUPT).isNotNull())
        _write_days(bad.select(SOURCE_FILE, CORRUPT, BATCH), bad_lines_path(bronze), BATCH)
        # the days of the batch are gathered while it is written: bounded by days, not by rows
        seen = Observation()
        day = F.coalesce(F.col(DAY), F.lit(""))
        _write_days(with_day(good).observe(seen, F.collect_set(day).alias("days")), bronze, DAY, BATCH)
        days = [d or None for d in seen.get["days"]]
        if not has_input(session, manifest_path(bronze)) and batch_id > 0:  # bronze of runs before there was a manifest
            for row in read_bronze(session, bronze, struct).filter(F.col(BATCH) < batch_id).groupBy(BATCH).agg(F.collect_set(day).alias("days")).collect():
                _commit(session, bronze, row[BATCH], [d or None for d in row.days])
        _commit(session, bronze, batch_id, days)
        if silver is not None:
            refresh_silver(session, bronze, silver, struct, days)

    return (
        raw.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_silver(
    spark: SparkSession, bronze: str, silver: str, schema: T.StructType, days: list[str | None]
) -> None:
    """Rebuild the silver folders of the given days."""
    if not days:
        return
    rebuilt = to_silver(read_days(spark, bronze, schema, days))
    _write_days(rebuilt.withColumn(DAY, F.date_format("hearing_timestamp", "yyyy-MM-dd")), silver, DAY)
