"""The layer jobs and the run over all of them."""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, types as T

from stratalake.operators.aggregates import GOLD_TABLES
from stratalake.operators.normalize import normalize_cases
from stratalake.operators.validate import read_text, validate_files
from stratalake.plans.silver import to_silver
from stratalake.session import configure
from stratalake.sources.files import BAD_LINES, SOURCE_FILE, has_input, scan_jsonl, scan_jsonl_tolerant, scan_parquet, store_bad_lines, write_by_date, write_layer
from stratalake.sources.schemas import infer_jsonl_schema, whole_schema

log = logging.getLogger(__name__)


@dataclass
class LayerPaths:
    raw_glob: str
    bronze: str
    silver: str
    gold: str
    schema_json: str | None = None


def build_bronze(
    spark: SparkSession, raw_glob: str, out: str, schema: T.StructType | str | None = None
) -> DataFrame | None:
    """Raw JSON lines to Parquet, one row for each JSON object; nothing is written when no file matches.

    Lines that are no JSON object are counted while the layer is written; if there are any, the files are
    read once more to store them beside it (``bad_lines_path``).
    """
    if not has_input(spark, raw_glob):
        log.warning("no files match %s, bronze is left as it is", raw_glob)
        return None
    if schema is None:
        schema = infer_jsonl_schema(spark.read.text(raw_glob))
    seen = Observation()
    write_layer(scan_jsonl(spark, raw_glob, schema, seen), out)
    _, bad = scan_jsonl_tolerant(spark, raw_glob, schema)
    if n_bad := store_bad_lines(bad if seen.get[BAD_LINES] else bad.limit(0), out):
        log.warning("%d lines of %s are no JSON object", n_bad, raw_glob)
    return scan_parquet(spark, out)


def ingest_by_date(
    spark: SparkSession, raw_glob: str, out: str, schema: T.StructType | str | None = None, date: str = "hearing_date"
) -> DataFrame | None:
    """The per-date ingest: good lines flattened into the typed core, one Parquet folder a day.

    Bad lines are counted and stored beside the layer. Only the days that occur are replaced.
    Columns that this run has and older days lack are null there.
    """
    if not has_input(spark, raw_glob):
        log.warning("no files match %s, %s is left as it is", raw_glob, out)
        return None
    if schema is None:
        schema = infer_jsonl_schema(spark.read.text(raw_glob))
    good, bad = scan_jsonl_tolerant(spark, raw_glob, schema)
    write_by_date(normalize_cases(good.drop(SOURCE_FILE)), out, date)
    if n_bad := store_bad_lines(bad, out):
        log.warning("%d lines of %s are no JSON object", n_bad, raw_glob)
    return spark.read.option("mergeSchema", True).parquet(out)


def build_silver(spark: SparkSession, bronze: str, out: str) -> DataFrame:
    write_layer(to_silver(scan_parquet(spark, bronze)), out)
    return scan_parquet(spark, out)


def build_gold(spark: SparkSession, silver: str, out: str) -> dict[str, DataFrame]:
    """The six aggregate tables, each as a Parquet folder below ``out`` and as a view.

    Every table reads only its own columns of silver.
    """
    records = scan_parquet(spark, silver)
    records.createOrReplaceTempView("silver_cases")
    tables = {}
    for name, build in GOLD_TABLES.items():
        write_layer(build(records), f"{out}/{name}")
        tables[name] = scan_parquet(spark, f"{out}/{name}")
        tables[name].createOrReplaceTempView(name)
    return tables


def run_layers(
    spark: SparkSession,
    paths: LayerPaths,
    schema: T.StructType | str | None = None,
    n_files: int = 0,
    n_lines: int = 0,
) -> dict[str, DataFrame]:
    """Validate, then bronze, silver and gold; the first failure stops the run.

    Without a schema, bronze has every field of the schema document and of the data.
    """
    configure(spark)
    if paths.schema_json:
        validate_files(spark, paths.raw_glob, paths.schema_json, n_files, n_lines)
    if schema is None and has_input(spark, paths.raw_glob):
        document = json.loads(read_text(spark, paths.schema_json)) if paths.schema_json else None
        schema = whole_schema(spark.read.text(paths.raw_glob), document)
    built = {"bronze": build_bronze(spark, paths.raw_glob, paths.bronze, schema)}
    if not has_input(spark, paths.bronze):
        raise FileNotFoundError(f"bronze layer missing: {paths.bronze}")
    built["silver"] = build_silver(spark, paths.bronze, paths.silver)
    if not has_input(spark, paths.silver):
        raise FileNotFoundError(f"silver layer missing: {paths.silver}")
    built.update(build_gold(spark, paths.silver, paths.gold))
    return built
