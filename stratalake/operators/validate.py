"""JSON Schema checks over raw JSON lines.

A schema is compiled once, on the driver, into Column expressions over VARIANT; the size of
the expression follows the schema, not the data. Supported keywords: ``type`` (also lists),
``required``, ``properties``, ``items`` and ``anyOf``.
"""

from __future__ import annotations

import json
import logging
import re
from urllib.parse import unquote
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stratalake.sources.files import SOURCE_FILE, has_input
from stratalake.sources.schemas import record_schema

log = logging.getLogger(__name__)

DECODE = "decode"
NO_ERRORS = "array<string>"
# fixed limits of the sampling mode
SAMPLE_FILES = 5
SAMPLE_LINES = 1000
ERROR_LIMIT = 10

CHECKED = {"type", "required", "properties", "items", "anyOf"}
ANNOTATIONS = {"$schema", "$id", "title", "description", "examples", "default"}


class SchemaViolation(ValueError):
    """Raised by the gate when records break the schema."""


# VARIANT type names of the JSON scalars with one spelling
EXACT_KINDS = {"string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}


def _at(root: Column, where: str, to: str = "variant") -> Column:
    # null means missing (or of another type than ``to``); an explicit JSON null is a
    # VARIANT null, which is not SQL null
    return root if where == "$" and to == "variant" else F.try_variant_get(root, where, to)


def _step(where: str, name: str) -> str:
    return where + "['" + name.replace("'", "\\'") + "']"


def _is_number(value: Column, kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def _is_integer(value: Column, kind: Column) -> Column:
    number = F.try_variant_get(value, "$", "double")
    return (kind == "BIGINT") | (_is_number(value, kind) & (number % 1 == 0))


def _fits(root: Column, where: str, names: set[str]) -> Column:
    """Whether a value has one of the types; null where the value is missing."""
    value = _at(root, where)
    kind = F.schema_of_variant(value)
    exact = [EXACT_KINDS[n] for n in sorted(names) if n in EXACT_KINDS]
    tests = [kind.isin(*exact)] if exact else []
    if "integer" in names:
        tests.append(_is_integer(value, kind))
    if "number" in names:
        tests.append(_is_number(value, kind))
    # containers are recognised by a shallow cast, their type text would be built recursively
    if "object" in names:
        tests.append(_at(root, where, "map<string,variant>").isNotNull())
    if "array" in names:
        tests.append(_at(root, where, "array<variant>").isNotNull())
    fits = tests[0]
    for test in tests[1:]:
        fits = fits | test
    return fits if exact or "integer" in names or "number" in names else F.when(value.isNotNull(), fits)


def _errors(
    root: Column, schema: dict, path: str, where: str, nullable: bool = False
) -> tuple[list[Column], list[Column]]:
    """Checks of the value at ``where``: nullable error texts and arrays of error texts.

    All paths start at ``root`` (a record or an array element). A value below something that
    is missing or of another type is missing itself, so type checks need no gates; only
    ``required`` asks whether its parent is an object.
    """
    unknown = set(schema) - CHECKED - ANNOTATIONS
    if unknown:
        raise ValueError(f"unsupported schema keywords: {sorted(unknown)}")
    texts, lists = [], []
    if "type" in schema:
        names = set(schema["type"] if isinstance(schema["type"], list) else [schema["type"]])
        fits = _fits(root, where, names | ({"null"} if nullable else set()))
        texts.append(F.when(~fits, F.lit(f"type of {path or 'record'}")))
    prefix = f"{path}." if path else ""
    if schema.get("required"):
        missing = [
            F.when(_at(root, _step(where, name)).isNull(), F.lit(f"required {prefix}{name}"))
            for name in schema["required"]
        ]
        is_object = _at(root, where, "map<string,variant>").isNotNull()
        lists.append(F.when(is_object, F.array_compact(F.array(*missing))))
    for name, sub in schema.get("properties", {}).items():
        more = _errors(root, sub, f"{prefix}{name}", _step(where, name))
        texts += more[0]
        lists += more[1]
    if schema.get("items"):
        elements = _at(root, where, "array<variant>")
        lists.append(
            F.flatten(F.transform(elements, lambda x: compile_errors(x, schema["items"], f"{path}[]")))
        )
    if "anyOf" in schema:
        more = _any_of(root, schema["anyOf"], path, where)
        texts += more[0]
        lists += more[1]
    return texts, lists


def _any_of(root: Column, options: list[dict], path: str, where: str) -> tuple[list[Column], list[Column]]:
    others = [o for o in options if o.get("type") != "null"]
    if len(others) == 1 and len(options) == 2:
        # nullable value: report what is wrong inside it
        return _errors(root, others[0], path, where, nullable=True)
    failed = _at(root, where).isNotNull()
    for option in options:
        failed = failed & (F.size(_gather(*_errors(root, option, path, where))) > 0)
    return [F.when(failed, F.lit(f"anyOf of {path or 'record'}"))], []


def _gather(texts: list[Column], lists: list[Column]) -> Column:
    parts = [F.coalesce(part, F.array().cast(NO_ERRORS)) for part in lists]
    if texts:
        parts.append(F.array_compact(F.array(*texts)))
    if not parts:
        return F.array().cast(NO_ERRORS)
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def compile_errors(root: Column, schema: dict, path: str = "") -> Column:
    """Array of error texts of a VARIANT value that is present: missing keys, then types."""
    return _gather(*_errors(root, schema, path, "$"))


def validate_json(df: DataFrame, json_col: str, schema: dict) -> DataFrame:
    """Rows with ``errors`` (all broken rules) and ``error`` (the reported one, or null).

    Blank lines drop out. A line that is no JSON has the single error ``decode``.
    """
    lines = df.filter(F.trim(F.col(json_col)) != "").withColumn("_json", F.try_parse_json(json_col))
    errors = F.when(F.col("_json").isNull(), F.array(F.lit(DECODE))).otherwise(
        compile_errors(F.col("_json"), record_schema(schema))
    )
    return lines.withColumn("errors", errors).withColumn("error", F.get("errors", F.lit(0))).drop("_json")


def sample_files(
    spark: SparkSession, glob: str, n_files: int = SAMPLE_FILES, n_lines: int = SAMPLE_LINES
) -> DataFrame:
    """Leading lines of the first files by path (``0`` = no limit) with their line numbers.

    Spark keeps at most ``n_lines`` per file in every input split before the shuffle.
    """
    paths: str | list[str] = glob
    if n_files > 0:
        # names come from the file listing, so other files are not read
        listed = sorted(spark.read.text(glob).inputFiles())[:n_files]
        paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(name)) for name in listed]
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
    )
    if n_lines <= 0:
        return lines.drop("_block", "_seq")
    in_file = Window.partitionBy(SOURCE_FILE).orderBy("_block", "_seq")
    return (
        lines.withColumn("line", F.row_number().over(in_file).cast("bigint"))
        .filter(F.col("line") <= n_lines)
        .drop("_block", "_seq")
    )


def reported_errors(checked: DataFrame, limit: int = ERROR_LIMIT) -> DataFrame:
    """The errors a sequential check of the sampled files would report.

    A file is left at its first undecodable line, and at any error once more than ``limit``
    errors have been seen in total; later files then report one error each.
    """
    errors = checked.filter(F.col("error").isNotNull())
    undecodable = F.min(F.when(F.col("error") == DECODE, F.col("line"))).over(Window.partitionBy(SOURCE_FILE))
    errors = (
        errors.withColumn("_stop", undecodable)
        .filter(F.col("_stop").isNull() | (F.col("line") <= F.col("_stop")))
        .drop("_stop")
    )
    # the error that exceeds the limit: limit + 1 rows at most reach the driver
    head = errors.select(SOURCE_FILE, "line").orderBy(SOURCE_FILE, "line").limit(limit + 1).collect()
    if len(head) <= limit:
        return errors
    file, line = head[-1]
    first = F.min("line").over(Window.partitionBy(SOURCE_FILE))
    name = F.col(SOURCE_FILE)
    return (
        errors.withColumn("_first", first)
        .filter(
            (name < file)
            | ((name == file) & (F.col("line") <= line))
            | ((name > file) & (F.col("line") == F.col("_first")))
        )
        .drop("_first")
    )


def gate(violations: DataFrame, limit: int = 0) -> None:
    """Raise when more than ``limit`` rows carry an error."""
    failed = violations.agg(F.count_if(F.col("error").isNotNull())).first()[0]
    if failed > limit:
        raise SchemaViolation(f"schema validation failed: {failed} errors")


def validate_files(
    spark: SparkSession, glob: str, schema_path: str, n_files: int = 0, n_lines: int = 0
) -> DataFrame | None:
    """Check the files against a schema document and raise if any record breaks it.

    Returns the checked lines, or None when there are no files. Every line of every file is
    checked, unless ``n_files`` and ``n_lines`` ask for a sample.
    """
    text = read_text(spark, schema_path)
    if not has_input(spark, glob):
        log.warning("no files match %s, nothing to validate", glob)
        return None
    checked = validate_json(sample_files(spark, glob, n_files, n_lines), "value", json.loads(text))
    gate(checked)
    return checked


def read_text(spark: SparkSession, path: str) -> str:
    """Content of one small document, such as a schema."""
    if not has_input(spark, path):
        raise FileNotFoundError(f"schema not found: {path}")
    return spark.read.option("wholetext", True).text(path).first()[0]
