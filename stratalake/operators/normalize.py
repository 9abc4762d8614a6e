"""From nested raw records to a flat table with a fixed, typed core."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalake.functions.dates import DATE_FORMAT, TIMESTAMP_FORMAT, epoch_ms_to_ts, parse_ts
from stratalake.functions.jsontext import complex_to_json, other_text, parse_json_text, text_types
from stratalake.functions.scalars import cast_failed, safe_cast, yn_to_bool

# The typed core of the flat layer.
GOLDEN_COLUMNS = {
    "qualified_fips": "string",
    "court_level": "string",
    "division_type": "string",
    "case_number": "string",
    "hearing_date": "timestamp",
    "filed_date": "timestamp",
    "is_appeal": "boolean",
    "appeal_date": "timestamp",
    "appeal_withdrawn_date": "timestamp",
    "arrest_date": "timestamp",
    "locality_name": "string",
    "locality_code": "integer",
    "case_category_code": "string",
    "case_sub_category_code": "string",
    "offense_date": "timestamp",
    "disposition_date": "timestamp",
    "fines_paid_date": "timestamp",
    "costs_paid_date": "timestamp",
    "dmv_license_restrictions_start_date": "timestamp",
    "is_active": "boolean",
    "is_criminal": "boolean",
    "is_traffic_fatality": "boolean",
    "is_dmv_alcohol_safety_action_code": "boolean",
    "commenced_by": "string",
}
SPARK_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampNTZType(),
    "boolean": T.BooleanType(),
    "integer": T.LongType(),
}
GOLDEN_SCHEMA = T.StructType([T.StructField(c, SPARK_TYPES[t]) for c, t in GOLDEN_COLUMNS.items()])

# Flattened source name -> name in the flat layer.
COLUMN_NAMES = {
    "date": "hearing_date",
    "case_charge_charge_filing_date": "filed_date",
    "appeal_case": "is_appeal",
    "appeal_case_appeal_date": "appeal_date",
    "appeal_case_appeal_withdrawn_date": "appeal_withdrawn_date",
    "case_charge_arrest_date": "arrest_date",
    "locality_locality_name": "locality_name",
    "locality_locality_code": "locality_code",
    "case_category_case_category_code": "case_category_code",
    "case_category_case_sub_category_code": "case_sub_category_code",
    "case_charge_offense_date": "offense_date",
    "disposition_disposition_info_disposition_date": "disposition_date",
    "financial_information_fines_paid_date_date": "fines_paid_date",
    "financial_information_costs_paid_date_date": "costs_paid_date",
    "dmv_information_driver_license_license_restrictions_start_date": "dmv_license_restrictions_start_date",
    "case_active_indicator_value": "is_active",
    "case_category_criminal_case_indicator": "is_criminal",
    "dmv_information_traffic_fatality": "is_traffic_fatality",
    "dmv_information_alcohol_safety_action_code": "is_dmv_alcohol_safety_action_code",
    "case_other_info_commenced_by_code": "commenced_by",
}

# Columns whose text has a time of day; all other golden timestamps hold a date only.
FORMATS = {"hearing_date": TIMESTAMP_FORMAT}


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def snake_case(name: str) -> str:
    """``caseTrackingID`` → ``case_tracking_id``."""
    text = re.sub(r"[ \-/]", "_", name.strip())
    # a capital starts a word after a small letter or digit, or as the last of a run of capitals
    text = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", text)
    return text.lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])


def flatten_structs(
    df: DataFrame, sep: str = "_", texts: dict[str, tuple[T.StructType, bool]] | None = None
) -> DataFrame:
    """Struct fields become columns, at any depth; arrays stay whole.

    Works on the schema alone: the plan is one projection. ``texts`` (``text_types``) names text
    columns whose JSON objects are flattened as well; their other values stay in the column.
    """

    def leaves(field: T.StructField, col: Column, name: str) -> list[Column]:
        if not isinstance(field.dataType, T.StructType):
            return [col.alias(name)]
        return [
            leaf
            for sub in field.dataType.fields
            for leaf in leaves(sub, col.getField(sub.name), f"{name}{sep}{sub.name}")
        ]

    def columns(field: T.StructField) -> list[Column]:
        col = _quoted(field.name)
        if field.name not in (texts or {}):
            return leaves(field, col, field.name)
        struct, others = texts[field.name]
        kept = [other_text(col, bool(struct.fields)).alias(field.name)] if others else []
        if not struct.fields:
            return kept
        return kept + leaves(T.StructField(field.name, struct), parse_json_text(col, struct), field.name)

    return df.select(*[leaf for f in df.schema.fields for leaf in columns(f)])


def dedupe_names(names: Sequence[str]) -> list[str]:
    """Number repeated names in column order: ``a, a_dup_1, a_dup_2``."""
    seen: Counter[str] = Counter()
    out = []
    for name in names:
        out.append(f"{name}_dup_{seen[name]}" if seen[name] else name)
        seen[name] += 1
    return out


def rename(df: DataFrame, names: dict[str, str] = COLUMN_NAMES) -> DataFrame:
    """Rename by map; names that collide get a suffix, the first column keeps the name."""
    return df.toDF(*dedupe_names([names.get(c, c) for c in df.columns]))


def _enforced(field: T.StructField, present: T.DataType | None, formats: dict[str, str], epoch_ms: bool) -> Column:
    target = field.dataType
    if present is None:
        return F.lit(None).cast(target).alias(field.name)
    col = _quoted(field.name)
    if isinstance(target, T.BooleanType):
        out = yn_to_bool(col) if isinstance(present, T.AtomicType) else F.lit(None).cast(target)
    elif isinstance(target, T.TimestampNTZType):
        if isinstance(present, T.StringType):
            out = parse_ts(col, formats.get(field.name, DATE_FORMAT))
        elif epoch_ms and isinstance(present, T.IntegralType):
            out = epoch_ms_to_ts(col)
        elif isinstance(present, (T.TimestampNTZType, T.DateType, T.TimestampType)):
            out = col.cast(target)
        else:
            out = F.lit(None).cast(target)  # only text is parsed by default
    elif isinstance(present, T.AtomicType):
        out = safe_cast(col, target.simpleString())
    else:
        out = F.to_json(col) if isinstance(target, T.StringType) else F.lit(None).cast(target)
    return out.alias(field.name)


def enforce_schema(
    df: DataFrame,
    schema: T.StructType = GOLDEN_SCHEMA,
    formats: dict[str, str] = FORMATS,
    epoch_ms: bool = False,
) -> DataFrame:
    """Cast the named columns, add missing ones as typed nulls, keep all others.

    A value that cannot be cast becomes null by itself; ``cast_failures`` counts those.
    ``epoch_ms`` also reads integer dates.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f for f in schema.fields}
    kept = [
        _enforced(wanted[c], present[c], formats, epoch_ms) if c in wanted else _quoted(c) for c in df.columns
    ]
    added = [_enforced(f, None, formats, epoch_ms) for f in schema.fields if f.name not in present]
    return df.select(*kept, *added)


def cast_failures(df: DataFrame, schema: T.StructType = GOLDEN_SCHEMA) -> DataFrame:
    """Values lost by number casts, one row per column, from a single pass."""
    present = {f.name: f.dataType for f in df.schema.fields}
    numeric = [
        f
        for f in schema.fields
        if isinstance(f.dataType, T.NumericType) and isinstance(present.get(f.name), T.StringType)
    ]
    counts = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.count_if(cast_failed(_quoted(f.name), f.dataType.simpleString())).alias("failed"),
        )
        for f in numeric
    ]
    if not counts:
        return df.sparkSession.createDataFrame([], "column string, failed bigint")
    return df.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def null_cols_to_string(df: DataFrame) -> DataFrame:
    """Columns without any type become text columns, so that every sink accepts them."""
    return df.select(
        *[
            _quoted(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.NullType) else _quoted(f.name)
            for f in df.schema.fields
        ]
    )


def normalize_cases(
    df: DataFrame, epoch_ms: bool = False, appeal_from_struct: bool = False
) -> DataFrame:
    """The whole flat layer as one projection, after one aggregate that finds JSON in text columns.

    ``appeal_from_struct`` sets ``is_appeal`` where an appeal block is present; the source
    mapping leaves it null because that block is never Y or N.
    """
    if appeal_from_struct and "appealCase" in df.columns:
        df = df.withColumn("isAppeal", F.col("appealCase").isNotNull())
    flat = rename(snake_case_columns(flatten_structs(df, texts=text_types(df))))
    return complex_to_json(null_cols_to_string(enforce_schema(flat, epoch_ms=epoch_ms)))
