"""JSON held in text columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

LOOKS_LIKE_JSON = r"^\s*[\{\[\"']"
# Python's spelling of the JSON constants, where a value may stand
PYTHON_CONSTANTS = {"None": "null", "True": "true", "False": "false"}


def looks_like_json(col: Column) -> Column:
    return col.rlike(LOOKS_LIKE_JSON)


# a quoted string with its escapes, a stretch without quotes, or a quote that is never closed
PIECES = r"""("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|[^"']+|["'])"""


def _as_json(col: Column) -> Column:
    """Python's constants as JSON's, outside quoted strings only."""

    def piece(text: Column) -> Column:
        plain = text
        for spelled, json_value in PYTHON_CONSTANTS.items():
            plain = F.regexp_replace(plain, rf"\b{spelled}\b", json_value)
        return F.when(text.rlike("^[\"']"), text).otherwise(plain)

    return F.array_join(F.transform(F.regexp_extract_all(col, F.lit(PIECES), F.lit(0)), piece), "")


def parse_json_text(col: Column, schema: T.DataType | str | None = None) -> Column:
    """Parse text that looks like JSON, accepting Python-style quotes and constants.

    With a schema the result has that type (null where the text is no JSON). Without one it
    is a VARIANT, and text that is not JSON stays as it was, as a VARIANT string.
    """
    rewritten = _as_json(col)
    direct = F.from_json(col, "variant")
    fallback = F.from_json(rewritten, "variant")
    if schema is None:
        return F.when(looks_like_json(col), F.coalesce(direct, fallback, col.cast("variant"))).otherwise(
            col.cast("variant")
        )
    return F.when(
        looks_like_json(col) & direct.isNotNull(), F.from_json(col, schema)
    ).when(looks_like_json(col) & fallback.isNotNull(), F.from_json(rewritten, schema))


def text_types(df: DataFrame) -> dict[str, tuple[T.StructType, bool]]:
    """Text columns that hold JSON, from one aggregate over all rows: the type of their objects
    (without fields if they hold none) and whether there are other values too."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return {}
    counts = []
    for i, name in enumerate(names):
        text = F.col("`" + name.replace("`", "``") + "`")
        parsed = F.when(looks_like_json(text), parse_json_text(text))
        is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT<"), F.lit(False))
        counts += [
            F.schema_of_variant_agg(F.when(is_object, parsed)).alias(f"t{i}"),
            F.count_if(looks_like_json(text)).alias(f"j{i}"),
            F.count_if(text.isNotNull() & ~is_object).alias(f"o{i}"),
        ]
    row = df.agg(*counts).first()
    found = {}
    for i, name in enumerate(names):
        if row[f"j{i}"]:
            kind = row[f"t{i}"] or ""
            ddl = re.sub(r"\bVOID\b", "STRING", re.sub(r"\bOBJECT<", "STRUCT<", kind))
            struct = T._parse_datatype_string(ddl) if re.match(r"OBJECT<.*\w", kind) else T.StructType()
            found[name] = struct, not struct.fields or row[f"o{i}"] > 0
    return found


def other_text(col: Column, objects: bool) -> Column:
    """JSON-looking text without its quotes, lists as JSON; null for objects if they go elsewhere."""
    parsed = parse_json_text(col)
    kind = F.schema_of_variant(parsed)
    out = F.when(~looks_like_json(col), col).when(kind == "STRING", parsed.cast("string"))
    return (out.when(kind.startswith("OBJECT<"), F.lit(None)) if objects else out).otherwise(F.to_json(parsed))


def complex_to_json(df: DataFrame) -> DataFrame:
    """Arrays, structs and maps become JSON text; other columns stay."""
    complex_types = (T.ArrayType, T.StructType, T.MapType, T.VariantType)
    return df.select(
        *[
            F.to_json(F.col(f"`{f.name}`"), {"ignoreNullFields": "false"}).alias(f.name)
            if isinstance(f.dataType, complex_types)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
