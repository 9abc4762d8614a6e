"""Record schemas: JSON Schema documents to Spark types, and inference for raw JSON lines."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F, types as T

SCALARS = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "integer": T.LongType(),
    "number": T.DoubleType(),
    "null": T.StringType(),
}

JSON_BLANKS = " \t\r\n"

# Only the blocks of a case record the layers read, not the whole record and no default:
# ``whole_schema`` adds what a schema document and the data have besides.
CASE_SCHEMA = """
qualifiedFips string, courtLevel string, divisionType string, caseNumber string,
formattedCaseNumber string, name string, offenseDate string, chargeAmended string,
codeSection string, chargeDesc string, caseType string, hearingDate string,
locality struct<localityName: string, localityCode: string>,
caseCategory struct<caseCategoryCode: string, caseSubCategoryCode: string, criminalCaseIndicator: string>,
caseActiveIndicator struct<value: string>,
caseCharge struct<chargeFilingDate: string, offenseDate: string, arrestDate: string>,
caseOtherInfo struct<commencedByCode: string>,
disposition struct<dispositionInfo: struct<dispositionDate: string, dispositionText: string>>,
sentencingInformation struct<
  sentence: struct<years: bigint, months: bigint, days: bigint, hours: bigint>,
  sentenceSuspended: struct<years: bigint, months: bigint, days: bigint, hours: bigint>>,
financialInformation struct<
  fines: struct<amount: struct<decimal: double>, imposedAmount: struct<decimal: double>>,
  costs: struct<amount: struct<decimal: double>>>,
caseParticipant array<struct<
  participantCode: string,
  contactInformation: struct<personName: struct<fullName: string>>,
  attorneyDetails: array<struct<
    attorneyBusinessName: struct<businessName: string>, judicialOfficialCategoryText: string>>,
  personalDetails: struct<race: string, gender: string>>>,
caseHearing array<struct<hearingDate: string, hearingType: string, hearingResult: string>>
"""


def record_schema(schema: dict) -> dict:
    """A schema of an array stands for its items: the files hold one item per line."""
    if schema.get("type") == "array" and "items" in schema:
        return schema["items"]
    return schema


def _type_of(node: dict) -> T.DataType:
    if "anyOf" in node:
        options = [o for o in node["anyOf"] if o.get("type") != "null"]
        return _type_of(options[0]) if len(options) == 1 else T.StringType()
    kind = node.get("type", "string")
    if isinstance(kind, list):
        named = [k for k in kind if k != "null"]
        if len(named) != 1:
            return T.StringType()
        kind = named[0]
    if kind == "object":
        fields = node.get("properties", {})
        return T.StructType([T.StructField(k, _type_of(v)) for k, v in fields.items()])
    if kind == "array":
        return T.ArrayType(_type_of(node.get("items", {})))
    return SCALARS[kind]


def struct_from_json_schema(schema: dict) -> T.StructType:
    """The Spark type of one record; every field is nullable since reads are tolerant."""
    struct = _type_of(record_schema(schema))
    if not isinstance(struct, T.StructType):
        raise ValueError("the record schema must describe an object")
    return struct


def _merged_type(lines: DataFrame, column: str) -> DataFrame:
    """The type of all JSON objects as text, in one row.

    An object is told by its first character, so a line is parsed once and its own type is not written out.
    Malformed lines parse to null, which has no type.
    """
    objects = lines.filter(F.ltrim(F.col(column), F.lit(JSON_BLANKS)).startswith("{"))
    return objects.agg(F.schema_of_variant_agg(F.try_parse_json(column)))


def infer_jsonl_schema(lines: DataFrame, column: str = "value") -> T.StructType:
    """Union of all keys over all lines, as one distributed aggregate.

    Works on records with repeated keys, where plain inference fails. Types are merged while
    rows are read: keys seen only with null and values of mixed kinds become strings, numbers
    with a fraction doubles.
    """
    found = _merged_type(lines, column).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return T.StructType()
    # quoted keys stay as they are
    ddl = re.sub(r"`(?:[^`]|``)*`|\bOBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], found)
    return _read_type(T._parse_datatype_string(ddl))


def _read_type(kind: T.DataType) -> T.DataType:
    """The type to read a field with whose values have the given one."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _read_type(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_read_type(kind.elementType))
    if isinstance(kind, T.DecimalType):
        return T.DoubleType() if kind.scale else T.LongType() if kind.precision <= 18 else T.DoubleType()
    return T.StringType() if isinstance(kind, (T.NullType, T.VariantType)) else kind


def merge_types(first: T.DataType, second: T.DataType) -> T.DataType:
    """A type that holds the values of both; fields of structs keep the order of their first mention."""
    if first == second:
        return first
    if isinstance(first, T.StructType) and isinstance(second, T.StructType):
        others = {f.name.lower(): f for f in second}
        merged = []
        for field in first:
            other = others.pop(field.name.lower(), field)
            merged.append(T.StructField(field.name, merge_types(field.dataType, other.dataType)))
        return T.StructType(merged + list(others.values()))
    if isinstance(first, T.ArrayType) and isinstance(second, T.ArrayType):
        return T.ArrayType(merge_types(first.elementType, second.elementType))
    nested = [t for t in (first, second) if isinstance(t, (T.StructType, T.ArrayType))]
    if len(nested) == 1:  # text and mixed types stand for unknown ones
        return nested[0]
    if isinstance(first, T.NumericType) and isinstance(second, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def _without_empty(kind: T.DataType) -> T.DataType:
    """Objects without known fields are read as their JSON text."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_without_empty(kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [T.StructField(f.name, _without_empty(f.dataType)) for f in kind]
        return T.StructType(fields) if fields else T.StringType()
    return kind


def whole_schema(lines: DataFrame, document: dict | None = None, column: str = "value") -> T.StructType:
    """The type of a whole case record: blocks the layers read, the schema document, all keys of the data."""
    kind = T.StructType.fromDDL(CASE_SCHEMA)
    if document is not None:
        kind = merge_types(kind, struct_from_json_schema(document))
    return _without_empty(merge_types(kind, infer_jsonl_schema(lines, column)))
