"""Pseudonymisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def hash_text(col: Column) -> Column:
    """SHA-256 as lower-case hex; null stays null."""
    return F.sha2(col, 256)


def _path(root: Column, path: str) -> Column:
    for part in path.split("."):
        root = root.getField(part)
    return root


def pick_in_array(array: Column, fields: dict[str, str]) -> Column:
    """Rebuild every array element from some fields; the values of ``fields`` are dotted paths inside the element."""
    return F.transform(array, lambda x: F.struct(*[_path(x, path).alias(out) for out, path in fields.items()]))


def hash_in_array(array: Column, field: str, keep: dict[str, str], name: str) -> Column:
    """Rebuild every array element with one field hashed and some others kept.

    ``field`` and the values of ``keep`` are dotted paths inside the element.
    """
    return F.transform(
        array,
        lambda x: F.struct(
            hash_text(_path(x, field)).alias(name),
            *[_path(x, path).alias(out) for out, path in keep.items()],
        ),
    )


def with_lineage(df: DataFrame, name: str, value: str) -> DataFrame:
    """Add a constant column that says how the rows were treated."""
    return df.withColumn(name, F.lit(value))


def content_key(columns: Sequence[str]) -> Column:
    """64-bit digest of whole rows, for deterministic tie-breaks."""
    return F.xxhash64(*columns)
