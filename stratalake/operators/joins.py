"""Joins. No side is forced to broadcast here unless its row count is bounded by the call;
otherwise Spark decides from measured sizes and splits skewed keys at run time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def outer_merge(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Full outer equi join with one key column."""
    return left.join(right, key, "full_outer")


def semi(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` with a partner."""
    return left.join(right, on, "left_semi")


def anti(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a partner."""
    return left.join(right, on, "left_anti")


def lookup(
    df: DataFrame, key_col: str, values, first: bool = False, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Rows whose key is among ``values`` (one value, a list, or a one-column frame).

    ``first`` returns a single row, made deterministic by the tie-break columns.
    """
    if isinstance(values, DataFrame):
        found = semi(df, values.toDF(key_col), key_col)
    else:
        wanted = list(values) if isinstance(values, (list, tuple, set)) else [values]
        keys = df.sparkSession.createDataFrame([(v,) for v in wanted], f"k {df.schema[key_col].dataType.simpleString()}")
        found = semi(df, keys.toDF(key_col), key_col)
    if first:
        found = found.orderBy(*[F.col(c).asc_nulls_last() for c in [key_col, *tiebreak]]).limit(1)
    return found


def court_for(df: DataFrame, courts: DataFrame, fips: str, key: str = "fipsCode4") -> DataFrame:
    """Court columns next to each row; a code without a court gives nulls."""
    return df.join(courts.withColumnRenamed(key, fips), fips, "left")


def enrich(stubs: DataFrame, details: DataFrame, key: Sequence[str]) -> DataFrame:
    """Stubs merged with their details; the details win on shared columns, and stubs
    without details drop out."""
    shared = [c for c in stubs.columns if c in details.columns and c not in key]
    joined = stubs.drop(*shared).join(details, list(key), "inner")
    extra = [c for c in details.columns if c not in stubs.columns]
    return joined.select(*stubs.columns, *extra)


def star(
    cases: DataFrame,
    courts: DataFrame,
    links: DataFrame,
    charges: DataFrame,
    court_key: str = "court_id",
    case_key: str = "case_id",
    charge_key: str = "charge_id",
) -> DataFrame:
    """Case → court, case → charge link → charge."""
    return (
        cases.join(courts, court_key, "left").join(links, case_key, "inner").join(charges, charge_key, "left")
    )


def all_courts(courts: DataFrame) -> DataFrame:
    """Every court row, in key order."""
    return courts.orderBy(courts.columns[0])
