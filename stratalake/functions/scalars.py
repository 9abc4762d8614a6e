"""Small scalar expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# fixed value: public page of a case
CASE_URL = "https://eapps.courts.state.va.us/ocis/details;fromOcis=true;fullcaseNumber="


def field(col: str) -> Column:
    """Null-safe access to a nested field by dotted path."""
    return F.col(col)


def yn_to_bool(col: Column) -> Column:
    """Y/N and true/false (text or Boolean) and the numbers 1/0 to Boolean, anything else null.

    Text is matched exactly, as the source mapping does: ``y``, ``TRUE`` and the text ``1`` are
    unknown.
    """
    text = col.cast("string")
    number = F.typeof(col) != "string"
    yes = text.isin("Y", "true") | (number & text.isin("1", "1.0"))
    no = text.isin("N", "false") | (number & text.isin("0", "0.0"))
    return F.when(yes, F.lit(True)).when(no, F.lit(False))


def safe_cast(col: Column, to: str) -> Column:
    """Cast that yields null instead of failing."""
    return col.try_cast(to)


def cast_failed(col: Column, to: str) -> Column:
    """True where a value is present but cannot be cast."""
    return col.isNotNull() & col.try_cast(to).isNull()


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def normalize_nulls(col: Column, null_like: Sequence, value=None) -> Column:
    """Replace every value of ``null_like`` by ``value``; ``None`` in the list means null."""
    plain = [v for v in null_like if v is not None]
    hit = col.isin(plain) if plain else F.lit(False)
    if None in null_like:
        hit = hit | col.isNull()
    return F.when(F.coalesce(hit, F.lit(False)), F.lit(value)).otherwise(col)


def label_when(condition: Column, yes: str, no: str) -> Column:
    """Two-way label; an unknown condition counts as no."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def is_code(col: Column, code: str = "D") -> Column:
    """Boolean flag for one code; null counts as false."""
    return F.coalesce(col == F.lit(code), F.lit(False))


def case_url(fips: Column, division: Column, number: Column, base: str = CASE_URL) -> Column:
    """Public page of one record."""
    return F.concat(F.lit(base), fips, division, number)


def flatten_lists(col: Column) -> Column:
    """Array of arrays to one array, skipping null parts."""
    return F.flatten(F.filter(col, lambda part: part.isNotNull()))
