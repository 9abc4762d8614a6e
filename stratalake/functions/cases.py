"""Expressions over the nested blocks of a case record."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the source analysis.
DAYS_PER_YEAR = 365
DAYS_PER_MONTH = 30
DEFENDANT = "DEF"
PUBLIC_DEFENDER = "Public Defender"
PRIVATE_OR_NONE = "Private/None"
PUBLIC_DEFENDER_MARKS = ("PD", "PUBLIC DEFENDER")
PUBLIC_DEFENDER_CATEGORY = "P"


def _zero(col: Column, to: str) -> Column:
    return F.coalesce(col.cast(to), F.lit(0).cast(to))


def duration_days(duration: Column) -> Column:
    """``{years, months, days}`` in days; a missing struct or part counts as 0."""
    return (
        _zero(duration.getField("years"), "bigint") * DAYS_PER_YEAR
        + _zero(duration.getField("months"), "bigint") * DAYS_PER_MONTH
        + _zero(duration.getField("days"), "bigint")
    )


def net_sentence_days(sentence: Column, suspended: Column) -> Column:
    """Sentence minus its suspended part, never below 0."""
    return F.greatest(F.lit(0).cast("bigint"), duration_days(sentence) - duration_days(suspended))


def total_financial(fin: Column) -> Column:
    """Imposed fines plus costs; missing parts count as 0."""
    fines = fin.getField("fines").getField("imposedAmount").getField("decimal")
    costs = fin.getField("costs").getField("amount").getField("decimal")
    return _zero(fines, "double") + _zero(costs, "double")


def attorney_type(attorneys: Column) -> Column:
    """Public defender if any attorney's firm or category says so."""

    def is_public(a: Column) -> Column:
        firm = F.upper(F.coalesce(a.getField("attorneyBusinessName").getField("businessName"), F.lit("")))
        by_category = F.coalesce(
            a.getField("judicialOfficialCategoryText") == PUBLIC_DEFENDER_CATEGORY, F.lit(False)
        )
        return firm.contains(PUBLIC_DEFENDER_MARKS[0]) | firm.contains(PUBLIC_DEFENDER_MARKS[1]) | by_category

    return F.when(
        F.coalesce(F.exists(attorneys, is_public), F.lit(False)), F.lit(PUBLIC_DEFENDER)
    ).otherwise(F.lit(PRIVATE_OR_NONE))


def first_defendant(participants: Column, code: str = DEFENDANT) -> Column:
    """Struct of race, gender and attorney type of the case's defendant.

    Each field is the first non-null one over the participants with that code, in array
    order; a case without such a participant gets nulls. The array already sits in the row,
    so no explode, shuffle or join back is needed.
    """
    matching = F.filter(participants, lambda p: p.getField("participantCode") == code)

    def facts(parts: Column) -> Column:
        # field access on an array gives the array of that field
        details = parts.getField("personalDetails")
        return F.struct(
            F.get(F.array_compact(details.getField("race")), F.lit(0)).alias("race"),
            F.get(F.array_compact(details.getField("gender")), F.lit(0)).alias("gender"),
            F.when(
                F.size(parts) > 0, attorney_type(F.get(parts, F.lit(0)).getField("attorneyDetails"))
            ).alias("attorneyType"),
        )

    # the one-element array binds the filtered list to a name, so it is built once
    return F.get(F.transform(F.array(matching), facts), F.lit(0))
