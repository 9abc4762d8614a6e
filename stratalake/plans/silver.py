"""Silver: latest record per hearing, names hashed, dates typed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.functions.cases import first_defendant, net_sentence_days, total_financial
from stratalake.functions.dates import days_between_nonneg, parse_date, parse_date_lenient, parse_ts
from stratalake.functions.hashing import content_key, hash_in_array, hash_text, pick_in_array, with_lineage
from stratalake.operators.sequences import latest_per_key
from stratalake.sources.files import SOURCE_FILE

DEDUPE_KEY = ("caseNumber", "hearingDate")
ANONYMIZATION = "hashed_sha256"
PARTICIPANT_NAME = "contactInformation.personName.fullName"
PARTICIPANT_KEPT = {"role": "participantCode", "race": "personalDetails.race", "gender": "personalDetails.gender"}

# silver columns taken over unchanged, before and after the hashed and parsed ones
IDENTITY = ("qualifiedFips", "courtLevel", "divisionType", "caseNumber", "formattedCaseNumber")
INPUTS = (
    *IDENTITY, "name", "offenseDate", "chargeAmended", "codeSection", "chargeDesc", "caseType", "hearingDate",
    "locality", "caseParticipant", "financialInformation", "caseHearing", "disposition",
)


def to_silver(
    bronze: DataFrame,
    key: Sequence[str] = DEDUPE_KEY,
    order: str = SOURCE_FILE,
    tiebreak: Sequence[Column] | None = None,
) -> DataFrame:
    """The 18 silver columns in their fixed order.

    Only the columns and the parts of participants that are read enter the deduplication, so its
    sorts and its shuffle stay narrow; names are hashed behind it, as hashes do not compress.
    Copies within one file are told apart by their content unless a tie-break is given.
    """
    if tiebreak is None:
        tiebreak = [content_key(INPUTS)]
    narrow = bronze.withColumns(
        {
            "_offense": parse_date(F.col("offenseDate")),
            "_locality": F.col("locality.localityName"),
            "_people": pick_in_array(F.col("caseParticipant"), {"name": PARTICIPANT_NAME, **PARTICIPANT_KEPT}),
        }
    )
    latest = latest_per_key(narrow, key, order, tiebreak)
    silver = latest.select(
        *IDENTITY,
        hash_text(F.col("name")).alias("defendant_name_hash"),
        F.col("_offense").alias("offense_date"),
        "chargeAmended",
        "codeSection",
        "chargeDesc",
        "caseType",
        parse_ts(F.col("hearingDate")).alias("hearing_timestamp"),
        F.col("_locality").alias("locality_name"),
        hash_in_array(F.col("_people"), "name", {k: k for k in PARTICIPANT_KEPT}, "participant_hash").alias(
            "participants_anonymized"
        ),
        "financialInformation",
        "caseHearing",
        "disposition",
    )
    return with_lineage(silver, "anonymization_method", ANONYMIZATION)


def add_features(records: DataFrame) -> DataFrame:
    """Analysis features next to the raw record, all row-local expressions."""
    info = F.col("disposition.dispositionInfo")
    with_parts = records.withColumn("_defendant", first_defendant(F.col("caseParticipant")))
    disposed = parse_date_lenient(info.getField("dispositionDate"))
    offense = parse_date_lenient(F.col("offenseDate"))
    return with_parts.select(
        *[c for c in records.columns if c != "offenseDate"],
        info.getField("dispositionText").alias("dispositionText"),
        disposed.alias("dispositionDate"),
        offense.alias("offenseDate"),
        days_between_nonneg(offense, disposed).alias("daysToDisposition"),
        F.col("_defendant.race").alias("race"),
        F.col("_defendant.gender").alias("gender"),
        F.col("_defendant.attorneyType").alias("attorneyType"),
        total_financial(F.col("financialInformation")).alias("totalFinancial"),
        net_sentence_days(
            F.col("sentencingInformation.sentence"), F.col("sentencingInformation.sentenceSuspended")
        ).alias("netSentenceDays"),
        F.col("chargeDesc").alias("charge"),
    )


def to_flat_view(records: DataFrame) -> DataFrame:
    """The flat columns the exploratory reports read, from raw or bronze records.

    Attorneys are not part of silver, so the view is built from the record itself.
    """
    defendant = first_defendant(F.col("caseParticipant"))
    return records.withColumn("_defendant", defendant).select(
        "caseNumber",
        F.col("locality.localityName").alias("locality_name"),
        "chargeDesc",
        F.col("disposition.dispositionInfo.dispositionText").alias("disposition_text"),
        F.col("_defendant.race").alias("race"),
        F.col("_defendant.gender").alias("gender"),
        F.col("_defendant.attorneyType").alias("attorney_type"),
        F.col("financialInformation.fines.amount.decimal").alias("fine_amount"),
        parse_date(F.col("offenseDate")).alias("offense_date"),
        parse_ts(F.col("hearingDate")).alias("hearing_timestamp"),
        F.col("caseParticipant").alias("participants"),
    )


def disposition_fields(records: DataFrame) -> DataFrame:
    """Disposition text and parsed date from the nested block."""
    info = F.col("disposition.dispositionInfo")
    return records.withColumn("dispositionText", info.getField("dispositionText")).withColumn(
        "dispositionDate", parse_date_lenient(info.getField("dispositionDate"))
    )


def unnest(df: DataFrame, array_col: str, name: str = "element") -> DataFrame:
    """One row per array element; null and empty arrays give none."""
    rest = [c for c in df.columns if c != array_col]
    return df.select(*rest, F.explode(array_col).alias(name))
