"""Gold: four dimensions and the claims fact.

Keys are hashes of natural keys, computed alike on both sides, so loading the
fact needs no join and no shuffle.  A dimension reads only its own columns and
`distinct` combines before its shuffle, so a hot value costs one row per task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimstrata.functions.columns import date_key, surrogate_key, timestamp_or_now
from claimstrata.schemas import DIAGNOSIS_DESCRIPTION, FACT_COLUMNS

# Weekend days in Spark's numbering, 1 = Sunday.
_WEEKEND = (1, 7)


def build_dim_date(silver: DataFrame) -> DataFrame:
    """One row per service date."""
    # Names and formats of the calendar attributes.
    day, weekday = F.col("service_date"), F.dayofweek("service_date")
    return silver.select("service_date").distinct().select(
        date_key("service_date").alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        weekday.isin(*_WEEKEND).alias("is_weekend"),
    )


def build_dim_member(silver: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """One row per member and payer: a member of two payers has two rows."""
    return silver.select("member_id", "payer_id").distinct().select(
        surrogate_key("member_id").alias("member_key"),
        F.col("member_id").alias("member_id_hash"),
        "payer_id",
        timestamp_or_now(run_ts).alias("_updated_at"),
    )


def build_dim_provider(silver: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """One row per provider."""
    return silver.select("provider_id").distinct().select(
        surrogate_key("provider_id").alias("provider_key"),
        F.col("provider_id").alias("provider_id_hash"),
        timestamp_or_now(run_ts).alias("_updated_at"),
    )


def _plain_code(code: Column) -> Column:
    """An ICD-10 code without its dot, in upper case."""
    return F.replace(F.upper(F.trim(code)), F.lit("."), F.lit(""))


def describe_codes(codes: DataFrame, code: str, reference: DataFrame) -> DataFrame:
    """`codes` and the description of the longest prefix that the reference knows.

    `reference` has the columns icd10_prefix and description; dots and case do not
    matter, and of several descriptions of a prefix the smallest counts.  Each code
    is spread over its prefixes and meets the reference by equality: a few rows
    per code, and no join on a condition.  NULL where no prefix is known.
    """
    known = (
        reference.select(_plain_code(F.col("icd10_prefix")).alias("prefix"), "description")
        .where(F.col("prefix") != "")
        .groupBy("prefix")
        .agg(F.min("description").alias("description"))
    )
    plain, n = _plain_code(F.col(code)), F.col("n")
    spread = codes.select(code).distinct().where(plain != "").select(code, F.explode(F.sequence(F.lit(1), F.length(plain))).alias("n"))
    longest = (
        spread.withColumn("prefix", F.substr(plain, F.lit(1), n))
        .join(known, "prefix")
        .groupBy(code)
        .agg(F.max_by("description", "n").alias("description"))
    )
    return codes.join(longest, code, "left")


def build_dim_diagnosis(silver: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """One row per known diagnosis; the category is the code's first letter.

    With `reference` (see `describe_codes`), codes are described by it.
    """
    code = F.col("diagnosis_code")
    codes = silver.where(code.isNotNull()).select(code).distinct()
    described = codes.withColumn("description", F.lit(None).cast("string"))
    if reference is not None:
        described = describe_codes(codes, "diagnosis_code", reference)
    return described.select(
        code,
        surrogate_key("diagnosis_code").alias("diagnosis_key"),
        code.alias("icd10_code"),
        F.coalesce("description", F.lit(DIAGNOSIS_DESCRIPTION)).alias("description"),
        F.substring(code, 1, 1).alias("category"),
    )


def build_fact_claims(silver: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """One row per Silver claim."""
    derived = {
        "claim_key": surrogate_key("claim_id"),
        "member_key": surrogate_key("member_id"),
        "provider_key": surrogate_key("provider_id"),
        "date_key": date_key("service_date"),
        "diagnosis_key": surrogate_key("diagnosis_code"),
        "_gold_loaded_at": timestamp_or_now(run_ts),
    }
    return silver.withColumns(derived).select(*FACT_COLUMNS)
