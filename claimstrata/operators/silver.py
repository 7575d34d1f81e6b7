"""Silver: masking, standard codes, validation, deduplication, enrichment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimstrata.functions.columns import discount_rate, salted_hash, timestamp_or_now
from claimstrata.functions.rules import any_broken, broken_rule_names, claim_rules, flag_columns
from claimstrata.operators.bronze import latest_per_key
from claimstrata.schemas import DEFAULT_SALT, PII_FIELDS

ERRORS = "_validation_errors"
UNKNOWN = "unknown"


def mask_pii(
    df: DataFrame,
    salt: str = DEFAULT_SALT,
    fields: Sequence[str] = PII_FIELDS,
    preserve_null: bool = False,
) -> DataFrame:
    """Replace the identifiers that are present by their salted hash."""
    present = [f for f in fields if f in df.columns]
    return df.withColumns({f: salted_hash(f, salt, preserve_null) for f in present})


def standardize_codes(df: DataFrame) -> DataFrame:
    """Trim and case-fold codes, pad procedures to 5 digits, date without time."""
    folded = {f: F.lower(F.trim(f)) for f in ("claim_type", "claim_status")}
    return df.withColumns(
        {
            "service_date": F.to_date("service_date"),
            "diagnosis_code": F.upper(F.trim("diagnosis_code")),
            "procedure_code": F.lpad(F.trim("procedure_code"), 5, "0"),
            **folded,
        }
    )


def valid_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows for which every rule is known and none is broken."""
    return df.where(~any_broken(rules))


def quarantined_rows(
    df: DataFrame, rules: dict[str, Column], null_flags: str = "drop"
) -> DataFrame:
    """Rows that break a rule, with one flag per rule and the broken names.

    A row whose rules come out NULL (no rule broken, some undecided) is in
    neither side under `null_flags="drop"`; `"quarantine"` keeps it here
    with the error `unknown`, so that both sides add up to the input.
    """
    broken = any_broken(rules)
    names = broken_rule_names(list(rules))
    if null_flags == "drop":
        return df.where(broken).withColumns(flag_columns(rules)).withColumn(ERRORS, names)
    if null_flags == "quarantine":
        undecided = F.when(names == "", F.lit(UNKNOWN)).otherwise(names)
        kept = df.where(F.coalesce(broken, F.lit(True)))
        return kept.withColumns(flag_columns(rules)).withColumn(ERRORS, undecided)
    raise ValueError(f"null_flags must be 'drop' or 'quarantine', not {null_flags!r}")


def lost_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows in neither side when `null_flags="drop"`."""
    return df.where(any_broken(rules).isNull())


def apply_validation_rules(
    df: DataFrame, as_of: dt.date | None = None, null_flags: str = "drop"
) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) of standardised rows; `as_of` bounds service dates."""
    rules = claim_rules(as_of)
    return valid_rows(df, rules), quarantined_rows(df, rules, null_flags)


def apply_cdc_dedup(
    df: DataFrame, order_field: str = "_ingested_at", key: str | Sequence[str] = "claim_id"
) -> DataFrame:
    """Latest version of each claim across batches."""
    return latest_per_key(df, key, [order_field])


def is_tombstone() -> Column:
    """A row that says its claim is deleted."""
    return F.coalesce(F.col("_is_deleted"), F.lit(False))


def latest_not_deleted(
    df: DataFrame,
    rules: dict[str, Column],
    order_field: str = "_ingested_at",
    key: str | Sequence[str] = "claim_id",
) -> DataFrame:
    """Latest valid version of each claim, unless a tombstone is newer or as new.

    A tombstone needs only a claim id, the rules do not apply to it.  A version
    that comes after it brings the claim back.  Versions and tombstones meet in
    the one shuffle of the deduplication.
    """
    gone = is_tombstone()
    valid = F.coalesce(~any_broken(rules), F.lit(False))
    in_force = df.where(valid & ~gone | gone & F.col("claim_id").isNotNull())
    return latest_per_key(in_force, key, [order_field, "_is_deleted"]).where(~gone)


def enrich(df: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Calendar parts, discount rate, denial mark and processing time."""
    # Names of the derived columns.
    return df.withColumns(
        {
            "claim_year": F.year("service_date"),
            "claim_month": F.month("service_date"),
            "claim_quarter": F.quarter("service_date"),
            "discount_rate": discount_rate("billed_amount", "allowed_amount"),
            "is_denied": F.col("claim_status") == "denied",
            "_silver_processed_at": timestamp_or_now(run_ts),
        }
    )
