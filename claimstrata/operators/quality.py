"""Data-quality metrics of a claims frame, and the gate on them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimstrata.functions.rules import any_broken, claim_rules
from claimstrata.schemas import CLAIMS_SCHEMA, QUALITY_THRESHOLD, required_fields

METRICS = ("completeness", "uniqueness", "validity", "timeliness")
QUALITY_COUNTS = ("present", "unbroken", "on_time")


def _on_time(within_days: int) -> Column:
    service = F.col("service_date").cast("timestamp")
    return (F.col("ingestion_ts") >= service) & (
        F.col("ingestion_ts") <= service + F.make_dt_interval(days=F.lit(within_days))
    )


def quality_counts(broken: Column, within_days: int = 30) -> list[Column]:
    """Counts for the gate over standardised rows, to observe while they are read.

    A row whose rules are undecided is not valid: it does not reach Silver.
    """
    fields = required_fields(CLAIMS_SCHEMA)
    return [
        reduce(add, [F.count(f) for f in fields]).alias("present"),
        F.count_if(~broken).alias("unbroken"),
        F.count_if(_on_time(within_days)).alias("on_time"),
    ]


def input_metrics(rows: int, ids: int, counts: Mapping[str, int]) -> dict[str, float | None]:
    """The four percentages of the rows a run received; None without rows."""
    if not rows:
        return dict.fromkeys(METRICS)
    fields = len(required_fields(CLAIMS_SCHEMA))
    return {
        "completeness": 100 * counts["present"] / (rows * fields),
        "uniqueness": 100 * ids / rows,
        "validity": 100 * counts["unbroken"] / rows,
        "timeliness": 100 * counts["on_time"] / rows,
    }


def require_quality(
    metrics: Mapping[str, float | None], threshold: float = QUALITY_THRESHOLD
) -> dict[str, float]:
    """The metrics, or `ValueError` naming those that are missing or too low."""
    failed = [m for m in METRICS if metrics[m] is None or not metrics[m] >= threshold]
    if failed:
        raise ValueError(f"data quality checks failed: {', '.join(failed)}")
    return dict(metrics)


def dq_metrics(
    df: DataFrame,
    as_of: dt.date | None = None,
    within_days: int = 30,
    required: Sequence[str] | None = None,
) -> DataFrame:
    """One row of percentages over standardised claims, in one pass.

    completeness: non-NULL share of the required fields; uniqueness: distinct
    claim ids per row; validity: rows breaking no rule; timeliness: rows
    loaded on or after service and within `within_days`.  NULL if no rows.
    """
    fields = required_fields(CLAIMS_SCHEMA) if required is None else list(required)
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        reduce(add, [F.count(f) for f in fields]).alias("present"),
        F.count_distinct("claim_id").alias("ids"),
        F.count_if(~F.coalesce(any_broken(claim_rules(as_of)), F.lit(False))).alias("unbroken"),
        F.count_if(_on_time(within_days)).alias("on_time"),
    )

    def percent(part: str, times: int = 1):
        share = F.col(part).cast("double") * 100 / (F.col("rows") * times)
        return F.when(F.col("rows") > 0, share)

    return counts.select(
        "rows",
        percent("present", len(fields)).alias("completeness"),
        percent("ids").alias("uniqueness"),
        percent("unbroken").alias("validity"),
        percent("on_time").alias("timeliness"),
    )


def dq_gate(metrics: DataFrame, threshold: float = QUALITY_THRESHOLD) -> DataFrame:
    """Metrics plus the names of the failed ones and whether all passed.

    A NULL metric (no rows) fails.
    """
    failed = [
        F.when(~F.coalesce(F.col(m) >= threshold, F.lit(False)), F.lit(m)) for m in METRICS
    ]
    named = metrics.withColumn("failed_checks", F.concat_ws(", ", *failed))
    return named.withColumn("passed", F.col("failed_checks") == "")


def enforce_gate(metrics: DataFrame, threshold: float = QUALITY_THRESHOLD) -> dict[str, float]:
    """The metrics, or `ValueError` naming those below the threshold."""
    row = dq_gate(metrics, threshold).first()
    if not row["passed"]:
        raise ValueError(f"data quality checks failed: {row['failed_checks']}")
    return {m: row[m] for m in METRICS}
