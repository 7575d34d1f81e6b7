"""Silver: one month of Bronze cleaned, or the whole table.

Steps are row-wise except deduplication, so their order is free as long as
the rules see what they would see after masking.  Hashing comes last: the
shuffles then carry short raw ids instead of 64-character digests, and rows
that are dropped as invalid or older are never hashed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimstrata.functions.rules import any_broken, claim_rules
from claimstrata.operators.quality import QUALITY_COUNTS, quality_counts
from claimstrata.operators.silver import (
    apply_cdc_dedup,
    enrich,
    is_tombstone,
    latest_not_deleted,
    mask_pii,
    quarantined_rows,
    standardize_codes,
    valid_rows,
)
from claimstrata.operators.sinks import append, balanced, replace_all, replace_batch, replace_month, replace_slices
from claimstrata.plans.bronze import months_of_batch
from claimstrata.plans.layers import Layers
from claimstrata.schemas import CODE_FIELDS, DEFAULT_SALT, SILVER_PARTITIONS
from claimstrata.sources.layers import bronze_month, bronze_months


@dataclass(frozen=True)
class SilverOptions:
    """Choices of a Silver run.

    `as_of` is the last allowed service date (today if unset).  `null_flags`
    and `preserve_null` are described at `quarantined_rows` and `salted_hash`.
    `deletes` lets Bronze rows with a delete mark remove their claim.
    """

    as_of: dt.date | None = None
    run_ts: dt.datetime | None = None
    salt: str = DEFAULT_SALT
    null_flags: str = "drop"
    preserve_null: bool = False
    order_field: str = "_ingested_at"
    deletes: bool = False

    def rules(self) -> dict[str, Column]:
        return claim_rules(self.as_of, members_hashed=not self.preserve_null)

    def mask(self, df: DataFrame) -> DataFrame:
        return mask_pii(df, self.salt, preserve_null=self.preserve_null)


def silver_rows(
    bronze: DataFrame,
    options: SilverOptions,
    partitions: tuple[str, ...] = (),
    key: str | Sequence[str] = "claim_id",
) -> DataFrame:
    """Clean claims; with `partitions`, gathered by them for writing.

    A claim is kept once for each `key`.
    """
    standard, rules = standardize_codes(bronze), options.rules()
    if options.deletes:
        latest = latest_not_deleted(standard, rules, options.order_field, key)
    else:
        latest = apply_cdc_dedup(valid_rows(standard, rules), options.order_field, key)
    return options.mask(enrich(balanced(latest, partitions, CODE_FIELDS), options.run_ts))


def quarantine_rows(bronze: DataFrame, options: SilverOptions) -> DataFrame:
    """Masked, standardised rows that break a rule, with flags and reasons."""
    rejected = quarantined_rows(standardize_codes(bronze), options.rules(), options.null_flags)
    return options.mask(rejected)


def run_silver(
    spark: SparkSession,
    layers: Layers,
    year: int | None = None,
    month: int | None = None,
    options: SilverOptions = SilverOptions(),
    once: bool = False,
) -> dict[str, Any]:
    """Clean one Bronze month into Silver, replacing that month.

    Without year and month the whole Bronze table is cleaned in one job and
    Silver is overwritten: a backfill, where a claim is kept once overall
    rather than once per service month.  Two writes, no other action: the
    quarantine write sees every input row in its only stage and counts there,
    for `quality` as well: counts over the rows received, before any is set
    aside, dropped as a copy or hashed.

    With `options.deletes`, tombstones are no such rows.  One with a service date
    takes effect when its month is run, one without in every run.

    `once` stores the quarantined rows by the months of the run, in place of those
    that an earlier run over the same months stored.
    """
    if (year is None) != (month is None):
        raise ValueError("give both year and month, or neither")
    options = _pinned(spark, options)
    bronze = layers.table("bronze")
    rows = spark.table(bronze) if year is None else bronze_month(spark, bronze, year, month)
    received = rows
    if options.deletes and year is not None:
        rows = rows.unionByName(_undated_tombstones(spark, bronze))

    def store_aside(rejected: DataFrame) -> int:
        aside, path = layers.table("quarantine"), layers.path("quarantine")
        if not once:
            return append(rejected, aside, path=path)
        scope = "all" if year is None else _scope(year, month)
        return replace_batch(rejected.withColumn("_scope", F.lit(scope)), aside, scope, ("_scope",), path)

    def store(clean: DataFrame) -> int:
        target, path = layers.table("silver"), layers.path("silver")
        if year is None:
            return replace_all(clean, target, SILVER_PARTITIONS, path)
        return replace_month(clean, target, year, month, SILVER_PARTITIONS, path)

    return _clean(received, rows, "claim_id", options, store_aside, store)


def run_silver_months(
    spark: SparkSession,
    layers: Layers,
    months: Sequence[tuple[int, int]],
    options: SilverOptions = SilverOptions(),
    once: bool = False,
) -> dict[str, Any]:
    """Clean several Bronze months at once: the rows of one run for each, in one write.

    Only the files of these months are opened.  A claim is kept once per service month,
    an undated tombstone acts in each.  Months and payers that lost all their claims are
    emptied.  The counts are totals; `months` has the rows written of each.
    """
    months = sorted(set(months))
    options = _pinned(spark, options)
    bronze = layers.table("bronze")
    received = rows = bronze_months(spark, bronze, months)
    if options.deletes and months:
        # A row per tombstone and month of the run: both are few.
        each = F.explode(F.array(*[F.struct(F.lit(y).alias("year"), F.lit(m).alias("month")) for y, m in months]))
        undated = _undated_tombstones(spark, bronze).withColumn("_of", each)
        undated = undated.withColumns({c: F.col(f"_of.{c}").cast(rows.schema[c].dataType) for c in ("year", "month")})
        rows = rows.unionByName(undated.drop("_of"))
    written: dict[tuple[int, int], int] = {}

    def store_aside(rejected: DataFrame) -> int:
        aside, path = layers.table("quarantine"), layers.path("quarantine")
        if not once:
            return append(rejected, aside, path=path)
        scoped = rejected.withColumn("_scope", F.format_string("%d-%02d", "year", "month"))
        return sum(replace_slices(scoped, aside, [(_scope(y, m),) for y, m in months], ("_scope",), path).values())

    def store(clean: DataFrame) -> int:
        target, path = layers.table("silver"), layers.path("silver")
        written.update(replace_slices(clean, target, months, SILVER_PARTITIONS, path))
        return sum(written.values())

    summary = _clean(received, rows, ("claim_id", "year", "month"), options, store_aside, store)
    return summary | {"months": written}


def _scope(year: int, month: int) -> str:
    return f"{year}-{month:02d}"


def _undated_tombstones(spark: SparkSession, bronze: str) -> DataFrame:
    undated = F.col("year").isNull() | F.col("month").isNull()
    return spark.table(bronze).where(undated & is_tombstone())


def _clean(
    received: DataFrame,
    rows: DataFrame,
    key: str | Sequence[str],
    options: SilverOptions,
    store_aside: Callable[[DataFrame], int],
    store: Callable[[DataFrame], int],
) -> dict[str, Any]:
    """Store the quarantine of `received` and Silver of `rows`; the counts of both."""
    if options.deletes:
        received = received.where(~is_tombstone())
    broken, seen = any_broken(options.rules()), Observation()
    watched = standardize_codes(received).observe(
        seen,
        F.count(F.lit(1)).alias("input"),
        F.count_if(broken.isNull()).alias("undecided"),
        *quality_counts(broken),
    )
    rejected = options.mask(quarantined_rows(watched, options.rules(), options.null_flags))
    quarantined = store_aside(rejected)
    written = store(silver_rows(rows, options, partitions=("year", "month", "payer_id"), key=key))
    counts = seen.get
    lost = counts.get("undecided", 0) if options.null_flags == "drop" else 0
    return {
        "input_records": counts.get("input", 0),
        "output_records": written,
        "quarantined": quarantined,
        "undecided": lost,
        "quality": {name: counts.get(name, 0) for name in QUALITY_COUNTS},
        "status": "SUCCESS",
    }


def rerun_touched(
    spark: SparkSession, layers: Layers, batch: str, options: SilverOptions = SilverOptions(), once: bool = False
) -> dict[tuple[int, int], int]:
    """Re-run every month that a Bronze batch has claims for; rows written of each.

    A daily run cleans its own month only; this is the way to bring late
    claims into Silver, all months in one job.  The months come from the batch
    log, so only their files are opened; the driver sees month numbers, nothing else.
    """
    months = months_of_batch(spark, layers, batch)
    return run_silver_months(spark, layers, months, options, once)["months"] if months else {}


def _pinned(spark: SparkSession, options: SilverOptions) -> SilverOptions:
    """Fix today's date once, so both writes of a run agree across midnight."""
    if options.as_of is not None:
        return options
    today = spark.range(1).select(F.current_date().alias("today")).first()["today"]
    return SilverOptions(**{**vars(options), "as_of": today})
