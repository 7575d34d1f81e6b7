"""Bronze ingestion of one batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimstrata.operators.bronze import (
    add_audit_columns,
    batch_id,
    latest_per_key,
    month_columns,
    months_touched,
)
from claimstrata.operators.sinks import append, balanced, discard, replace_all, replace_batch
from claimstrata.plans.layers import Layers
from claimstrata.schemas import (
    BRONZE_PARTITIONS,
    CLAIMS_SCHEMA,
    CODE_FIELDS,
    MEMBERS_SCHEMA,
    PROVIDERS_SCHEMA,
    required_fields,
)
from claimstrata.sources.contract import conform, enforce_not_null, split_not_null
from claimstrata.sources.files import read_feed


def bronze_rows(
    df: DataFrame,
    batch: str,
    schema: T.StructType = CLAIMS_SCHEMA,
    key: str = "claim_id",
    newest_first: Sequence[str] = ("ingestion_ts",),
    date_field: str | None = "service_date",
    run_ts: dt.datetime | None = None,
    nulls: str = "fail",
    layout: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Typed, deduplicated, audited rows of one batch of any feed.

    `nulls="fail"` stops at a NULL in a NOT NULL field; `"keep"` lets it
    through, and every row without key stays.  `layout` distributes the rows for writing.  Stamps come last:
    they are constant within a batch and need not travel through shuffles.
    """
    typed = conform(df, schema)
    if nulls == "fail":
        typed = enforce_not_null(typed, schema)
    elif nulls != "keep":
        raise ValueError(f"nulls must be 'fail' or 'keep', not {nulls!r}")
    latest = latest_per_key(typed, key, newest_first, keep_null_keys=nulls == "keep")
    laid_out = layout(latest) if layout else latest
    return add_audit_columns(laid_out, batch, run_ts, date_field=date_field)


def _by_partition(df: DataFrame) -> DataFrame:
    return balanced(df.withColumns(month_columns("service_date")), BRONZE_PARTITIONS, CODE_FIELDS)


def run_bronze(
    claims: DataFrame,
    execution_time: dt.datetime | None,
    layers: Layers,
    run_ts: dt.datetime | None = None,
    nulls: str = "fail",
    buckets: int | None = None,
    once: bool = False,
    batch: str | None = None,
    set_aside: DataFrame | None = None,
) -> dict[str, Any]:
    """Append one batch of claims, in one write.

    `nulls="reject"` appends NOT NULL violations, whole and unmasked, to the
    Bronze rejects table, together with rejects of the reader in `set_aside`.  A
    batch that is run twice is stored twice; Silver absorbs the copies.  With
    `once`, tables are partitioned by batch first and a batch takes the place of
    what an earlier run of the same name stored, in Bronze, rejects and batch log.
    The name is `batch`, or follows from the execution time.  `buckets` stores
    rows hashed on the claim id instead of gathered by partition: more files, but
    Silver then needs no shuffle to deduplicate a month, however often it is
    re-run.  The months of the batch go to the batch log, so that late claims are
    found without a scan.

    Bronze is written before rejects: a run that fails in between and is
    repeated doubles Bronze rows, which Silver absorbs, and no rejects.
    """
    if once and buckets:
        raise ValueError("a table is laid out by batch or by bucket, not both")
    batch = batch or batch_id(execution_time)
    rejects = set_aside
    if nulls == "reject":
        claims, broken = split_not_null(conform(claims))
        rejects = broken if rejects is None else broken.unionByName(rejects, allowMissingColumns=True)
        nulls = "keep"
    layout = (lambda df: df.repartition(buckets, "claim_id")) if buckets else _by_partition
    seen, stored = Observation(), Observation()
    rows = bronze_rows(
        claims.observe(seen, F.count(F.lit(1)).alias("rows")),
        batch,
        run_ts=run_ts,
        nulls=nulls,
        layout=layout,
    ).observe(stored, F.collect_set(F.struct("year", "month")).alias("months"))
    target, path = layers.table("bronze"), layers.path("bronze")
    if once:
        loaded = replace_batch(rows, target, batch, ("_batch_id", *BRONZE_PARTITIONS), path)
    else:
        loaded = append(rows, target, BRONZE_PARTITIONS, path, buckets)
    # Nothing was observed where nothing was read; any row received leaves one.
    received = seen.get["rows"] if loaded else 0
    _log_months(claims.sparkSession, batch, stored.get["months"] if loaded else [], layers, once)
    rejected = 0 if rejects is None else _reject(rejects, batch, layers, run_ts, once)
    return {
        "input_records": received + rejected,
        "records_loaded": loaded,
        "duplicates_dropped": received - loaded,
        "records_failed": rejected,
        "batch_id": batch,
        "target": target,
        "status": "SUCCESS",
    }


def run_bronze_files(
    spark: SparkSession,
    path: str,
    fmt: str,
    execution_time: dt.datetime,
    layers: Layers,
    run_ts: dt.datetime | None = None,
    nulls: str = "fail",
    buckets: int | None = None,
    once: bool = False,
    **reading: Any,
) -> dict[str, Any]:
    """Append a batch of files; unreadable records go to the rejects table.

    `reading` goes to `read_feed`: timestamp format, line breaks, unknown fields.
    Messages are parsed once, into a table that is dropped when both Bronze and
    rejects are written from it.
    """
    entity = f"incoming_{batch_id(execution_time)}"
    parsed, folder = layers.table(entity), layers.path(entity)

    def keep(records: DataFrame) -> DataFrame:
        replace_all(records, parsed, path=folder)
        return spark.table(parsed)

    try:
        rows, corrupt = read_feed(spark, path, fmt, keep=keep, **reading)
        return run_bronze(rows, execution_time, layers, run_ts, nulls, buckets, once, set_aside=corrupt)
    finally:
        discard(spark, parsed)


def _log_months(spark: SparkSession, batch: str, months: list[Any], layers: Layers, once: bool) -> None:
    """Append the (year, month) pairs of a batch to the batch log."""
    rows = [(batch, m["year"], m["month"]) for m in months]
    log = spark.createDataFrame(rows, "_batch_id string, year int, month int").coalesce(1)
    if once:
        replace_batch(log, layers.table("batch_log"), batch, path=layers.path("batch_log"))
    else:
        append(log, layers.table("batch_log"), path=layers.path("batch_log"))


def months_of_batch(spark: SparkSession, layers: Layers, batch: str) -> list[tuple[int, int]]:
    """Months a batch has claims for, from the batch log."""
    log = spark.table(layers.table("batch_log")).where(F.col("_batch_id") == batch)
    return sorted(tuple(row) for row in months_touched(log).dropna().collect())


def _reject(df: DataFrame, batch: str, layers: Layers, run_ts: dt.datetime | None, once: bool) -> int:
    stamped = add_audit_columns(df, batch, run_ts, date_field=None)
    target, path = layers.table("bronze_rejects"), layers.path("bronze_rejects")
    return replace_batch(stamped, target, batch, path=path) if once else append(stamped, target, path=path)


# Feeds without a load time of their own: any copy of a key may stand for it,
# the full tiebreak makes it the same one every time.
_REFERENCE_FEEDS = {"members": MEMBERS_SCHEMA, "providers": PROVIDERS_SCHEMA}


def reference_rows(
    df: DataFrame, feed: str, execution_time: dt.datetime, run_ts: dt.datetime | None = None
) -> DataFrame:
    """Bronze rows of the "members" or "providers" feed."""
    schema = _REFERENCE_FEEDS[feed]
    (key,) = required_fields(schema)
    return bronze_rows(
        df,
        batch_id(execution_time, feed),
        schema,
        key,
        newest_first=(),
        date_field=None,
        run_ts=run_ts,
    )


def run_reference_feed(
    df: DataFrame,
    feed: str,
    execution_time: dt.datetime,
    layers: Layers,
    run_ts: dt.datetime | None = None,
) -> dict[str, Any]:
    """Append one batch of members or providers."""
    table = f"bronze_{feed}"
    rows = reference_rows(df, feed, execution_time, run_ts)
    loaded = append(rows, layers.table(table), path=layers.path(table))
    return {"records_loaded": loaded, "target": layers.table(table), "status": "SUCCESS"}
