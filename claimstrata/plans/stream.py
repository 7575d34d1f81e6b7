"""Bronze from a folder that files keep arriving in."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstrata.plans.bronze import run_bronze
from claimstrata.plans.layers import Layers
from claimstrata.schemas import CLAIMS_SCHEMA, relaxed
from claimstrata.sources.fhir import fhir_rows
from claimstrata.sources.files import SOURCE_FILE, json_rows
from claimstrata.sources.hl7 import SEPARATOR, hl7_rows

# Format -> claims and rejects of the records in `value`.
_PARSERS: dict[str, Callable[[DataFrame], tuple[DataFrame, DataFrame]]] = {
    "json": lambda lines: json_rows(lines, unknown="reject"),
    "fhir": fhir_rows,
    "hl7": hl7_rows,
}


def _arriving(spark: SparkSession, folder: str, fmt: str, files_per_batch: int | None) -> DataFrame:
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    source = F.col("_metadata.file_path").alias(SOURCE_FILE)
    if fmt == "parquet":
        return reader.schema(relaxed(CLAIMS_SCHEMA)).parquet(folder).select("*", source)
    if fmt == "hl7":
        reader = reader.option("lineSep", SEPARATOR)
    return reader.text(folder).select("value", source)


def stream_bronze(
    spark: SparkSession,
    folder: str,
    fmt: str,
    layers: Layers,
    checkpoint: str,
    name: str = "claims_stream",
    run_ts: dt.datetime | None = None,
    nulls: str = "reject",
    files_per_batch: int | None = None,
) -> list[dict[str, Any]]:
    """Append the files that came since the last run with the same `checkpoint`; then stop.

    Formats: "json" (records with unknown fields are rejects), "fhir", "hl7",
    "parquet".  The checkpoint, in a folder all executors share, says which files
    belong to which micro-batch.  A micro-batch is a Bronze batch named by `name`
    and its number, and replaces what a failed attempt of it stored: every file is
    in Bronze, rejects and batch log exactly once, however often a run fails and is
    started again.  Returns the summary of each batch.
    """
    if fmt not in (*_PARSERS, "parquet"):
        raise ValueError(f"format must be 'json', 'fhir', 'hl7' or 'parquet', not {fmt!r}")
    summaries: list[dict[str, Any]] = []

    def store(arrived: DataFrame, number: int) -> None:
        rows, rejects = _PARSERS[fmt](arrived) if fmt in _PARSERS else (arrived, None)
        batch = f"{name}_{number:012d}"
        summaries.append(
            run_bronze(rows, None, layers, run_ts, nulls, once=True, batch=batch, set_aside=rejects)
        )

    query = (
        _arriving(spark, folder, fmt, files_per_batch)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        # Micro-batches write in a session of their own; this one may know files that they replaced.
        for table in map(layers.table, ("bronze", "bronze_rejects", "batch_log")):
            if spark.catalog.tableExists(table):
                spark.catalog.refreshTable(table)
    return summaries
