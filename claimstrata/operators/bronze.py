"""Bronze: audit stamps and latest-wins deduplication of one batch."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimstrata.functions.columns import timestamp_or_now
from claimstrata.sources.files import SOURCE_FILE

_RANK = "_rank"
_ROW = "_null_key_row"


def batch_id(execution_time: dt.datetime, entity: str = "claims") -> str:
    """Batch name of an execution time: `<entity>_<yyyymmddhhmmss>_<8 hex>`."""
    # Fixed value: the format of a batch name.
    stamp = execution_time.strftime("%Y%m%d%H%M%S")
    return f"{entity}_{stamp}_{hashlib.md5(stamp.encode()).hexdigest()[:8]}"


def month_columns(date_field: str) -> dict[str, Column]:
    """Year and month of a date, the partitions of Bronze."""
    return {"year": F.year(date_field), "month": F.month(date_field)}


def add_audit_columns(
    df: DataFrame,
    batch: str,
    run_ts: dt.datetime | None = None,
    ingested_by: str = "claims_pipeline",
    date_field: str | None = "service_date",
) -> DataFrame:
    """Stamp rows with load time, loader, batch, source file and delete mark.

    With `date_field`, also its year and month, the storage partitions.  Rows
    that did not come from a file have an empty source file.  A delete mark that
    the rows bring along stays, unset ones are no deletes.
    """
    source = F.col(SOURCE_FILE) if SOURCE_FILE in df.columns else F.lit("")
    stamps = {
        "_ingested_at": timestamp_or_now(run_ts),
        "_ingested_by": F.lit(ingested_by),
        "_batch_id": F.lit(batch),
        SOURCE_FILE: source,
        "_is_deleted": F.coalesce(F.col("_is_deleted"), F.lit(False)) if "_is_deleted" in df.columns else F.lit(False),
    }
    if date_field:
        stamps |= month_columns(date_field)
    return df.withColumns(stamps)


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType)


def _order_key(df: DataFrame, name: str) -> Column:
    """The column, or for maps, which have no order, a text or entries that have one."""
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if not _holds_map(kind):
        return column
    plain = isinstance(kind, T.MapType) and not _holds_map(kind.valueType) and not _holds_map(kind.keyType)
    return F.sort_array(F.map_entries(column)) if plain else F.to_json(F.struct(column))


def latest_per_key(
    df: DataFrame, key: str | Sequence[str], newest_first: Sequence[str], keep_null_keys: bool = False
) -> DataFrame:
    """One row per key: the newest by `newest_first`, NULLs last.

    All other columns break ties, so equal timestamps give the same row on
    every run and on recomputed tasks.  Spark turns rank = 1 into a group
    limit on both sides of the shuffle: each map task sends at most one row
    per key, however many copies a hot (or NULL) key has.  With
    `keep_null_keys`, rows without (the first) key are told apart by a row number and all
    stay; that also deals them out evenly.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys and c not in newest_first]
    order = [_order_key(df, c).desc_nulls_last() for c in (*newest_first, *others)]
    if keep_null_keys:
        row = F.when(F.col(keys[0]).isNull(), F.monotonically_increasing_id())
        df, keys = df.withColumn(_ROW, row), [*keys, _ROW]
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK, _ROW)


def deduplicate(df: DataFrame, key: str = "claim_id", order_field: str = "ingestion_ts") -> DataFrame:
    """Latest version of each claim within a batch."""
    return latest_per_key(df, key, [order_field])


def months_touched(df: DataFrame) -> DataFrame:
    """Distinct (year, month) of a Bronze batch: the Silver months to re-run."""
    return df.select("year", "month").distinct()
