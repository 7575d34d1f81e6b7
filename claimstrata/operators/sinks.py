"""Table writes; each returns the number of rows it wrote.

Rows are counted by an `Observation` in the write job itself.  It sits after
the last shuffle, in the stage whose task results Spark counts exactly once,
so retries and lost executors do not inflate it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Kept with the table, so a session in dynamic mode still replaces whole months.
_TABLE_OPTIONS = {"partitionOverwriteMode": "static"}


def _counted(df: DataFrame, write: Callable[[DataFrame], object]) -> int:
    written = Observation()
    write(df.observe(written, F.count(F.lit(1)).alias("rows")))
    return written.get.get("rows", 0)


def balanced(df: DataFrame, columns: Sequence[str], alike: Sequence[str] = ()) -> DataFrame:
    """Gather each table partition's rows into few files of the advisory size.

    Adaptive execution splits a partition that is too large (one payer may
    hold a third of the rows) and merges small ones.  With `alike`, fields of few
    values, each task sorts its rows by `columns` and those that are present before it
    sends them: neighbours share most of their bytes, and the shuffle compresses better.
    """
    if not columns:
        return df
    if alike:
        # Spark drops a sort right below an exchange; a filter that it must evaluate in place keeps it.
        df = df.sortWithinPartitions(*columns, *[c for c in alike if c in df.columns])
        df = df.where(F.monotonically_increasing_id() >= 0)
    return df.hint("rebalance", *columns)


def append(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    path: str | None = None,
    buckets: int | None = None,
    bucket_by: str = "claim_id",
) -> int:
    """Append by column name; new columns widen the table, absent ones are NULL.

    With `buckets`, rows are stored hashed on `bucket_by`, and a later
    deduplication on that column reads them without a shuffle.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df = _widen(spark, table, df)
    return _counted(df, lambda rows: _save(rows, table, "append", partition_by, path, buckets, bucket_by))


def _save(
    df: DataFrame,
    table: str,
    mode: str,
    partition_by: Sequence[str],
    path: str | None,
    buckets: int | None = None,
    bucket_by: str = "claim_id",
) -> None:
    writer = df.write.format("parquet").mode(mode).options(**_TABLE_OPTIONS)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, bucket_by)
    writer.saveAsTable(table)


def _widen(spark: SparkSession, table: str, df: DataFrame) -> DataFrame:
    """Add the frame's new columns to the table, and the table's to the frame."""
    # Names as the catalog compares them: without case.
    stored = {f.name.lower(): f for f in spark.table(table).schema}
    incoming = {f.name.lower(): f for f in df.schema}
    changed = [f.name for c, f in incoming.items() if c in stored and f.dataType != stored[c].dataType]
    if changed:
        raise ValueError(f"type change on write to {table}: {', '.join(sorted(changed))}")
    added = [f"`{f.name}` {f.dataType.simpleString()}" for c, f in incoming.items() if c not in stored]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(added)})")
    absent = {f.name: F.lit(None).cast(f.dataType) for c, f in stored.items() if c not in incoming}
    return df.withColumns(absent) if absent else df


def replace_all(
    df: DataFrame, table: str, partition_by: Sequence[str] = (), path: str | None = None
) -> int:
    """Overwrite a whole table."""
    return _counted(df, lambda rows: _save(rows, table, "overwrite", partition_by, path))


def discard(spark: SparkSession, table: str) -> None:
    """Empty and drop a table, if there is one."""
    if spark.catalog.tableExists(table):
        # Emptied first: a table in a folder of its own keeps its files when it is dropped.
        spark.sql(f"INSERT OVERWRITE TABLE {table} SELECT * FROM {{rows}}", rows=spark.createDataFrame([], spark.table(table).schema))
        spark.sql(f"DROP TABLE {table}")


def replace_month(
    df: DataFrame,
    table: str,
    year: int,
    month: int,
    partition_by: Sequence[str] = ("claim_year", "claim_month", "payer_id"),
    path: str | None = None,
) -> int:
    """Replace one month of a table, all payers, and nothing else.

    New columns widen the table (NULL in other months), absent ones are NULL.

    `partition_by` starts with the year and month columns.  Payers that are
    absent from `df` disappear.  Running it again gives the same table.
    Plain files have no transaction: a reader may see the month empty while
    it is rewritten, and a failed run must be repeated.
    """
    year_col, month_col = partition_by[:2]
    return _replace_partitions(
        df, table, {year_col: year, month_col: month}, partition_by, path, f"row outside {year}-{month:02d} in month overwrite"
    )


def replace_batch(
    df: DataFrame, table: str, batch: str, partition_by: Sequence[str] = ("_batch_id",), path: str | None = None
) -> int:
    """Append one batch, or put it in place of what an earlier run of it stored.

    `partition_by` starts with the column that names the batch; other batches are
    not touched.  An attempt that failed half-way leaves nothing behind once the
    batch is run again, rows that it no longer has included.
    """
    return _replace_partitions(df, table, {partition_by[0]: batch}, partition_by, path, f"row outside batch {batch}")


def replace_found_partitions(df: DataFrame, table: str, partition_by: Sequence[str], path: str | None = None) -> int:
    """Replace, in one write, the partitions that `df` has rows of, and nothing else.

    The table is made if there is none.  A partition without rows in `df` stays.  From
    then on the table itself asks for such overwrites: use no other writes but
    `replace_all`, which makes it anew.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        _save(spark.createDataFrame([], df.schema), table, "append", partition_by, path)
    df = _widen(spark, table, df)
    _overwrites(spark, table, "dynamic")
    in_order = balanced(df, partition_by).select(*spark.table(table).columns)
    return _counted(in_order, lambda rows: rows.write.mode("overwrite").insertInto(table))


def replace_slices(
    df: DataFrame,
    table: str,
    slices: Sequence[tuple[int | str, ...]],
    partition_by: Sequence[str],
    path: str | None = None,
) -> dict[tuple[int | str, ...], int]:
    """Replace several slices of a table, such as months, in one write; rows written for each.

    A slice holds values of the first columns of `partition_by`.  Its partitions that
    `df` has no rows of (payers that are gone) are emptied after the write, one small
    statement for each; other slices are not touched.  New columns widen the table.
    A run that fails must be repeated, which gives the same table: partitions that
    were not yet emptied are found again.
    """
    spark, slices = df.sparkSession, [tuple(s) for s in slices]
    if not slices:
        return {}
    if spark.catalog.tableExists(table):
        df = _widen(spark, table, df)
    else:
        _save(spark.createDataFrame([], df.schema), table, "append", partition_by, path)
    leading = list(partition_by[: len(slices[0])])

    def inside(values: Sequence[int | str]) -> Column:
        return reduce(and_, [F.col(c) == F.lit(v) for c, v in zip(leading, values, strict=True)])

    stray = F.raise_error(F.lit(f"row outside the listed {', '.join(leading)}")).cast("boolean")
    checked = df.where(F.when(reduce(or_, map(inside, slices)), True).otherwise(stray))
    found = Observation()
    watched = checked.select(*spark.table(table).columns).observe(
        found,
        # As texts, as the catalog names partitions.
        F.collect_set(F.struct(*[F.col(c).cast("string").alias(c) for c in partition_by])).alias("partitions"),
        *[F.count_if(inside(s)).alias(f"n{i}") for i, s in enumerate(slices)],
    )
    _overwrites(spark, table, "dynamic")
    try:
        watched.write.mode("overwrite").insertInto(table)
    finally:
        _overwrites(spark, table, "static")
    seen = found.get
    # Nothing is observed where no task had anything to read.
    written = {tuple(p[c] for c in partition_by) for p in seen.get("partitions", ())}
    for values in slices:
        for gone in _stored_partitions(spark, table, dict(zip(leading, values, strict=True))) - written:
            _drop_partition(spark, table, dict(zip(partition_by, gone, strict=True)))
    return {s: seen.get(f"n{i}", 0) for i, s in enumerate(slices)}


def _overwrites(spark: SparkSession, table: str, mode: str) -> None:
    """How overwrites of a table act; kept with it, before the session's or the writer's mode."""
    spark.sql(f"ALTER TABLE {table} SET SERDEPROPERTIES ('partitionOverwriteMode' = '{mode}')")


def _spec(values: Mapping[str, int | str | None]) -> str:
    def literal(value: int | str | None) -> str:
        if value is None:
            return "NULL"
        return f"{value:d}" if isinstance(value, int) else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    return ", ".join(f"`{c}`={literal(v)}" for c, v in values.items())


def _stored_partitions(spark: SparkSession, table: str, under: Mapping[str, int | str]) -> set[tuple[str | None, ...]]:
    """Values, as texts, of the partitions in the catalog below the given leading values."""

    def value(part: str) -> str | None:
        text = part.split("=", 1)[1]
        return None if text == "__HIVE_DEFAULT_PARTITION__" else unquote(text)

    listed = spark.sql(f"SHOW PARTITIONS {table} PARTITION ({_spec(under)})").collect()
    return {tuple(value(part) for part in row["partition"].split("/")) for row in listed}


def _drop_partition(spark: SparkSession, table: str, values: Mapping[str, str | None]) -> None:
    # Emptied first: a table in a folder of its own keeps the files of dropped partitions.
    kept = [f for f in spark.table(table).schema if f.name not in values]
    nothing = spark.createDataFrame([], type(spark.table(table).schema)(kept))
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({_spec(values)}) SELECT * FROM {{rows}}", rows=nothing)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(values)})")


def _replace_partitions(
    df: DataFrame,
    table: str,
    fixed: Mapping[str, int | str],
    partition_by: Sequence[str],
    path: str | None,
    stray: str,
) -> int:
    """Replace the partitions with the `fixed` leading values, and nothing else."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df = _widen(spark, table, df)
        # A write of several slices that was cut off may have left the other mode.
        _overwrites(spark, table, "static")
    else:
        # Not from the frame itself: its observations are for the write below.
        _save(spark.createDataFrame([], df.schema), table, "append", partition_by, path)
    # A row of another partition is an error of the caller, never moved or dropped.
    within = reduce(and_, [F.col(c) == F.lit(value) for c, value in fixed.items()])
    checked = df.where(F.when(within, True).otherwise(F.raise_error(F.lit(stray)).cast("boolean")))
    target = ", ".join([_spec(fixed), *partition_by[len(fixed) :]])
    select = ", ".join(f"`{c}`" for c in spark.table(table).columns if c not in fixed)
    return _counted(
        checked,
        lambda rows: spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION ({target}) SELECT {select} FROM {{rows}}",
            rows=rows,
        ),
    )


def load_table(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    in_catalog: bool = True,
) -> int:
    """Write a Gold table; format and options reach any Spark data source.

    With `in_catalog` it becomes a Spark table.  Otherwise it is saved through
    the source itself, such as a warehouse connector, as its `dbtable`.
    """
    writer_options = dict(options or {})

    def write(rows: DataFrame) -> None:
        writer = rows.write.format(fmt).mode(mode).options(**writer_options)
        if not in_catalog:
            writer.option("dbtable", table).save(path)
        elif path:
            writer.option("path", path).saveAsTable(table)
        else:
            writer.saveAsTable(table)

    return _counted(df, write)


def materialize(df: DataFrame, name: str, kind: str, path: str | None = None) -> DataFrame:
    """Give a model the wanted form: "view", "ephemeral" or "table"."""
    if kind == "ephemeral":
        return df
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        replace_all(df, name, path=path)
    else:
        raise ValueError(f"unknown model form {kind!r}")
    return df.sparkSession.table(name)
