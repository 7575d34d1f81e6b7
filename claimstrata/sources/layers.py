"""Month scans of the stored layers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _month(df: DataFrame, year_col: str, month_col: str, year: int, month: int) -> DataFrame:
    # Both columns are partition columns: other months' files are never listed.
    return df.where((F.col(year_col) == year) & (F.col(month_col) == month))


def in_months(
    months: Iterable[tuple[int, int]], year_col: str = "claim_year", month_col: str = "claim_month"
) -> Column:
    """A filter on the partitions of a layer, Silver by default; no month gives no row."""
    wanted = F.lit(False)
    for year, month in months:
        wanted = wanted | ((F.col(year_col) == year) & (F.col(month_col) == month))
    return wanted


def bronze_months(spark: SparkSession, table: str, months: Iterable[tuple[int, int]]) -> DataFrame:
    """Every batch and payer of several service months; only their files are opened."""
    return spark.table(table).where(in_months(months, "year", "month"))


def bronze_month(spark: SparkSession, table: str, year: int, month: int) -> DataFrame:
    """Every batch and payer of one service month."""
    return _month(spark.table(table), "year", "month", year, month)


def silver_month(spark: SparkSession, table: str, year: int, month: int) -> DataFrame:
    """Clean claims of one service month."""
    return _month(spark.table(table), "claim_year", "claim_month", year, month)
