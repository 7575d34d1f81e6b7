"""Small helpers of the operators: tables, word splitting, stored steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstrata.session import SHUFFLES_END_WITH_JOB, workspace

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written below the shared folder and read back, which cuts its lineage.

    The shuffles behind it are removed as soon as it is written.
    """
    spark = df.sparkSession
    path = workspace(spark, purpose)
    before = spark.conf.get(SHUFFLES_END_WITH_JOB)
    spark.conf.set(SHUFFLES_END_WITH_JOB, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLES_END_WITH_JOB, before)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column) -> Column:
    """Maximal runs of anything but the six ASCII spaces; no words for NULL."""
    trimmed = F.btrim(text, F.lit(SPACES))
    none = F.array().cast("array<string>")
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_CLASS + "+")).otherwise(none)


def array_literal(values: list[int] | list[float], kind: str) -> Column:
    """A constant array; folded once by the optimizer, so rows only index it."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def own_name(df: DataFrame, name: str) -> str:
    """A column name based on `name` that `df` does not use."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
