"""Marts that are kept up to date month by month.

Partial sums of each month, payer and diagnosis are stored; a late batch has only its
months rebuilt from Silver, and the marts combine the stored sums: a few rows per
month instead of claims.  Sums are decimals, so the marts equal those over all claims.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstrata.operators.marts import partial_sums, total_sums
from claimstrata.operators.sinks import replace_all, replace_found_partitions
from claimstrata.plans.bronze import months_of_batch
from claimstrata.plans.layers import Layers
from claimstrata.plans.silver import SilverOptions, rerun_touched
from claimstrata.sources.layers import in_months

PARTIALS = "mart_partials"
_MONTH = ("claim_year", "claim_month")


def refresh_partials(spark: SparkSession, layers: Layers, months: list[tuple[int, int]] | None = None) -> int:
    """Rebuild the stored sums of `months`, or all; returns the rows written.

    One write for any number of months.  Each month also gets a row without claims, so
    that a month that lost all its claims is replaced, too.
    """
    silver, target, path = spark.table(layers.table("silver")), layers.table(PARTIALS), layers.path(PARTIALS)
    if months is None:
        return replace_all(partial_sums(silver, *_MONTH, "payer_id", "diagnosis_code"), target, _MONTH, path)
    if not months:
        return 0
    rebuilt = partial_sums(silver.where(in_months(months, *_MONTH)), *_MONTH, "payer_id", "diagnosis_code")
    marks = spark.createDataFrame([(y, m, 0, 0) for y, m in months], "claim_year int, claim_month int, claims long, denied long")
    return replace_found_partitions(rebuilt.unionByName(marks, allowMissingColumns=True), target, _MONTH, path)


def refresh_batch(
    spark: SparkSession, layers: Layers, batch: str, options: SilverOptions = SilverOptions()
) -> list[tuple[int, int]]:
    """Bring a batch's claims into Silver and its months' sums up to date; returns the months."""
    rerun_touched(spark, layers, batch, options)
    months = months_of_batch(spark, layers, batch)
    refresh_partials(spark, layers, months)
    return months


def monthly_payer_of(partials: DataFrame) -> DataFrame:
    """The mart `monthly_payer` from stored sums."""
    name = F.date_format(F.make_date("claim_year", "claim_month", F.lit(1)), "MMMM")
    keys = [F.col("claim_year").alias("year"), F.col("claim_month").alias("month"), name.alias("month_name"), "payer_id"]
    return partials.where(F.col("claims") > 0).groupBy(*keys).agg(*total_sums())


def denials_by_category_of(partials: DataFrame) -> DataFrame:
    """The mart `denials_by_category` from stored sums."""
    return (
        partials.where(F.col("claims") > 0)
        .groupBy(F.substring("diagnosis_code", 1, 1).alias("category"))
        .agg(*total_sums())
        .withColumn("denial_rate", F.col("denied").cast("double") / F.col("claims"))
    )
