"""Gold: the star schema of one Silver month, or of all Silver."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from claimstrata.operators.gold import (
    build_dim_date,
    build_dim_diagnosis,
    build_dim_member,
    build_dim_provider,
    build_fact_claims,
)
from claimstrata.operators.sinks import load_table
from claimstrata.plans.layers import Layers
from claimstrata.sources.layers import silver_month


def star_schema(
    silver: DataFrame, run_ts: dt.datetime | None = None, icd10: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Table name -> frame; five plans that each read only their columns.

    `icd10` (icd10_prefix, description) describes diagnoses.
    """
    return {
        "dim_date": build_dim_date(silver),
        "dim_member": build_dim_member(silver, run_ts),
        "dim_provider": build_dim_provider(silver, run_ts),
        "dim_diagnosis": build_dim_diagnosis(silver, icd10),
        "fact_claims": build_fact_claims(silver, run_ts),
    }


def run_gold(
    spark: SparkSession,
    layers: Layers,
    year: int | None = None,
    month: int | None = None,
    run_ts: dt.datetime | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    in_catalog: bool = True,
    icd10: DataFrame | None = None,
) -> dict[str, Any]:
    """Overwrite the five Gold tables; with a month, they then hold that month."""
    if (year is None) != (month is None):
        raise ValueError("give both year and month, or neither")
    table = layers.table("silver")
    silver = spark.table(table) if year is None else silver_month(spark, table, year, month)
    star = star_schema(silver, run_ts, icd10)

    def load(name: str) -> int:
        return load_table(
            star[name],
            layers.table(name),
            fmt=fmt,
            options=options,
            path=layers.path(name),
            in_catalog=in_catalog,
        )

    # Independent writes: submitted together, so that the small dimension jobs
    # fill executors while the fact is written.
    with ThreadPoolExecutor(len(star)) as pool:
        written = dict(zip(star, pool.map(inheritable_thread_target(spark)(load), star)))
    return {"fact_records": written["fact_claims"], "tables": written, "status": "SUCCESS"}
