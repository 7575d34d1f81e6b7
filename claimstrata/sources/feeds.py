"""Claims, members and providers derived from order tables.

The derivation stands in for a sample generator: it is a distributed plan
over `lineitem` and `orders`, grows with them, and plants the dirt (NULLs,
padding, bad codes, negative and future values) that later layers must find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _padded(prefix: str, field: str, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(field).cast("string"), width, "0"))


def _payer(field: str) -> Column:
    return F.concat(F.lit("PAYER_00"), (F.col(field) % 4 + 1).cast("string"))


def _every(field: str, step: int) -> Column:
    return F.col(field) % step == 0


def _pick(selector: Column, *values: str) -> Column:
    """values[selector], the last one as the default."""
    picked = F.when(selector == 0, values[0])
    for position, value in enumerate(values[1:-1], start=1):
        picked = picked.when(selector == position, value)
    return picked.otherwise(values[-1])


def claims_feed(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One raw claim per order line, 17 fields."""
    part, line, price = F.col("l_partkey"), F.col("l_linenumber"), F.col("l_extendedprice")
    returned, allowed = F.col("l_returnflag"), price * (1 - F.col("l_discount"))
    service = F.col("l_shipdate").cast("timestamp")

    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.when(~_every("l_partkey", 211), F.concat(_padded("CLM", "l_orderkey", 8), line.cast("string"))).alias("claim_id"),
        F.when(~_every("l_partkey", 199), _padded("MBR", "o_custkey", 7)).alias("member_id"),
        _padded("PRV", "l_suppkey", 6).alias("provider_id"),
        _payer("o_custkey").alias("payer_id"),
        service.alias("service_date"),
        F.when(_every("l_partkey", 97), None)
        .when(_every("l_partkey", 83), "rx")
        .otherwise(_pick(part % 4, "inpatient", " Outpatient ", "PROFESSIONAL", "pharmacy"))
        .alias("claim_type"),
        F.when(
            ~_every("l_partkey", 127),
            _pick(part % 7, "Z00.00", " j06.9", "m54.5 ", "K21.0", "I10", "e11.9", "F32.1"),
        ).alias("diagnosis_code"),
        _pick(F.col("l_suppkey") % 7, "99213", " 9921 ", "93000", "80053", "850251", "71", "99283").alias("procedure_code"),
        F.when(_every("l_partkey", 193), None).when(_every("l_partkey", 101), -price).otherwise(price).alias("billed_amount"),
        allowed.alias("allowed_amount"),
        F.when(_every("l_partkey", 103), price * 2)
        .when(returned == "A", allowed * 0.75)
        .otherwise(0.0)
        .alias("paid_amount"),
        F.when(_every("l_partkey", 89), "unknown")
        .when((F.col("o_orderstatus") == "P") & (returned == "N"), "Adjusted")
        .when(returned == "A", "Paid")
        .when(returned == "R", " DENIED")
        .otherwise("pending")
        .alias("claim_status"),
        F.when(
            returned == "R",
            F.when(line % 3 == 0, "NOT_COVERED").when(line % 3 == 1, "PRIOR_AUTH_REQUIRED"),
        ).alias("denial_reason"),
        _pick(line % 4, "11", "21", "22", "23").alias("place_of_service"),
        F.lit("CLAIMS_SYSTEM_V2").alias("source_system"),
        (service + F.make_dt_interval(secs=part.cast("int"))).alias("ingestion_ts"),
        F.lit("claims_20240101000000").alias("batch_id"),
    )


def members_feed(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        _padded("MBR", "c_custkey", 7).alias("member_id"),
        _payer("c_custkey").alias("payer_id"),
        F.col("n_name").alias("state"),
        F.col("c_mktsegment").alias("segment"),
    )


def providers_feed(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        _padded("PRV", "s_suppkey", 6).alias("provider_id"),
        F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("npi_number"),
        _pick(F.col("s_suppkey") % 3, "cardiology", "family", "radiology").alias("specialty"),
        F.col("n_name").alias("state"),
    )


def _history(feed: DataFrame, number: str, versions: int, first: str, spread: int, apart: int) -> DataFrame:
    """One row per version of each row of `feed`, by its whole `number`.

    Of every fifth number the first two versions start together; of every third the
    first ends after 200 days.
    """
    n, v = F.col(number), F.col("version")
    steps = F.when((n % 5 == 0) & (v > 0), v - 1).otherwise(v) * apart
    start = F.date_add(F.lit(first).cast("date"), (n % spread + steps).cast("int"))
    loaded = F.lit("2000-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(days=v.cast("int"))
    return (
        feed.withColumn("version", F.explode(F.sequence(F.lit(0).cast("bigint"), (n % versions).cast("bigint"))))
        .withColumn("valid_from", start)
        .withColumn("valid_to", F.when((n % 3 == 0) & (v == 0), F.date_add("valid_from", 200)))
        .withColumn("loaded_at", loaded)
    )


def provider_versions_feed(supplier: DataFrame) -> DataFrame:
    """Specialties of providers over time, up to four versions each."""
    return _history(supplier, "s_suppkey", 4, "1992-06-01", 900, 420).select(
        _padded("PRV", "s_suppkey", 6).alias("provider_id"),
        _pick((F.col("s_suppkey") + F.col("version")) % 3, "cardiology", "family", "radiology").alias("specialty"),
        "valid_from",
        "valid_to",
        "loaded_at",
    )


def member_versions_feed(customer: DataFrame) -> DataFrame:
    """Plans of members over time, up to three versions each."""
    return _history(customer, "c_custkey", 3, "1993-01-01", 700, 500).select(
        _padded("MBR", "c_custkey", 7).alias("member_id"),
        _pick((F.col("c_custkey") + F.col("version")) % 3, "gold", "silver", "bronze").alias("plan"),
        "valid_from",
        "valid_to",
        "loaded_at",
    )
