"""Schemas and fixed values of the claims data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Data contract of a raw claim (order, types, NOT NULL fields).
CLAIMS_SCHEMA = T.StructType(
    [
        T.StructField("claim_id", T.StringType(), False),
        T.StructField("member_id", T.StringType(), False),
        T.StructField("provider_id", T.StringType(), False),
        T.StructField("payer_id", T.StringType()),
        T.StructField("service_date", T.TimestampType(), False),
        T.StructField("claim_type", T.StringType()),
        T.StructField("diagnosis_code", T.StringType()),
        T.StructField("procedure_code", T.StringType()),
        T.StructField("billed_amount", T.DoubleType()),
        T.StructField("allowed_amount", T.DoubleType()),
        T.StructField("paid_amount", T.DoubleType()),
        T.StructField("claim_status", T.StringType()),
        T.StructField("denial_reason", T.StringType()),
        T.StructField("place_of_service", T.StringType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("ingestion_ts", T.TimestampType()),
        T.StructField("batch_id", T.StringType()),
    ]
)

# Member and provider feeds have no published layout; these are ours.
MEMBERS_SCHEMA = T.StructType(
    [
        T.StructField("member_id", T.StringType(), False),
        T.StructField("payer_id", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("segment", T.StringType()),
    ]
)

PROVIDERS_SCHEMA = T.StructType(
    [
        T.StructField("provider_id", T.StringType(), False),
        T.StructField("npi_number", T.StringType()),
        T.StructField("specialty", T.StringType()),
        T.StructField("state", T.StringType()),
    ]
)

# Identifiers to hash, the default salt and the accepted codes.
PII_FIELDS = ("member_id", "provider_id")
DEFAULT_SALT = "SALT_2024"
CLAIM_TYPES = ("inpatient", "outpatient", "professional", "pharmacy")
CLAIM_STATUSES = ("paid", "denied", "pending", "adjusted", "voided")
DIAGNOSIS_DESCRIPTION = "See ICD-10 reference"

# Names and order of the fact columns.
FACT_COLUMNS = (
    "claim_key",
    "claim_id",
    "member_key",
    "provider_key",
    "date_key",
    "diagnosis_key",
    "payer_id",
    "claim_type",
    "claim_status",
    "procedure_code",
    "billed_amount",
    "allowed_amount",
    "paid_amount",
    "discount_rate",
    "is_denied",
    "place_of_service",
    "_silver_processed_at",
    "_gold_loaded_at",
)

# Physical partitioning of the stored layers.
BRONZE_PARTITIONS = ("year", "month", "payer_id")
SILVER_PARTITIONS = ("claim_year", "claim_month", "payer_id")

# Fields of few values: rows that share them compress well side by side.
CODE_FIELDS = (
    "claim_type",
    "claim_status",
    "procedure_code",
    "diagnosis_code",
    "denial_reason",
    "place_of_service",
)

# Fixed value: a quality metric below this many percent fails the gate.
QUALITY_THRESHOLD = 95.0


def required_fields(schema: T.StructType) -> list[str]:
    """Names of the NOT NULL fields, in schema order."""
    return [field.name for field in schema if not field.nullable]


def relaxed(schema: T.StructType) -> T.StructType:
    """The same fields, all nullable: what a file reader can promise."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
