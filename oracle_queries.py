"""SQL counterparts of the registered queries, for an independent engine.

Each text is built from common table expressions over the given tables.
Constants pinned on both sides: as_of 2001-06-30, run time 2024-01-01,
salt SALT_2024, month 2001-05, start date 1998-01-01.
"""

from __future__ import annotations

CLAIM_FIELDS = [
    "claim_id", "member_id", "provider_id", "payer_id", "service_date", "claim_type",
    "diagnosis_code", "procedure_code", "billed_amount", "allowed_amount", "paid_amount",
    "claim_status", "denial_reason", "place_of_service", "source_system", "ingestion_ts", "batch_id",
]

RUN_TS = "TIMESTAMP '2024-01-01 00:00:00'"

CLAIMS = """
SELECT
  CASE WHEN l_partkey % 211 = 0 THEN NULL
       ELSE 'CLM' || lpad(CAST(l_orderkey AS STRING), 8, '0') || CAST(l_linenumber AS STRING) END AS claim_id,
  CASE WHEN l_partkey % 199 = 0 THEN NULL
       ELSE 'MBR' || lpad(CAST(o_custkey AS STRING), 7, '0') END AS member_id,
  'PRV' || lpad(CAST(l_suppkey AS STRING), 6, '0') AS provider_id,
  'PAYER_00' || CAST(o_custkey % 4 + 1 AS STRING) AS payer_id,
  CAST(l_shipdate AS TIMESTAMP) AS service_date,
  CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 83 = 0 THEN 'rx'
       WHEN l_partkey % 4 = 0 THEN 'inpatient' WHEN l_partkey % 4 = 1 THEN ' Outpatient '
       WHEN l_partkey % 4 = 2 THEN 'PROFESSIONAL' ELSE 'pharmacy' END AS claim_type,
  CASE WHEN l_partkey % 127 = 0 THEN NULL WHEN l_partkey % 7 = 0 THEN 'Z00.00' WHEN l_partkey % 7 = 1 THEN ' j06.9'
       WHEN l_partkey % 7 = 2 THEN 'm54.5 ' WHEN l_partkey % 7 = 3 THEN 'K21.0' WHEN l_partkey % 7 = 4 THEN 'I10'
       WHEN l_partkey % 7 = 5 THEN 'e11.9' ELSE 'F32.1' END AS diagnosis_code,
  CASE l_suppkey % 7 WHEN 0 THEN '99213' WHEN 1 THEN ' 9921 ' WHEN 2 THEN '93000' WHEN 3 THEN '80053'
       WHEN 4 THEN '850251' WHEN 5 THEN '71' ELSE '99283' END AS procedure_code,
  CASE WHEN l_partkey % 193 = 0 THEN NULL WHEN l_partkey % 101 = 0 THEN -l_extendedprice
       ELSE l_extendedprice END AS billed_amount,
  l_extendedprice * (1 - l_discount) AS allowed_amount,
  CASE WHEN l_partkey % 103 = 0 THEN l_extendedprice * 2
       WHEN l_returnflag = 'A' THEN l_extendedprice * (1 - l_discount) * 0.75 ELSE 0.0 END AS paid_amount,
  CASE WHEN l_partkey % 89 = 0 THEN 'unknown' WHEN o_orderstatus = 'P' AND l_returnflag = 'N' THEN 'Adjusted'
       WHEN l_returnflag = 'A' THEN 'Paid' WHEN l_returnflag = 'R' THEN ' DENIED' ELSE 'pending' END AS claim_status,
  CASE WHEN l_returnflag <> 'R' THEN NULL WHEN l_linenumber % 3 = 0 THEN 'NOT_COVERED'
       WHEN l_linenumber % 3 = 1 THEN 'PRIOR_AUTH_REQUIRED' ELSE NULL END AS denial_reason,
  CASE l_linenumber % 4 WHEN 0 THEN '11' WHEN 1 THEN '21' WHEN 2 THEN '22' ELSE '23' END AS place_of_service,
  'CLAIMS_SYSTEM_V2' AS source_system,
  CAST(l_shipdate AS TIMESTAMP) + INTERVAL '1' SECOND * CAST(l_partkey AS INT) AS ingestion_ts,
  'claims_20240101000000' AS batch_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def _with(ctes: dict[str, str], final: str) -> str:
    parts = ",\n".join(f"{name} AS ({body})" for name, body in ctes.items())
    return f"WITH {parts}\n{final}"


def _latest(source: str, first: str, fields: list[str], key: str = "claim_id", extra: str = "") -> str:
    """Rows of `source` ranked first per key: newest, then every other field."""
    rest = [f for f in fields if f not in (key, first)]
    order = ", ".join(f"{f} DESC NULLS LAST" for f in [first, *rest] if f)
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER "
        f"(PARTITION BY {key}{extra} ORDER BY {order}) = 1"
    )


def _audit(batch_time: str = "20240101000000", run_ts: str = RUN_TS, entity: str = "claims") -> str:
    return (
        f"{run_ts} AS _ingested_at, 'claims_pipeline' AS _ingested_by, "
        f"'{entity}_{batch_time}_' || left(md5('{batch_time}'), 8) AS _batch_id, false AS _is_deleted"
    )


MONTH_OF = "CAST(year(service_date) AS INTEGER) AS year, CAST(month(service_date) AS INTEGER) AS month"


def _standard(source: str, masked: bool = True) -> str:
    """Standardised (and masked) fields; other columns of the source follow."""
    member, provider = "member_id", "provider_id"
    if masked:
        member = "sha256(concat_ws('|', member_id, 'SALT_2024'))"
        provider = "sha256(concat_ws('|', provider_id, 'SALT_2024'))"
    return (
        f"SELECT * REPLACE ({member} AS member_id, {provider} AS provider_id, "
        "CAST(service_date AS DATE) AS service_date, lower(trim(claim_type)) AS claim_type, "
        "trim(upper(diagnosis_code)) AS diagnosis_code, "
        "lpad(trim(procedure_code), 5, '0') AS procedure_code, "
        f"lower(trim(claim_status)) AS claim_status) FROM {source}"
    )


FLAGS = {
    "claim_id_null": "claim_id IS NULL",
    "member_id_null": "member_id IS NULL",
    "invalid_claim_type": "NOT claim_type IN ('inpatient', 'outpatient', 'professional', 'pharmacy')",
    "invalid_status": "NOT claim_status IN ('paid', 'denied', 'pending', 'adjusted', 'voided')",
    "negative_amount": "billed_amount < 0",
    "future_date": "service_date > DATE '2001-06-30'",
    "paid_exceeds_billed": "paid_amount > billed_amount",
}
BROKEN = "(" + " OR ".join(f"({f})" for f in FLAGS.values()) + ")"
FLAG_COLUMNS = ", ".join(f"({f}) AS _v_{name}" for name, f in FLAGS.items())
ERRORS = "concat_ws(', ', " + ", ".join(f"CASE WHEN {f} THEN '{name}' END" for name, f in FLAGS.items()) + ")"

ENRICHED = (
    "CAST(year(service_date) AS INTEGER) AS claim_year, CAST(month(service_date) AS INTEGER) AS claim_month, "
    "CAST(quarter(service_date) AS INTEGER) AS claim_quarter, "
    "CASE WHEN billed_amount > 0 THEN round(1 - allowed_amount / billed_amount, 4) END AS discount_rate, "
    "claim_status = 'denied' AS is_denied"
)
PROCESSED = f"{RUN_TS} AS _silver_processed_at"

C = {"claims": CLAIMS}
STD = C | {"std": _standard("claims")}
VALID = STD | {"valid": f"SELECT * FROM std WHERE NOT {BROKEN}"}
SILVER = VALID | {
    "latest": _latest("valid", "ingestion_ts", CLAIM_FIELDS),
    "silver": f"SELECT *, {ENRICHED}, {PROCESSED} FROM latest",
}

# Bronze deduplicated within its batch, then Silver from it.
# Claims without id are told apart by nothing, so each of them stays.
def _latest_keeping(source: str) -> str:
    known = _latest(f"(SELECT * FROM {source} WHERE claim_id IS NOT NULL)", "ingestion_ts", CLAIM_FIELDS)
    return f"{known} UNION ALL BY NAME SELECT * FROM {source} WHERE claim_id IS NULL"


BRONZE = C | {
    "first_load": _latest_keeping("claims"),
    "bronze": f"SELECT *, {_audit()}, {MONTH_OF} FROM first_load",
}
FROM_BRONZE = BRONZE | {
    "std": _standard("bronze"),
    "valid": f"SELECT * FROM std WHERE NOT {BROKEN}",
    "latest": _latest("valid", "ingestion_ts", CLAIM_FIELDS),
    "silver": f"SELECT *, {ENRICHED}, {PROCESSED} FROM latest",
}

# Silver stored with audit columns, all of it and one month on its own.
STORED = C | {
    "bronze": f"SELECT *, {_audit()}, {MONTH_OF} FROM claims",
    "std": _standard("bronze"),
    "valid": f"SELECT * FROM std WHERE NOT {BROKEN}",
    "latest": _latest("valid", "ingestion_ts", CLAIM_FIELDS),
    "silver": f"SELECT *, {ENRICHED}, {PROCESSED} FROM latest",
}
ONE_MONTH = STORED | {
    "month_valid": "SELECT * FROM valid WHERE year = 2001 AND month = 5",
    "month_latest": _latest("month_valid", "ingestion_ts", CLAIM_FIELDS),
    "month_silver": f"SELECT *, {ENRICHED}, {PROCESSED} FROM month_latest",
}

DATE_KEY = "CAST(strftime(service_date, '%Y%m%d') AS INTEGER)"


def _star(silver: str = "silver", suffix: str = "") -> dict[str, str]:
    return {
        f"dim_date{suffix}": (
            f"SELECT DISTINCT {DATE_KEY} AS date_key, service_date AS full_date, "
            "CAST(year(service_date) AS INTEGER) AS year, CAST(quarter(service_date) AS INTEGER) AS quarter, "
            "CAST(month(service_date) AS INTEGER) AS month, strftime(service_date, '%B') AS month_name, "
            "CAST(weekofyear(service_date) AS INTEGER) AS week_of_year, "
            "CAST(dayofweek(service_date) + 1 AS INTEGER) AS day_of_week, "
            "strftime(service_date, '%A') AS day_name, dayofweek(service_date) IN (0, 6) AS is_weekend "
            f"FROM {silver}"
        ),
        f"dim_member{suffix}": (
            "SELECT DISTINCT md5(member_id) AS member_key, member_id AS member_id_hash, payer_id, "
            f"{RUN_TS} AS _updated_at FROM {silver}"
        ),
        f"dim_provider{suffix}": (
            "SELECT DISTINCT md5(provider_id) AS provider_key, provider_id AS provider_id_hash, "
            f"{RUN_TS} AS _updated_at FROM {silver}"
        ),
        f"dim_diagnosis{suffix}": (
            "SELECT DISTINCT diagnosis_code, md5(diagnosis_code) AS diagnosis_key, "
            "diagnosis_code AS icd10_code, 'See ICD-10 reference' AS description, "
            f"substr(diagnosis_code, 1, 1) AS category FROM {silver} WHERE diagnosis_code IS NOT NULL"
        ),
        f"fact_claims{suffix}": (
            "SELECT md5(claim_id) AS claim_key, claim_id, md5(member_id) AS member_key, "
            f"md5(provider_id) AS provider_key, {DATE_KEY} AS date_key, md5(diagnosis_code) AS diagnosis_key, "
            "payer_id, claim_type, claim_status, procedure_code, billed_amount, allowed_amount, paid_amount, "
            f"discount_rate, is_denied, place_of_service, _silver_processed_at, {RUN_TS} AS _gold_loaded_at "
            f"FROM {silver}"
        ),
    }


GOLD = SILVER | _star()
GOLD_AND_MONTH = GOLD | {
    "of_month": "SELECT * FROM silver WHERE claim_year = 2001 AND claim_month = 5"
} | _star("of_month", "_month")


def _money(field: str) -> str:
    exact = f"sum(CAST({field} AS DECIMAL(28, 6)))"
    return f"CAST(CAST({exact} AS DECIMAL(38, 2)) AS DOUBLE) AS {field}"


TOTALS = (
    "count(*) AS claims, count(*) FILTER (WHERE is_denied) AS denied, "
    + ", ".join(_money(f) for f in ("billed_amount", "allowed_amount", "paid_amount"))
)


def _monthly(where: str = "") -> str:
    return (
        f"SELECT d.year, d.month, d.month_name, f.payer_id, {TOTALS} "
        f"FROM fact_claims f JOIN dim_date d ON f.date_key = d.date_key {where} "
        "GROUP BY d.year, d.month, d.month_name, f.payer_id"
    )


DENIALS = (
    f"SELECT d.category, {TOTALS}, CAST(count(*) FILTER (WHERE is_denied) AS DOUBLE) / count(*) AS denial_rate "
    "FROM fact_claims f LEFT JOIN dim_diagnosis d ON f.diagnosis_key = d.diagnosis_key GROUP BY d.category"
)


def _history(table: str, number: str, prefix: str, width: int, values: tuple, name: str, versions: int, start: str) -> str:
    """Versions of members or providers: number, version and start as in the feed."""
    first, spread, apart = start.split()
    steps = f"(CASE WHEN {number} % 5 = 0 AND v > 0 THEN v - 1 ELSE v END) * {apart}"
    begins = f"DATE '{first}' + CAST({number} % {spread} + {steps} AS INTEGER)"
    picked = f"CASE ({number} + v) % 3 " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(values)) + " END"
    return (
        f"SELECT md5(sha256('{prefix}' || lpad(CAST({number} AS STRING), {width}, '0') || '|SALT_2024')) AS version_key, "
        f"{picked} AS {name}, {begins} AS valid_from, CASE WHEN {number} % 3 = 0 AND v = 0 THEN {begins} + 200 END AS valid_to, v "
        f"FROM {table}, range(0, {versions}) r(v) WHERE v <= {number} % {versions}"
    )


def _as_of(rows: str, key: str, name: str, history: str) -> str:
    """`rows` with the version that started last, unless it has ended."""
    return (
        f"SELECT r.*, CASE WHEN h.valid_to IS NULL OR h.valid_to > r.service_day THEN h.{name} END AS {name} "
        f"FROM {rows} r LEFT JOIN {history} h ON h.version_key = r.{key} AND h.valid_from <= r.service_day "
        "QUALIFY row_number() OVER (PARTITION BY r.claim_key ORDER BY h.valid_from DESC NULLS LAST, h.v DESC) = 1"
    )


def _orphans(suffix: str = "") -> str:
    relations = {
        "dim_date": ["date_key"],
        "dim_member": ["member_key", "payer_id"],
        "dim_provider": ["provider_key"],
        "dim_diagnosis": ["diagnosis_key"],
    }
    parts = []
    for name, keys in relations.items():
        same = " AND ".join(f"f.{k} = d.{k}" for k in keys)
        known = " AND ".join(f"f.{k} IS NOT NULL" for k in keys)
        parts.append(
            f"SELECT '{name}' AS dimension, count(DISTINCT ({', '.join('f.' + k for k in keys)})) AS orphan_keys, "
            f"count(*) AS orphan_rows FROM fact_claims f "
            f"WHERE {known} AND NOT EXISTS (SELECT 1 FROM {name}{suffix} d WHERE {same})"
        )
    return "\nUNION ALL ".join(parts)


def _repeated() -> str:
    keys = {
        "dim_date": "date_key", "dim_member": "member_key", "dim_provider": "provider_key",
        "dim_diagnosis": "diagnosis_key", "fact_claims": "claim_key",
    }
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST({key} AS VARCHAR) AS key_value, count(*) AS copies "
        f"FROM {name} GROUP BY {key} HAVING count(*) > 1"
        for name, key in keys.items()
    )


def _quality(source: str) -> str:
    return (
        "SELECT count(*) AS rows, "
        "100.0::DOUBLE * (count(claim_id) + count(member_id) + count(provider_id) + count(service_date)) "
        "/ (4 * count(*)) AS completeness, "
        "100.0::DOUBLE * count(DISTINCT claim_id) / count(*) AS uniqueness, "
        f"100.0::DOUBLE * count(*) FILTER (WHERE NOT coalesce({BROKEN}, false)) / count(*) AS validity, "
        "100.0::DOUBLE * count(*) FILTER (WHERE ingestion_ts >= CAST(service_date AS TIMESTAMP) "
        "AND ingestion_ts <= CAST(service_date AS TIMESTAMP) + INTERVAL 30 DAY) / count(*) AS timeliness "
        f"FROM {source}"
    )


RAW_STD = C | {"std": _standard("claims", masked=False)}
QUALITY = RAW_STD | {"metrics": _quality("std")}
GATE = "concat_ws(', ', " + ", ".join(
    f"CASE WHEN NOT coalesce({m} >= 95.0, false) THEN '{m}' END"
    for m in ("completeness", "uniqueness", "validity", "timeliness")
) + ")"

QUARANTINE = f"SELECT *, {FLAG_COLUMNS}, {ERRORS} AS _validation_errors FROM std"
PRESERVED = ", ".join(
    f"CASE WHEN {f} IS NOT NULL THEN sha256(concat_ws('|', {f}, 'SALT_2024')) END AS {f}"
    for f in ("member_id", "provider_id")
)
REQUIRED = ("claim_id", "member_id", "provider_id", "service_date")
MISSING = ", ".join(f"CASE WHEN {f} IS NULL THEN '{f}' END" for f in REQUIRED)

# Batch A: providers ending in an even digit.  Batch B: all claims, paid + 1.
SECOND_TS = "TIMESTAMP '2024-01-02 00:00:00'"
BATCH_FIELDS = [*CLAIM_FIELDS, "_ingested_at", "_ingested_by", "_batch_id", "_is_deleted", "year", "month"]
TWO_BATCHES = C | {
    "even": "SELECT * FROM claims WHERE right(provider_id, 1) IN ('0', '2', '4', '6', '8')",
    "corrected": "SELECT * REPLACE (paid_amount + 1 AS paid_amount) FROM claims",
    "batch_a": _latest_keeping("even"),
    "batch_b": _latest_keeping("corrected"),
    "stored": (
        f"SELECT *, {_audit()}, {MONTH_OF} FROM batch_a UNION ALL "
        f"SELECT *, {_audit('20240102000000', SECOND_TS)}, {MONTH_OF} FROM batch_b"
    ),
}

MEMBERS = """
SELECT 'MBR' || lpad(CAST(c_custkey AS STRING), 7, '0') AS member_id,
       'PAYER_00' || CAST(c_custkey % 4 + 1 AS STRING) AS payer_id, n_name AS state, c_mktsegment AS segment
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""
PROVIDERS = """
SELECT 'PRV' || lpad(CAST(s_suppkey AS STRING), 6, '0') AS provider_id,
       lpad(CAST(s_suppkey AS STRING), 10, '0') AS npi_number,
       CASE s_suppkey % 3 WHEN 0 THEN 'cardiology' WHEN 1 THEN 'family' ELSE 'radiology' END AS specialty, n_name AS state
FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""

# The gate sees what Silver received; valid are the claims its rules let through.
RUN_LOG = FROM_BRONZE | {
    "received": _standard("bronze", masked=False),
    "metrics": _quality("received").replace(
        f"count(*) FILTER (WHERE NOT coalesce({BROKEN}, false))", f"(SELECT count(*) FROM std WHERE NOT {BROKEN})"
    ),
}

# A wider batch after the first; every copy is as new as its original.
WIDER = STORED | {
    "wider": "SELECT * REPLACE (paid_amount + 1 AS paid_amount), 'TIER_' || right(payer_id, 1) AS network_tier FROM claims",
    "two_loads": f"SELECT *, {_audit()}, {MONTH_OF}, CAST(NULL AS VARCHAR) AS network_tier FROM claims UNION ALL BY NAME "
    f"SELECT *, {_audit()}, {MONTH_OF} FROM wider",
    "both_std": _standard("two_loads"),
    "both_valid": f"SELECT * FROM both_std WHERE NOT {BROKEN} AND year = 2001 AND month = 5",
    "both_latest": _latest("both_valid", "ingestion_ts", [*CLAIM_FIELDS, "network_tier"]),
    "both_silver": f"SELECT *, {ENRICHED}, {PROCESSED} FROM both_latest",
}

# Late claims of two months, corrected; the newer load wins.
LATE_MONTHS = "year * 100 + month IN (200105, 199903)"
LATE = TWO_BATCHES | {
    "late": "SELECT * REPLACE (paid_amount + 1 AS paid_amount) FROM claims "
    "WHERE year(service_date) * 100 + month(service_date) IN (200105, 199903)",
    "first_batch": _latest_keeping("claims"),
    "late_batch": _latest_keeping("late"),
    "loaded": (
        f"SELECT *, {_audit()}, {MONTH_OF} FROM first_batch UNION ALL "
        f"SELECT *, {_audit('20240102000000', SECOND_TS)}, {MONTH_OF} FROM late_batch"
    ),
    "std": _standard("loaded"),
    "valid": f"SELECT * FROM std WHERE NOT {BROKEN}",
    "before": _latest(f"(SELECT * FROM valid WHERE _ingested_at = {RUN_TS})", "_ingested_at", BATCH_FIELDS),
    "again": _latest(f"(SELECT * FROM valid WHERE {LATE_MONTHS})", "_ingested_at", BATCH_FIELDS, extra=", year, month"),
    "kept": f"SELECT * FROM before WHERE NOT {LATE_MONTHS} UNION ALL SELECT * FROM again",
}

LATE_STAR = LATE | {"silver": f"SELECT *, {ENRICHED}, {PROCESSED} FROM kept"} | _star()

AS_OF = GOLD | {
    "providers": _history("supplier", "s_suppkey", "PRV", 6, ("cardiology", "family", "radiology"), "specialty", 4, "1992-06-01 900 420"),
    "members": _history("customer", "c_custkey", "MBR", 7, ("gold", "silver", "bronze"), "plan", 3, "1993-01-01 700 500"),
    "dated": "SELECT *, strptime(CAST(date_key AS STRING), '%Y%m%d')::DATE AS service_day FROM fact_claims",
    "with_specialty": _as_of("dated", "provider_key", "specialty", "providers"),
    "with_both": _as_of("with_specialty", "member_key", "plan", "members"),
}

# Distances of each month's amounts to the month before, on the quantiles i / 128.
SHIFTS = STORED | {
    "amounts": " UNION ALL ".join(
        f"SELECT year, month, year * 12 + month AS number, '{a}' AS amount, {a} AS value FROM bronze"
        for a in ("billed_amount", "allowed_amount", "paid_amount")
    ),
    "counts": "SELECT year, month, number, amount, count(value) AS observed FROM amounts GROUP BY ALL",
    "ranked": "SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY number, amount) AS n FROM amounts "
    "WHERE value IS NOT NULL WINDOW w AS (PARTITION BY number, amount ORDER BY value)",
    "quantiles": "SELECT number, amount, value FROM ranked JOIN range(1, 128) g(i) ON r = (n * i + 127) // 128",
    "sides": "SELECT number, amount, value, 1 AS side FROM quantiles "
    "UNION ALL SELECT number + 1, amount, value, -1 FROM quantiles",
    "gaps": "SELECT number, amount, side, sum(side) OVER (PARTITION BY number, amount ORDER BY value "
    "RANGE UNBOUNDED PRECEDING) AS gap FROM sides",
    "shifts": "SELECT number, amount, CAST(max(abs(gap)) AS DOUBLE) / 128 AS shift FROM gaps GROUP BY ALL "
    "HAVING count(DISTINCT side) = 2",
}

# Tombstones of the second day remove all versions of the first; those of the third come back.
THIRD_TS = "TIMESTAMP '2024-01-03 00:00:00'"
DELETES = C | {
    "back": "SELECT * REPLACE (paid_amount / 2 AS paid_amount) FROM claims "
    "WHERE right(claim_id, 1) = '3' AND payer_id = 'PAYER_001'",
    "day_1": _latest_keeping("claims"),
    "day_3": _latest_keeping("back"),
    "loaded": (
        f"SELECT *, {_audit()}, {MONTH_OF} FROM day_1 WHERE claim_id IS NULL OR right(claim_id, 1) NOT IN ('2', '3') "
        f"UNION ALL SELECT *, {_audit('20240103000000', THIRD_TS)}, {MONTH_OF} FROM day_3"
    ),
    "std": _standard("loaded"),
    "valid": f"SELECT * FROM std WHERE NOT {BROKEN}",
    "latest": _latest("valid", "_ingested_at", BATCH_FIELDS),
    "silver": f"SELECT *, {ENRICHED}, {PROCESSED} FROM latest",
    "month_silver": "SELECT * FROM silver WHERE claim_year = 2001 AND claim_month = 5",
}
CODES = "SELECT DISTINCT upper(trim(diagnosis_code)) AS code FROM claims WHERE diagnosis_code IS NOT NULL"
REFERENCE = GOLD | {
    "codes": CODES,
    "reference": (
        "SELECT DISTINCT left(code, 1) AS prefix, 'Chapter ' || left(code, 1) AS known FROM codes WHERE left(code, 1) <> 'Z' "
        "UNION SELECT left(code, 3), 'Category ' || left(code, 3) FROM codes WHERE left(code, 1) > 'I' "
        "UNION SELECT replace(code, '.', ''), 'Code ' || code FROM codes WHERE left(code, 1) IN ('K', 'M')"
    ),
    "described": (
        "SELECT diagnosis_code, known FROM dim_diagnosis JOIN reference "
        "ON starts_with(replace(diagnosis_code, '.', ''), prefix) "
        "QUALIFY row_number() OVER (PARTITION BY diagnosis_code ORDER BY length(prefix) DESC) = 1"
    ),
}


def _message_rejects(other: str, unreadable: str) -> str:
    """Lines by reject reason, and the claims that Bronze keeps."""
    return _with(
        C | {
            "clean": "SELECT * FROM claims WHERE payer_id IN ('PAYER_001', 'PAYER_004')",
            "kept": _latest_keeping("clean"),
        },
        f"SELECT '{other}' AS reason, count(*) AS lines FROM claims WHERE payer_id = 'PAYER_002' UNION ALL "
        f"SELECT '{unreadable}' AS reason, count(*) AS lines FROM claims WHERE payer_id = 'PAYER_003' UNION ALL "
        "SELECT CAST(NULL AS VARCHAR) AS reason, count(*) AS lines FROM kept",
    )


ORACLES: dict[str, str] = {
    "claims_source": CLAIMS,
    "claims_contract_rejects": _with(
        C,
        f"SELECT *, concat_ws(', ', {MISSING}) AS _contract_violations FROM claims WHERE "
        + " OR ".join(f"{f} IS NULL" for f in REQUIRED),
    ),
    "bronze_audit": _with(C, f"SELECT *, {_audit()}, {MONTH_OF} FROM claims"),
    "bronze_dedup": _with(C, _latest("claims", "ingestion_ts", CLAIM_FIELDS)),
    "bronze_job": _with(BRONZE, "SELECT * FROM bronze"),
    "bronze_append_two_batches": _with(TWO_BATCHES, _latest("stored", "_ingested_at", BATCH_FIELDS)),
    "bronze_schema_evolution": _with(
        C,
        f"SELECT *, {MONTH_OF}, CAST(NULL AS VARCHAR) AS network_tier FROM claims UNION ALL BY NAME "
        f"SELECT *, {MONTH_OF}, 'TIER_' || right(payer_id, 1) AS network_tier FROM claims",
    ),
    "bronze_month_scan": _with(
        C,
        f"SELECT *, {_audit()}, {MONTH_OF} FROM claims WHERE year(service_date) = 2001 AND month(service_date) = 5",
    ),
    "bronze_months_touched": _with(BRONZE, "SELECT DISTINCT year, month FROM bronze"),
    "bronze_members": _with(
        {"feed": MEMBERS, "latest": _latest("feed", "", ["payer_id", "state", "segment"], "member_id")},
        f"SELECT *, {_audit(entity='members')} FROM latest",
    ),
    "bronze_providers": _with(
        {"feed": PROVIDERS, "latest": _latest("feed", "", ["npi_number", "specialty", "state"], "provider_id")},
        f"SELECT *, {_audit(entity='providers')} FROM latest",
    ),
    "csv_roundtrip": CLAIMS,
    "json_roundtrip": CLAIMS,
    "parquet_roundtrip": CLAIMS,
    "bronze_source_file": "SELECT 'lineitem.parquet' AS file_name, count(*) AS row_count FROM lineitem",
    "json_unknown_fields": _with(
        C,
        "SELECT *, CASE WHEN payer_id = 'PAYER_001' THEN 'TIER_' || right(provider_id, 1) END AS network_tier FROM claims",
    ),
    "json_feed_with_rejects": _with(
        C | {
            "known": "SELECT * FROM claims WHERE payer_id <> 'PAYER_001' AND "
            + " AND ".join(f"{f} IS NOT NULL" for f in REQUIRED),
            "latest": _latest("known", "ingestion_ts", CLAIM_FIELDS),
        },
        f"SELECT *, {_audit()}, {MONTH_OF} FROM latest",
    ),
    "bronze_rejects": _with(
        C,
        f"SELECT *, concat_ws(', ', {MISSING}) AS _contract_violations, {_audit()} FROM claims WHERE "
        + " OR ".join(f"{f} IS NULL" for f in REQUIRED),
    ),
    "bronze_bucketed": _with(BRONZE, "SELECT * FROM bronze"),
    "bronze_unknown_fields": _with(
        BRONZE,
        "SELECT *, CASE WHEN payer_id = 'PAYER_001' THEN 'TIER_' || right(provider_id, 1) END AS network_tier FROM bronze",
    ),
    "bronze_fhir": _with(BRONZE, "SELECT * FROM bronze"),
    "bronze_hl7": _with(BRONZE, "SELECT * FROM bronze"),
    "fhir_rejects": _message_rejects("other resource", "unreadable entry"),
    "hl7_rejects": _message_rejects("other delimiters or no MSH", "unreadable: allowed_amount"),
    "bronze_batch_twice": _with(TWO_BATCHES, "SELECT * FROM stored"),
    "bronze_stream": _with(BRONZE, "SELECT * FROM first_load"),
    "quarantine_twice": _with(
        STORED,
        f"SELECT *, {FLAG_COLUMNS}, {ERRORS} AS _validation_errors, '2001-0' || CAST(month AS VARCHAR) AS _scope "
        f"FROM std WHERE {BROKEN} AND year = 2001 AND month IN (5, 6)",
    ),
    "silver_deletes": _with(DELETES, "SELECT * FROM silver"),
    "gold_deletes_month": _with(DELETES | _star("month_silver"), "SELECT * FROM fact_claims"),
    "gold_dim_diagnosis_reference": _with(
        REFERENCE,
        "SELECT d.* REPLACE (coalesce(known, description) AS description) FROM dim_diagnosis d "
        "LEFT JOIN described USING (diagnosis_code)",
    ),
    "silver_stored": _with(STORED, "SELECT * FROM silver"),
    "silver_schema_evolution": _with(
        WIDER,
        "SELECT * FROM silver WHERE NOT (claim_year = 2001 AND claim_month = 5) "
        "UNION ALL BY NAME SELECT * FROM both_silver",
    ),
    "silver_rerun_touched": _with(LATE, f"SELECT *, {ENRICHED}, {PROCESSED} FROM kept"),
    "silver_rerun_vanished": _with(
        LATE, f"SELECT *, {ENRICHED}, {PROCESSED} FROM before WHERE NOT ({LATE_MONTHS} AND payer_id = 'PAYER_004')"
    ),
    "quarantine_job_with_unknown": _with(
        STORED | {
            "of_month": "SELECT * FROM bronze WHERE year = 2001 AND month = 5",
            "plain_std": _standard("of_month", masked=False),
            "flagged": f"SELECT *, {FLAG_COLUMNS}, {ERRORS} AS _validation_errors FROM plain_std "
            f"WHERE {BROKEN} OR {BROKEN} IS NULL",
        },
        f"SELECT * REPLACE ({PRESERVED}, CASE WHEN _validation_errors = '' THEN 'unknown' "
        "ELSE _validation_errors END AS _validation_errors) FROM flagged",
    ),
    "mask_pii": _with(
        C,
        "SELECT * REPLACE (sha256(concat_ws('|', member_id, 'SALT_2024')) AS member_id, "
        "sha256(concat_ws('|', provider_id, 'SALT_2024')) AS provider_id) FROM claims",
    ),
    "mask_pii_preserve_null": _with(C, f"SELECT * REPLACE ({PRESERVED}) FROM claims"),
    "standardize_codes": _with(RAW_STD, "SELECT * FROM std"),
    "validation_flag_counts": _with(
        STD, "SELECT " + ", ".join(f"count(*) FILTER (WHERE {f}) AS {n}" for n, f in FLAGS.items()) + " FROM std"
    ),
    "silver_valid": _with(VALID, "SELECT * FROM valid"),
    "quarantine_rows": _with(STD, f"{QUARANTINE} WHERE {BROKEN}"),
    "quarantine_rows_with_unknown": _with(
        STD | {"flagged": f"{QUARANTINE} WHERE {BROKEN} OR {BROKEN} IS NULL"},
        "SELECT * REPLACE (CASE WHEN _validation_errors = '' THEN 'unknown' ELSE _validation_errors END "
        "AS _validation_errors) FROM flagged",
    ),
    "validation_lost_rows": _with(STD, f"SELECT * FROM std WHERE {BROKEN} IS NULL"),
    "silver_dedup": _with(SILVER, "SELECT * FROM latest"),
    "enrich": _with(RAW_STD, f"SELECT *, {ENRICHED}, {PROCESSED} FROM std"),
    "silver_job": _with(SILVER, "SELECT * EXCLUDE (_silver_processed_at) FROM silver"),
    "silver_month_job": _with(
        FROM_BRONZE | {
            "month_valid": "SELECT * FROM valid WHERE year = 2001 AND month = 5",
            "month_latest": _latest("month_valid", "ingestion_ts", CLAIM_FIELDS),
        },
        f"SELECT *, {ENRICHED}, {PROCESSED} FROM month_latest",
    ),
    "silver_replace_month": _with(
        ONE_MONTH,
        "SELECT * FROM silver WHERE NOT (claim_year = 2001 AND claim_month = 5) "
        "UNION ALL BY NAME SELECT * FROM month_silver WHERE payer_id <> 'PAYER_004'",
    ),
    "silver_month_scan": _with(STORED, "SELECT * FROM silver WHERE claim_year = 2001 AND claim_month = 5"),
    "medallion_end_to_end": _with(FROM_BRONZE, "SELECT * FROM silver"),
    **{
        f"gold_{table}": _with(GOLD, f"SELECT * FROM {table}")
        for table in ("dim_date", "dim_member", "dim_provider", "dim_diagnosis", "fact_claims")
    },
    "gold_load_month": _with(GOLD_AND_MONTH, "SELECT * FROM fact_claims_month"),
    "run_metrics": _with(
        RUN_LOG,
        "SELECT 'claims' AS pipeline, '2024-01-01 00:00:00' AS execution_date, "
        "(SELECT count(*) FROM bronze) AS bronze_records, "
        "(SELECT count(*) FROM bronze) AS silver_input_records, "
        "(SELECT count(*) FROM silver) AS silver_records, "
        f"(SELECT count(*) FROM std WHERE {BROKEN}) AS quarantined_records, "
        f"(SELECT count(*) FROM std WHERE {BROKEN} IS NULL) AS undecided_records, "
        "(SELECT count(*) FROM silver) AS fact_records, "
        "completeness, uniqueness, validity, timeliness, 'SUCCESS' AS status, "
        f"{RUN_TS} AS logged_at FROM metrics",
    ),
    "profile_months": _with(
        STORED,
        "SELECT year, month, count(*) AS claims, count(DISTINCT claim_id) AS ids, count(billed_amount) AS billed "
        "FROM bronze GROUP BY year, month",
    ),
    "profile_shifts": _with(
        SHIFTS,
        "SELECT n.year, n.month, n.amount, n.observed, b.observed AS observed_before, shift, "
        "CASE WHEN shift IS NOT NULL THEN 0.1e0 + 1.63e0 * sqrt(1e0 / n.observed + 1e0 / b.observed) END AS allowed, "
        "coalesce(shift > allowed, false) AS drifted FROM counts n "
        "LEFT JOIN counts b ON b.number = n.number - 1 AND b.amount = n.amount "
        "LEFT JOIN shifts s ON s.number = n.number AND s.amount = n.amount",
    ),
    "dq_metrics": _with(QUALITY, "SELECT * FROM metrics"),
    "dq_gate": _with(
        QUALITY, f"SELECT *, {GATE} AS failed_checks, {GATE} = '' AS passed FROM metrics"
    ),
    "mart_monthly_payer": _with(GOLD, _monthly()),
    "mart_denials_by_category": _with(
        GOLD,
        DENIALS,
    ),
    "mart_since_start_date": _with(GOLD, _monthly("WHERE d.full_date >= DATE '1998-01-01'")),
    "mart_star_read": _with(
        GOLD,
        "SELECT f.*, t.full_date, t.month_name, t.day_name, t.is_weekend, m.member_id_hash, "
        "p.provider_id_hash, g.icd10_code, g.category FROM fact_claims f "
        "JOIN dim_date t ON f.date_key = t.date_key "
        "JOIN dim_member m ON f.member_key = m.member_key AND f.payer_id IS NOT DISTINCT FROM m.payer_id "
        "JOIN dim_provider p ON f.provider_key = p.provider_key "
        "LEFT JOIN dim_diagnosis g ON f.diagnosis_key = g.diagnosis_key",
    ),
    "mart_asof_provider": _with(AS_OF, f"SELECT specialty, {TOTALS} FROM with_specialty f GROUP BY specialty"),
    "mart_asof_member": _with(AS_OF, f"SELECT plan, {TOTALS} FROM with_both f GROUP BY plan"),
    "star_read_asof": _with(
        AS_OF, "SELECT claim_key, provider_key, member_key, date_key, service_day, specialty, plan FROM with_both"
    ),
    "mart_incremental_payer": _with(LATE_STAR, _monthly()),
    "mart_incremental_denials": _with(LATE_STAR, DENIALS),
    "check_orphan_keys": _with(GOLD, _orphans()),
    "check_orphan_keys_month": _with(GOLD_AND_MONTH, _orphans("_month")),
    "check_unique_keys": _with(GOLD, _repeated()),
    "check_not_null": _with(
        GOLD,
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM fact_claims"
            for c in ("claim_key", "member_key", "provider_key", "date_key", "diagnosis_key")
        ),
    ),
    "check_accepted_values": _with(
        RAW_STD,
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS row_count FROM std WHERE {flag} GROUP BY {c}"
            for c, flag in (
                ("claim_type", FLAGS["invalid_claim_type"]),
                ("claim_status", FLAGS["invalid_status"]),
            )
        ),
    ),
}
