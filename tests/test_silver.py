import datetime as dt
import hashlib

import pytest

from claimstrata.operators.bronze import add_audit_columns
from claimstrata.operators.silver import (
    apply_cdc_dedup,
    apply_validation_rules,
    enrich,
    mask_pii,
    standardize_codes,
)
from claimstrata.plans.bronze import run_bronze
from claimstrata.plans.silver import (
    SilverOptions,
    quarantine_rows,
    rerun_touched,
    run_silver,
    silver_rows,
)
from conftest import cells

AS_OF = dt.date(2001, 6, 30)
RUN = dt.datetime(2024, 1, 1)
OPTIONS = SilverOptions(as_of=AS_OF, run_ts=RUN)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_masking(claims):
    row = mask_pii(claims({"member_id": None})).first()
    assert (row["member_id"], row["provider_id"]) == (sha("SALT_2024"), sha("PRV1|SALT_2024"))


def test_masking_can_keep_null_and_change_salt(claims):
    row = mask_pii(claims({"member_id": None}), salt="s", preserve_null=True).first()
    assert (row["member_id"], row["provider_id"]) == (None, sha("PRV1|s"))


def test_masking_skips_absent_fields(claims):
    assert "member_id" not in mask_pii(claims({}).drop("member_id")).columns


@pytest.mark.parametrize(
    "raw, wanted", [("  123 ", "00123"), ("1234567", "12345"), ("", "00000"), (None, None)]
)
def test_procedure_codes(claims, raw, wanted):
    assert standardize_codes(claims({"procedure_code": raw})).first()["procedure_code"] == wanted


def test_standard_codes(claims):
    raw = {"diagnosis_code": " j06.9 ", "claim_type": " InPatient", "claim_status": "PAID "}
    row = standardize_codes(claims(raw)).first()
    assert (row["diagnosis_code"], row["claim_type"], row["claim_status"]) == ("J06.9", "inpatient", "paid")
    assert row["service_date"] == dt.date(2001, 5, 3)


def validated(df, **options):
    return apply_validation_rules(standardize_codes(df), AS_OF, **options)


RULES = {
    "claim_id_null": {"claim_id": None},
    "member_id_null": {"member_id": None},
    "invalid_claim_type": {"claim_type": "rx"},
    "invalid_status": {"claim_status": "unknown"},
    "negative_amount": {"billed_amount": -1.0, "paid_amount": -2.0},
    "future_date": {"service_date": dt.datetime(2001, 7, 1)},
    "paid_exceeds_billed": {"paid_amount": 100.01},
}


@pytest.mark.parametrize("rule", RULES)
def test_each_rule_alone(claims, rule):
    valid, invalid = validated(claims(RULES[rule]))
    assert valid.count() == 0
    row = invalid.first()
    assert row["_validation_errors"] == rule
    assert [c for c in invalid.columns if c.startswith("_v_") and row[c]] == ["_v_" + rule]


def test_last_allowed_day_and_voided_are_valid(claims):
    day = {"service_date": dt.datetime(2001, 6, 30, 23, 59), "claim_status": "voided"}
    assert validated(claims(day))[0].count() == 1


def test_errors_follow_rule_order(claims):
    invalid = validated(claims({"claim_type": "rx", "paid_amount": 500.0}))[1]
    assert cells(invalid, "_validation_errors") == [("invalid_claim_type, paid_exceeds_billed",)]


def test_undecided_rows_vanish_by_default(claims):
    valid, invalid = validated(claims({"claim_type": None}))
    assert (valid.count(), invalid.count()) == (0, 0)


def test_undecided_but_broken_row_is_quarantined(claims):
    invalid = validated(claims({"claim_type": None, "paid_amount": 500.0}))[1]
    assert cells(invalid, "_validation_errors", "_v_invalid_claim_type") == [("paid_exceeds_billed", None)]


def test_undecided_rows_can_be_quarantined(claims):
    df = claims({}, {"claim_type": None}, {"billed_amount": None}, {"claim_status": "x"})
    valid, invalid = validated(df, null_flags="quarantine")
    assert valid.count() + invalid.count() == df.count()
    assert cells(invalid, "_validation_errors") == [("invalid_status",), ("unknown",), ("unknown",)]


def test_unknown_null_mode_is_refused(claims):
    with pytest.raises(ValueError, match="null_flags"):
        validated(claims({}), null_flags="other")


def test_valid_side_has_no_flags(claims):
    assert not [c for c in validated(claims({}))[0].columns if c.startswith("_v_")]


@pytest.mark.parametrize(
    "billed, allowed, wanted",
    [(100.0, 80.0, 0.2), (0.0, 1.0, None), (None, 1.0, None), (-5.0, 1.0, None), (3.0, 5.0, -0.6667)],
)
def test_discount_rate(claims, billed, allowed, wanted):
    df = claims({"billed_amount": billed, "allowed_amount": allowed})
    assert enrich(standardize_codes(df), RUN).first()["discount_rate"] == wanted


def test_enriched_columns(claims):
    row = enrich(standardize_codes(claims({"claim_status": "denied"})), RUN).first()
    parts = ("claim_year", "claim_month", "claim_quarter", "is_denied", "_silver_processed_at")
    assert tuple(row[p] for p in parts) == (2001, 5, 2, True, RUN)


def test_null_status_is_neither_denied_nor_not(claims):
    assert enrich(standardize_codes(claims({"claim_status": None})), RUN).first()["is_denied"] is None


def test_later_batch_wins(claims):
    first = add_audit_columns(claims({"paid_amount": 50.0}), "a", dt.datetime(2024, 1, 1))
    second = add_audit_columns(
        claims({"paid_amount": 1.0, "ingestion_ts": dt.datetime(2000, 1, 1)}), "b", dt.datetime(2024, 1, 2)
    )
    assert cells(apply_cdc_dedup(first.unionByName(second)), "paid_amount") == [(1.0,)]


def test_masking_last_equals_masking_first(claims):
    """The plan hashes after deduplication; step by step gives the same rows."""
    df = claims(
        {},
        {"ingestion_ts": dt.datetime(2001, 5, 9), "paid_amount": 7.0},
        {"claim_id": "2", "member_id": None},
        {"claim_id": "3", "claim_type": "rx", "member_id": None},
        {"claim_id": None},
        {"claim_id": "4", "billed_amount": None},
    )
    options = SilverOptions(as_of=AS_OF, run_ts=RUN, order_field="ingestion_ts")
    valid, invalid = validated(mask_pii(df))
    stepwise = enrich(apply_cdc_dedup(valid, "ingestion_ts"), RUN)
    planned = silver_rows(df, options)
    assert planned.columns == stepwise.columns
    assert cells(planned) == cells(stepwise)
    rejected = quarantine_rows(df, options)
    assert rejected.columns == invalid.columns
    assert cells(rejected) == cells(invalid)


def test_member_rule_fires_when_nulls_are_kept(claims):
    options = SilverOptions(as_of=AS_OF, run_ts=RUN, preserve_null=True, order_field="ingestion_ts")
    df = claims({}, {"claim_id": "2", "member_id": None})
    assert silver_rows(df, options).count() == 1
    assert cells(quarantine_rows(df, options), "_validation_errors") == [("member_id_null",)]


def test_invalid_newest_version(spark, claims, layers):
    """Within a batch the newest version counts even if invalid; across batches
    an older valid one survives."""
    newer = {"ingestion_ts": dt.datetime(2001, 6, 1), "claim_type": "rx"}
    run_bronze(claims({}, newer), RUN, layers, RUN)
    run_silver(spark, layers, 2001, 5, OPTIONS)
    assert spark.table(layers.table("silver")).count() == 0
    run_bronze(claims({}), RUN + dt.timedelta(days=1), layers, RUN + dt.timedelta(days=1))
    run_bronze(claims(newer), RUN + dt.timedelta(days=2), layers, RUN + dt.timedelta(days=2))
    run_silver(spark, layers, 2001, 5, OPTIONS)
    assert cells(spark.table(layers.table("silver")), "claim_id", "claim_type") == [("CLM1", "inpatient")]


def test_run_counts(spark, claims, layers):
    df = claims({}, {"claim_id": "2", "claim_type": "rx"}, {"claim_id": "3", "claim_type": None})
    run_bronze(df, RUN, layers, RUN)
    assert run_silver(spark, layers, 2001, 5, OPTIONS) == {
        "input_records": 3,
        "output_records": 1,
        "quarantined": 1,
        "undecided": 1,
        "quality": {"present": 12, "unbroken": 1, "on_time": 3},
        "status": "SUCCESS",
    }


def test_silver_rerun_is_idempotent_and_quarantine_accumulates(spark, claims, layers):
    run_bronze(claims({}, {"claim_id": "2", "claim_type": "rx"}), RUN, layers, RUN)
    run_silver(spark, layers, 2001, 5, OPTIONS)
    before = cells(spark.table(layers.table("silver")))
    run_silver(spark, layers, 2001, 5, OPTIONS)
    assert cells(spark.table(layers.table("silver"))) == before
    assert spark.table(layers.table("quarantine")).count() == 2


def test_repeated_bronze_batch_is_absorbed(spark, claims, layers):
    for _ in range(2):
        run_bronze(claims({}, {"claim_id": "2"}), RUN, layers, RUN)
    assert run_silver(spark, layers, 2001, 5, OPTIONS)["output_records"] == 2


def test_month_run_leaves_other_months(spark, claims, layers):
    april = {"claim_id": "2", "service_date": dt.datetime(2001, 4, 1)}
    run_bronze(claims({}, april), RUN, layers, RUN)
    run_silver(spark, layers, 2001, 4, OPTIONS)
    run_silver(spark, layers, 2001, 5, OPTIONS)
    assert cells(spark.table(layers.table("silver")), "claim_id", "claim_month") == [("2", 4), ("CLM1", 5)]


def test_empty_month_empties_it(spark, claims, layers):
    run_bronze(claims({}), RUN, layers, RUN)
    run_silver(spark, layers, 2001, 5, OPTIONS)
    result = run_silver(spark, layers, 2001, 6, OPTIONS)
    assert (result["input_records"], result["output_records"]) == (0, 0)
    assert spark.table(layers.table("silver")).count() == 1


def test_half_a_month_is_refused(spark, layers):
    with pytest.raises(ValueError, match="year and month"):
        run_silver(spark, layers, 2001)


def test_today_bounds_service_dates_by_default(spark, claims, layers):
    tomorrow = dt.datetime.now() + dt.timedelta(days=2)
    run_bronze(claims({"service_date": tomorrow}), RUN, layers, RUN)
    result = run_silver(spark, layers, tomorrow.year, tomorrow.month)
    assert (result["output_records"], result["quarantined"]) == (0, 1)


def test_silver_schema(spark, claims, layers):
    run_bronze(claims({}), RUN, layers, RUN)
    run_silver(spark, layers, 2001, 5, OPTIONS)
    types = dict(spark.table(layers.table("silver")).dtypes)
    assert types["service_date"] == "date"
    assert {types[c] for c in ("year", "month", "claim_year", "claim_month", "claim_quarter")} == {"int"}
    assert types["is_denied"] == "boolean" and types["discount_rate"] == "double"
    assert {"_ingested_at", "_batch_id", "_silver_processed_at"} <= set(types)


def test_late_claims_arrive_when_their_months_are_rerun(spark, claims, layers):
    march = {"claim_id": "2", "service_date": dt.datetime(2001, 3, 1)}
    batch = run_bronze(claims({}, march), RUN, layers, RUN)["batch_id"]
    other = claims({"claim_id": "3", "service_date": dt.datetime(2001, 1, 1)})
    run_bronze(other, RUN + dt.timedelta(days=1), layers, RUN)
    assert sorted(rerun_touched(spark, layers, batch, OPTIONS)) == [(2001, 3), (2001, 5)]
    assert cells(spark.table(layers.table("silver")), "claim_id") == [("2",), ("CLM1",)]
