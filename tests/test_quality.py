import datetime as dt

import pytest

from claimstrata.operators import checks
from claimstrata.operators.quality import dq_gate, dq_metrics, enforce_gate
from claimstrata.operators.silver import standardize_codes
from claimstrata.plans.gold import star_schema
from claimstrata.plans.medallion import run_medallion
from claimstrata.plans.silver import SilverOptions, silver_rows
from conftest import cells

AS_OF = dt.date(2001, 6, 30)
MAY = dt.datetime(2001, 5, 31, 2)
OPTIONS = SilverOptions(as_of=AS_OF, run_ts=dt.datetime(2024, 1, 1), order_field="ingestion_ts")


def metrics(df):
    return dq_metrics(standardize_codes(df), AS_OF)


def test_clean_rows_pass(claims):
    assert enforce_gate(metrics(claims({}, {"claim_id": "2"}))) == {
        "completeness": 100.0,
        "uniqueness": 100.0,
        "validity": 100.0,
        "timeliness": 100.0,
    }


def test_each_metric(claims):
    late, early = dt.datetime(2001, 6, 3), dt.datetime(2001, 5, 1)
    df = claims(
        {}, {"member_id": None}, {"claim_id": "2", "ingestion_ts": late}, {"claim_id": "3", "ingestion_ts": early}
    )
    row = metrics(df).first()
    assert row["completeness"] == 93.75
    assert row["uniqueness"] == 75.0
    assert row["validity"] == 75.0
    assert row["timeliness"] == 50.0
    gate = dq_gate(metrics(df)).first()
    assert (gate["failed_checks"], gate["passed"]) == ("completeness, uniqueness, validity, timeliness", False)


def test_gate_names_the_failures(claims):
    with pytest.raises(ValueError, match="uniqueness$"):
        enforce_gate(metrics(claims({}, {})))


def test_gate_is_inclusive(claims):
    nineteen = [{"claim_id": str(n)} for n in range(19)]
    df = claims(*nineteen, {"claim_id": "19", "claim_type": "rx"})
    assert dq_gate(metrics(df)).first()["passed"]


def test_no_rows_fail(claims):
    row = dq_gate(metrics(claims({}).where("false"))).first()
    assert row["validity"] is None and not row["passed"]


def test_null_counts(claims):
    df = claims({}, {"payer_id": None})
    assert cells(checks.null_counts(df, ["claim_id", "payer_id"])) == [("claim_id", 0), ("payer_id", 1)]


def test_repeated_keys(claims):
    df = claims({}, {}, {"claim_id": "2"}, {"claim_id": None}, {"claim_id": None})
    assert cells(checks.repeated_keys(df, "claim_id")) == [("CLM1", 2), (None, 2)]


def test_unaccepted_values_ignore_null(claims):
    df = claims({}, {"claim_type": "rx"}, {"claim_type": None})
    assert cells(checks.unaccepted_values(df, {"claim_type": ["inpatient"]})) == [("claim_type", "rx", 1)]


def test_orphans(claims):
    silver = silver_rows(claims({}, {"claim_id": "2", "provider_id": "PRV2", "diagnosis_code": None}), OPTIONS)
    star = star_schema(silver)
    assert {r["orphan_rows"] for r in checks.orphan_rows(star["fact_claims"], star).collect()} == {0}
    partial = star | {"dim_provider": star["dim_provider"].where("false")}
    found = {r["dimension"]: (r["orphan_keys"], r["orphan_rows"]) for r in checks.orphan_rows(star["fact_claims"], partial).collect()}
    assert found["dim_provider"] == (2, 2) and found["dim_diagnosis"] == (0, 0)


def test_daily_run_and_log(spark, claims, layers):
    df = claims({}, {"claim_id": "2", "claim_status": "denied"}, {"claim_id": "3", "claim_type": "rx"})
    summary = run_medallion(spark, df, MAY, layers, options=OPTIONS, threshold=60)
    assert (summary["bronze_records"], summary["silver_records"]) == (3, 2)
    assert (summary["quarantined_records"], summary["fact_records"]) == (1, 2)
    run_medallion(spark, df, MAY, layers, options=OPTIONS, threshold=40)
    log = spark.table(layers.table("run_log"))
    assert cells(log, "bronze_records", "silver_records", "status") == [(3, 2, "SUCCESS")] * 2
    assert spark.table(layers.table("fact_claims")).count() == 2


def test_gate_sees_what_was_set_aside(spark, claims, layers):
    run_medallion(spark, claims({}), MAY, layers, options=OPTIONS)
    invalid = [{"claim_id": f"i{k}", "claim_type": "rx"} for k in range(30)]
    undecided = [{"claim_id": f"u{k}", "claim_type": None} for k in range(30)]
    with pytest.raises(ValueError, match="validity"):
        run_medallion(spark, claims({"claim_id": "new"}, *invalid, *undecided), MAY, layers, options=OPTIONS)
    assert cells(spark.table(layers.table("fact_claims")), "claim_id") == [("CLM1",)]


def test_failed_gate_leaves_gold_alone(spark, claims, layers):
    late = {"ingestion_ts": dt.datetime(2001, 8, 1)}
    with pytest.raises(ValueError, match="timeliness"):
        run_medallion(spark, claims(late), MAY, layers, options=OPTIONS)
    assert not spark.catalog.tableExists(layers.table("fact_claims"))
