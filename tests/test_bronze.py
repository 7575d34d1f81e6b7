import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from claimstrata.operators.bronze import add_audit_columns, batch_id, deduplicate, months_touched
from claimstrata.plans.bronze import bronze_rows, reference_rows, run_bronze, run_reference_feed
from claimstrata.sources.contract import enforce_not_null, split_not_null, validate_schema
from conftest import CLEAN, cells, plan_of

RUN = dt.datetime(2024, 1, 1, 2, 3, 4)


def test_missing_required_column_is_named(claims):
    with pytest.raises(ValueError, match="service_date"):
        validate_schema(claims({}).drop("service_date"))


def test_extra_columns_are_allowed(claims):
    assert validate_schema(claims({}).withColumn("extra", F.lit(1)))


def test_null_in_required_field_stops_the_job(claims):
    with pytest.raises(Exception, match="NULL in required field member_id"):
        enforce_not_null(claims({}, {"member_id": None})).collect()


def test_contract_split_adds_up_and_names_fields(claims):
    good, bad = split_not_null(claims({}, {"claim_id": None}, {"claim_id": None, "member_id": None}))
    assert good.count() == 1
    assert cells(bad, "_contract_violations") == [("claim_id",), ("claim_id, member_id",)]


def test_batch_id_depends_on_time_only():
    assert batch_id(RUN) == "claims_20240101020304_" + hashlib.md5(b"20240101020304").hexdigest()[:8]
    assert batch_id(RUN) == batch_id(RUN)


def test_audit_columns(claims):
    row = add_audit_columns(claims({}), "b7", RUN).first()
    assert (row["_batch_id"], row["_is_deleted"], row["_source_file"]) == ("b7", False, "")
    assert (row["year"], row["month"], row["_ingested_at"]) == (2001, 5, RUN)


def test_audit_uses_the_clock_when_no_time_is_given(claims):
    seen = add_audit_columns(claims({}, {"claim_id": "2"}), "b").select("_ingested_at").distinct()
    assert seen.count() == 1


def test_latest_version_wins(claims):
    old, new = {"paid_amount": 1.0}, {"paid_amount": 2.0, "ingestion_ts": dt.datetime(2001, 6, 1)}
    assert cells(deduplicate(claims(old, new)), "paid_amount") == [(2.0,)]


def test_unknown_timestamp_loses(claims):
    known, unknown = {"paid_amount": 1.0}, {"paid_amount": 9.0, "ingestion_ts": None}
    assert cells(deduplicate(claims(known, unknown)), "paid_amount") == [(1.0,)]


def test_ties_do_not_depend_on_row_order(claims):
    versions = [{"paid_amount": float(n)} for n in range(5)]
    forward, backward = claims(*versions), claims(*reversed(versions)).repartition(5)
    assert cells(deduplicate(forward)) == cells(deduplicate(backward)) != []


def test_rows_without_id_collapse_to_one(claims):
    assert deduplicate(claims({"claim_id": None}, {"claim_id": None}, {})).count() == 2


def test_deduplication_is_idempotent(claims):
    once = deduplicate(claims({}, {"claim_id": "2"}, {"paid_amount": 3.0}))
    assert cells(deduplicate(once)) == cells(once)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A third of the rows share an id, another third has none."""
    row, kind = F.col("id"), F.col("id") % 3
    constant = {k: F.lit(v) for k, v in CLEAN.items() if k not in ("claim_id", "ingestion_ts")}
    skewed = (
        spark.range(0, 9000, 1, 6)
        .withColumns(
            {
                "claim_id": F.when(kind == 0, "HOT").when(kind == 1, F.concat(F.lit("C"), row)),
                "ingestion_ts": F.timestamp_seconds(row * 7919 % 10007),
                **constant,
            }
        )
        .drop("id")
    )
    result = deduplicate(skewed)
    plan = plan_of(result)
    assert plan.count("WindowGroupLimit") == 2
    partial = plan.rindex("WindowGroupLimit")
    assert plan.index("Exchange hashpartitioning(claim_id") < partial
    newest = {}
    for row in skewed.select("claim_id", "ingestion_ts").collect():
        newest[row[0]] = max(newest.get(row[0], row[1]), row[1])
    assert cells(result, "claim_id", "ingestion_ts") == sorted(newest.items(), key=str)


def test_months_touched(claims):
    batch = bronze_rows(claims({}, {"claim_id": "2", "service_date": dt.datetime(2001, 3, 1)}), "b")
    assert cells(months_touched(batch)) == [(2001, 3), (2001, 5)]


def test_run_reports_and_repeats(spark, claims, layers):
    result = run_bronze(claims({}, {}, {"claim_id": "2"}), RUN, layers, RUN)
    assert (result["records_loaded"], result["records_failed"], result["status"]) == (2, 0, "SUCCESS")
    run_bronze(claims({}, {"claim_id": "2"}), RUN, layers, RUN)
    assert spark.table(layers.table("bronze")).count() == 4


def test_run_fails_on_null_by_default(claims, layers):
    with pytest.raises(Exception, match="NULL in required field claim_id"):
        run_bronze(claims({"claim_id": None}), RUN, layers)


def test_run_rejects_nulls_on_request(spark, claims, layers):
    result = run_bronze(claims({}, {"provider_id": None}), RUN, layers, RUN, nulls="reject")
    assert (result["records_loaded"], result["records_failed"]) == (1, 1)
    rejects = spark.table(layers.table("bronze_rejects"))
    assert cells(rejects, "_contract_violations", "_batch_id") == [("provider_id", batch_id(RUN))]


def test_extra_field_reaches_bronze_and_old_rows_read_null(spark, claims, layers):
    run_bronze(claims({}), RUN, layers, RUN)
    run_bronze(claims({"claim_id": "2"}).withColumn("tier", F.lit("gold")), RUN, layers, RUN)
    run_bronze(claims({"claim_id": "3"}), RUN, layers, RUN)
    stored = cells(spark.table(layers.table("bronze")), "claim_id", "tier")
    assert stored == [("2", "gold"), ("3", None), ("CLM1", None)]


def test_empty_batch(spark, claims, layers):
    result = run_bronze(claims({}).where("false"), RUN, layers, RUN)
    assert result["records_loaded"] == 0
    assert spark.table(layers.table("bronze")).count() == 0


def test_reference_feeds(spark, layers):
    members = spark.createDataFrame(
        [("M1", "P1", "s", "x"), ("M1", "P1", "s", "x"), ("M2", None, None, None)],
        "member_id string, payer_id string, state string, segment string",
    )
    assert reference_rows(members, "members", RUN, RUN).count() == 2
    assert run_reference_feed(members, "members", RUN, layers, RUN)["records_loaded"] == 2
    assert "year" not in spark.table(layers.table("bronze_members")).columns
