"""Plan shape of the queries that must hold at scale."""

import datetime as dt
import re

import pytest

import __spark_entry__ as registry
from claimstrata.operators import checks, marts
from claimstrata.operators.sinks import balanced
from claimstrata.plans.bronze import _by_partition, bronze_rows, run_bronze
from claimstrata.plans.gold import star_schema
from claimstrata.plans.silver import SilverOptions, run_silver, silver_rows
from claimstrata.sources.layers import bronze_month, silver_month
from conftest import SF_DIR, cells, plan_of

RUN = dt.datetime(2024, 1, 1)
OPTIONS = SilverOptions(as_of=dt.date(2001, 6, 30), run_ts=RUN)


@pytest.fixture
def stored(spark, claims, layers):
    run_bronze(claims({}, {"claim_id": "2", "service_date": dt.datetime(2001, 4, 1)}), RUN, layers, RUN)
    run_silver(spark, layers, options=OPTIONS)
    return layers


def shuffles(plan):
    return len(re.findall(r"Exchange (?:hashpartitioning|SinglePartition|rangepartitioning|RoundRobin)", plan))


@pytest.mark.parametrize("name", ["silver_job", "bronze_dedup", "gold_fact_claims", "dq_metrics"])
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(registry.queries()[name](spark, SF_DIR))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_month_scans_list_one_month(spark, stored):
    for scan, column in ((bronze_month, "year"), (silver_month, "claim_year")):
        table = stored.table("bronze" if column == "year" else "silver")
        plan = plan_of(scan(spark, table, 2001, 5))
        assert "InMemoryFileIndex(1 paths)" in plan
        assert re.search(rf"PartitionFilters: \[.*{column}#\d+ = 2001", plan)


def test_silver_month_has_one_shuffle_and_pushes_rules(spark, stored):
    plan = plan_of(silver_rows(bronze_month(spark, stored.table("bronze"), 2001, 5), OPTIONS))
    assert shuffles(plan) == 1
    assert plan.count("WindowGroupLimit") == 2
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "IsNotNull(claim_id)" in pushed and "GreaterThanOrEqual(billed_amount" in pushed


def test_hashing_comes_after_the_shuffle(spark, stored):
    plan = plan_of(silver_rows(spark.table(stored.table("bronze")), OPTIONS))
    assert plan.index("sha2(") < plan.index("Exchange hashpartitioning(claim_id")
    assert plan.count("sha2(") == 2


def test_stamps_come_after_the_bronze_shuffles(claims):
    plan = plan_of(bronze_rows(claims({}), "b", run_ts=RUN, nulls="keep", layout=_by_partition))
    rebalance = plan.index("REBALANCE_PARTITIONS_BY_COL")
    assert rebalance < plan.index("Exchange hashpartitioning(claim_id")
    assert plan.index("_ingested_by") < rebalance and "_ingested_by" not in plan[rebalance:]


def test_write_is_rebalanced_by_partition(spark, stored):
    rows = balanced(spark.table(stored.table("bronze")), ("year", "month", "payer_id"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(rows)


def test_claims_are_sorted_by_their_codes_before_the_layout(spark, claims, stored):
    laid_out = _by_partition(claims({}, {"claim_type": None}, {"claim_status": " DENIED"}))
    clean = silver_rows(spark.table(stored.table("bronze")), OPTIONS, ("year", "month", "payer_id"))
    for rows in (laid_out, clean):
        plan = plan_of(rows)
        below = plan[plan.index("REBALANCE_PARTITIONS_BY_COL") :]
        assert re.search(r"Sort \[year#\d+ ASC.*claim_type#\d+ ASC", below)
    # The other rows of a layout have no codes, and stay as they are.
    other = balanced(claims({}).select("claim_id", "payer_id"), ("payer_id",))
    assert "Sort" not in plan_of(other)
    assert cells(laid_out, "claim_type", "claim_status") == [
        ("inpatient", " DENIED"), ("inpatient", "paid"), (None, "paid")
    ]


def test_dimensions_read_their_columns_only(spark, stored):
    star = star_schema(spark.table(stored.table("silver")), RUN)
    wanted = {
        "dim_date": "struct<service_date:date>",
        "dim_member": "struct<member_id:string>",
        "dim_provider": "struct<provider_id:string>",
        "dim_diagnosis": "struct<diagnosis_code:string>",
    }
    for name, schema in wanted.items():
        plan = plan_of(star[name])
        assert f"ReadSchema: {schema}" in plan
        assert shuffles(plan) == 1 and plan.count("HashAggregate") == 2


def test_fact_has_no_shuffle(spark, stored):
    assert shuffles(plan_of(star_schema(spark.table(stored.table("silver")), RUN)["fact_claims"])) == 0


def test_mart_aggregates_before_it_joins(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = star_schema(spark.table(stored.table("silver")), RUN)
        plan = plan_of(marts.monthly_payer(star["fact_claims"], star["dim_date"]))
        join = plan.index("SortMergeJoin")
        assert "keys=[date_key" in plan[join:]
        plan = plan_of(checks.orphan_rows(star["fact_claims"], star))
        assert "LeftAnti" in plan and "BroadcastNestedLoopJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_start_date_reaches_the_scan(spark, stored):
    from claimstrata.plans.gold import run_gold

    run_gold(spark, stored, run_ts=RUN)
    plan = plan_of(marts.since(spark.table(stored.table("fact_claims")), dt.date(2001, 5, 1)))
    assert "GreaterThanOrEqual(date_key,20010501)" in plan


def test_bucketed_bronze_saves_the_silver_shuffle(spark, claims, layers):
    late = {"ingestion_ts": dt.datetime(2001, 5, 9), "paid_amount": 1.0}
    run_bronze(claims({}, {"claim_id": "2"}), RUN, layers, RUN, buckets=4)
    after = RUN + dt.timedelta(days=1)
    wider = claims(late).selectExpr("*", "'gold' AS tier")
    run_bronze(wider, after, layers, after, buckets=4)
    clean = silver_rows(bronze_month(spark, layers.table("bronze"), 2001, 5), OPTIONS)
    assert shuffles(plan_of(clean)) == 0
    assert cells(clean, "claim_id", "paid_amount", "tier") == [("2", 60.0, None), ("CLM1", 1.0, "gold")]


def test_appended_bronze_shuffles_no_stamps(spark, claims, layers, monkeypatch):
    plans = []
    monkeypatch.setattr(registry, "append", lambda rows, *_: plans.append(plan_of(rows)))
    registry._append_bronze(claims({}), layers)
    (plan,) = plans
    rebalance = plan.index("REBALANCE_PARTITIONS_BY_COL")
    assert plan.index("_ingested_by") < rebalance and "_ingested_by" not in plan[rebalance:]


def test_arriving_files_are_not_gathered_by_payer(spark, monkeypatch):
    """No exchange by payer, which would send half of all rows to one task."""
    batches = []
    monkeypatch.setattr(registry, "stream_bronze", lambda s, folder, *_, **k: batches.append((s.read.text(folder).count(), k["files_per_batch"])))
    monkeypatch.setattr(registry, "latest_per_key", lambda *_, **__: None)
    monkeypatch.setattr(registry.Layers, "table", lambda *_: "unused")
    monkeypatch.setattr(registry, "compressed_files", lambda fmt: {"compression": "gzip", "maxRecordsPerFile": "500"})
    spark.createDataFrame([], registry.CLAIMS_SCHEMA).createOrReplaceTempView("unused")
    registry.bronze_stream(spark, SF_DIR)
    # More than one file for each payer, half of a run's in a micro-batch.
    assert batches[-1][0] == registry._claims(spark, SF_DIR).count() and batches[-1][1] >= 3


def test_layers_are_stored_as_zstd(spark, stored):
    for layer in ("bronze", "silver"):
        files = spark.table(stored.table(layer)).inputFiles()
        assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_a_feed_of_several_batches_is_derived_once(spark):
    landed = registry._landed_claims(spark, SF_DIR)
    assert "Join" not in plan_of(landed) and cells(landed) == cells(registry._claims(spark, SF_DIR))
