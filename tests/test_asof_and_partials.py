"""Versions as of a date, and marts kept up to date month by month."""

import datetime as dt
import random
import re
from pathlib import Path

from claimstrata.operators.asof import as_of_join, versions_at
from claimstrata.operators.marts import denials_by_category, monthly_payer
from claimstrata.operators.sinks import replace_month
from claimstrata.plans.bronze import run_bronze
from claimstrata.plans.gold import star_schema
from claimstrata.plans.marts import PARTIALS, denials_by_category_of, in_months, monthly_payer_of, refresh_batch, refresh_partials
from claimstrata.plans.silver import SilverOptions, run_silver
from conftest import SF_DIR, cells, plan_of

from __spark_entry__ import queries

DAY = dt.date(2001, 5, 1)
ROWS = "id int, key string, day date"
VERSIONS = "key string, valid_from date, valid_to date, loaded int, state string"


def later(days):
    return DAY + dt.timedelta(days=days)


def states(rows, versions, **choices):
    joined = as_of_join(rows, versions, "key", "day", ["state"], newest=["loaded"], **choices)
    assert joined.count() == rows.count()
    return {r["id"]: r["state"] for r in joined.collect()}


def test_ties_gaps_and_missing_values(spark):
    versions = spark.createDataFrame(
        [
            ("a", later(0), None, 1, "first"),
            ("a", later(10), later(15), 3, "tie, loaded last"),
            ("a", later(10), None, 2, "tie, loaded first"),
            ("a", later(20), None, 4, None),
            ("a", None, None, 9, "no start"),
            (None, later(0), None, 9, "no key"),
        ],
        VERSIONS,
    )
    asked = [("a", -1), ("a", 0), ("a", 9), ("a", 10), ("a", 14), ("a", 15), ("a", 25), ("b", 5), (None, 5), ("a", 0)]
    rows = spark.createDataFrame([(i, k, later(d)) for i, (k, d) in enumerate(asked)] + [(99, "a", None)], ROWS)
    tie = "tie, loaded last"
    assert states(rows, versions) == dict(
        enumerate([None, "first", "first", tie, tie, None, None, None, None, "first"])
    ) | {99: None}
    assert states(rows, versions, valid_to=None)[5] == tie
    assert states(rows.limit(0), versions) == {}
    assert set(states(rows, versions.limit(0)).values()) == {None}


def test_against_a_plain_search(spark):
    draw = random.Random(5)
    versions = [
        (draw.choice("abc"), later(draw.randrange(60)), None, i, f"s{i}") for i in range(40)
    ]
    versions = [(k, f, f + dt.timedelta(days=draw.randrange(1, 9)) if i % 3 == 0 else None, i, s) for k, f, _, i, s in versions]
    rows = [(i, draw.choice("aaaaaabcd"), later(draw.randrange(-5, 70))) for i in range(400)]

    def plain(key, day):
        known = [(f, i, to, s) for k, f, to, i, s in versions if k == key and f <= day]
        _, _, to, state = max(known, default=(None, None, None, None), key=lambda v: v[:2])
        return state if to is None or to > day else None

    found = states(spark.createDataFrame(rows, ROWS), spark.createDataFrame(versions, VERSIONS))
    assert found == {i: plain(k, d) for i, k, d in rows}


def test_hot_key_is_looked_up_once_a_day(spark):
    rows = spark.range(20000).selectExpr("CAST(id AS int) id", "'hot' AS key", f"DATE '{DAY}' + CAST(id % 30 AS int) AS day")
    versions = spark.createDataFrame([("hot", later(3), None, 1, "x")], VERSIONS)
    assert versions_at(rows, versions, "key", "day", ["state"]).count() == 30
    joined = as_of_join(rows, versions, "key", "day", ["state"], newest=["loaded"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert joined.where("state = 'x'").count() == sum(i % 30 >= 3 for i in range(20000))


OPTIONS = SilverOptions(as_of=dt.date(2001, 12, 31), run_ts=dt.datetime(2024, 1, 1))


def load(claims, layers, day, *rows):
    at = dt.datetime(2024, 1, day)
    return run_bronze(claims(*rows), at, layers, at)["batch_id"]


def service(month, **more):
    return {"service_date": dt.datetime(2001, month, 7, 9), **more}


def assert_equal_to_full_marts(spark, layers):
    star = star_schema(spark.table(layers.table("silver")), OPTIONS.run_ts)
    sums = spark.table(layers.table(PARTIALS))
    assert cells(monthly_payer_of(sums)) == cells(monthly_payer(star["fact_claims"], star["dim_date"]).select(monthly_payer_of(sums).columns))
    full = denials_by_category(star["fact_claims"], star["dim_diagnosis"])
    assert cells(denials_by_category_of(sums)) == cells(full.select(denials_by_category_of(sums).columns))


def files_of(layers):
    return {str(f): f.stat().st_mtime_ns for f in Path(layers.path(PARTIALS)).rglob("*.parquet")}


def test_late_batch_rebuilds_its_months_only(spark, claims, layers):
    load(
        claims,
        layers,
        1,
        service(3, claim_id="A"),
        service(4, claim_id="B", payer_id=None, diagnosis_code=None),
        service(5, claim_id="C", claim_status="denied"),
        service(5, claim_id="D", payer_id="PAYER_002", billed_amount=0.1, allowed_amount=0.1, paid_amount=0.1),
    )
    run_silver(spark, layers, options=OPTIONS)
    refresh_partials(spark, layers)
    assert_equal_to_full_marts(spark, layers)
    before = files_of(layers)

    late = load(claims, layers, 2, service(5, claim_id="C", paid_amount=1.0), service(4, claim_id="E"))
    assert refresh_batch(spark, layers, late, OPTIONS) == [(2001, 4), (2001, 5)]
    assert_equal_to_full_marts(spark, layers)
    kept = {f: t for f, t in files_of(layers).items() if f in before}
    assert kept == {f: t for f, t in before.items() if "claim_month=3" in f}

    again = cells(spark.table(layers.table(PARTIALS)))
    refresh_partials(spark, layers, [(2001, 4), (2001, 5)])
    assert cells(spark.table(layers.table(PARTIALS))) == again
    assert refresh_partials(spark, layers, []) == 0
    refresh_partials(spark, layers)
    assert_equal_to_full_marts(spark, layers)


def test_month_without_claims_leaves_the_marts(spark, claims, layers):
    load(claims, layers, 1, service(3, claim_id="A"), service(4, claim_id="B"))
    run_silver(spark, layers, options=OPTIONS)
    refresh_partials(spark, layers)
    silver = layers.table("silver")
    replace_month(spark.createDataFrame([], spark.table(silver).schema), silver, 2001, 4)
    refresh_partials(spark, layers, [(2001, 4)])
    assert_equal_to_full_marts(spark, layers)
    assert cells(monthly_payer_of(spark.table(layers.table(PARTIALS))).select("month", "claims")) == [(3, 1)]


def test_only_touched_partitions_are_read(spark, claims, layers):
    load(claims, layers, 1, service(3, claim_id="A"), service(4, claim_id="B"))
    run_silver(spark, layers, options=OPTIONS)
    silver = spark.table(layers.table("silver"))
    opened = silver.where(in_months([(2001, 4)])).inputFiles()
    assert opened and all("claim_month=4" in f for f in opened)
    assert silver.where(in_months([])).count() == 0


def test_rows_are_moved_once_to_their_versions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = spark.range(1000).selectExpr("CAST(id AS int) id", "CAST(id % 7 AS string) AS key", f"DATE '{DAY}' + CAST(id % 30 AS int) AS day")
    versions = spark.createDataFrame([("1", later(3), None, 1, "x")], VERSIONS)
    try:
        plan = as_of_join(rows, versions, "key", "day", ["state"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The rows once, by their key alone; the versions by key and start, then by key.
    by = re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan)
    assert len(by) == 3 and sum("__sought" in keys for keys in by) == 1 and not any("day" in keys for keys in by)


def test_keys_of_the_star_read_travel_as_bytes(spark):
    plan = plan_of(queries()["star_read_asof"](spark, SF_DIR))
    assert all(f"hex(unhex({key}" in plan for key in ("claim_key", "provider_key", "member_key"))
