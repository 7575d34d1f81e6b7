import datetime as dt
import hashlib

import pytest

from claimstrata.functions.columns import packed, unpacked
from claimstrata.operators.gold import build_dim_date, build_dim_diagnosis, build_dim_member, build_fact_claims
from claimstrata.operators.marts import denials_by_category, monthly_payer, since, star_read
from claimstrata.plans.bronze import run_bronze
from claimstrata.plans.gold import run_gold, star_schema
from claimstrata.plans.silver import SilverOptions, run_silver, silver_rows
from conftest import cells, plan_of

RUN = dt.datetime(2024, 1, 1)
OPTIONS = SilverOptions(as_of=dt.date(2001, 6, 30), run_ts=RUN, order_field="ingestion_ts")


@pytest.fixture
def silver(claims):
    return silver_rows(
        claims(
            {},
            {"claim_id": "2", "payer_id": "PAYER_002", "claim_status": "denied"},
            {"claim_id": "3", "diagnosis_code": None, "service_date": dt.datetime(2001, 4, 7)},
            {"claim_id": "4", "payer_id": None, "diagnosis_code": "e11.9"},
        ),
        OPTIONS,
    )


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_dim_date(silver):
    rows = {r["date_key"]: r for r in build_dim_date(silver).collect()}
    assert sorted(rows) == [20010407, 20010503]
    saturday, thursday = rows[20010407], rows[20010503]
    assert (saturday["day_name"], saturday["day_of_week"], saturday["is_weekend"]) == ("Saturday", 7, True)
    assert (thursday["day_of_week"], thursday["is_weekend"], thursday["month_name"]) == (5, False, "May")
    assert (thursday["quarter"], thursday["week_of_year"]) == (2, 18)


def test_dim_member_has_one_row_per_payer(silver):
    rows = build_dim_member(silver, RUN).collect()
    assert len(rows) == 3 and len({r["member_key"] for r in rows}) == 1
    assert rows[0]["member_key"] == md5(rows[0]["member_id_hash"])


def test_dim_diagnosis_drops_null(silver):
    dim = build_dim_diagnosis(silver)
    assert dim.columns == ["diagnosis_code", "diagnosis_key", "icd10_code", "description", "category"]
    assert cells(dim, "diagnosis_code", "category") == [("E11.9", "E"), ("I10", "I")]


def test_fact_columns_and_rows(silver):
    fact = star_schema(silver, RUN)["fact_claims"]
    assert fact.columns == [
        "claim_key", "claim_id", "member_key", "provider_key", "date_key", "diagnosis_key",
        "payer_id", "claim_type", "claim_status", "procedure_code", "billed_amount",
        "allowed_amount", "paid_amount", "discount_rate", "is_denied", "place_of_service",
        "_silver_processed_at", "_gold_loaded_at",
    ]
    assert fact.count() == silver.count()
    assert cells(fact.where("claim_id = '3'"), "claim_key", "diagnosis_key") == [(md5("3"), None)]


@pytest.mark.parametrize(
    "odd,total",
    [(float("nan"), "nan"), (float("inf"), "inf"), (1e15, "1000000000000100.0"), (1e30, "1e+30"), (0.004, "100.0")],
)
def test_odd_amounts_show_in_totals(claims, odd, total):
    changes = {"claim_id": "2", "billed_amount": odd, "paid_amount": 0.0}
    silver = silver_rows(claims({}, changes), OPTIONS)
    (row,) = monthly_payer(build_fact_claims(silver), build_dim_date(silver)).collect()
    assert (row["claims"], str(row["billed_amount"])) == (2, total)


def test_star_read_keeps_every_claim(silver):
    star = star_schema(silver, RUN)
    joined = star_read(star["fact_claims"], star)
    assert joined.count() == 4
    assert len(joined.columns) == len(set(joined.columns))
    assert cells(joined, "claim_id", "category", "payer_id") == [
        ("2", "I", "PAYER_002"),
        ("3", None, "PAYER_001"),
        ("4", "E", None),
        ("CLM1", "I", "PAYER_001"),
    ]


def test_monthly_payer(silver):
    star = star_schema(silver, RUN)
    mart = monthly_payer(star["fact_claims"], star["dim_date"])
    assert cells(mart, "month", "payer_id", "claims", "denied", "billed_amount") == [
        (4, "PAYER_001", 1, 0, 100.0),
        (5, "PAYER_001", 1, 0, 100.0),
        (5, "PAYER_002", 1, 1, 100.0),
        (5, None, 1, 0, 100.0),
    ]


def test_start_date(silver):
    fact = star_schema(silver, RUN)["fact_claims"]
    assert since(fact, dt.date(2001, 4, 8)).count() == 3
    assert since(fact, None).count() == 4


def test_denials_by_category(silver):
    star = star_schema(silver, RUN)
    mart = denials_by_category(star["fact_claims"], star["dim_diagnosis"])
    assert cells(mart, "category", "claims", "denied", "denial_rate") == [
        ("E", 1, 0, 0.0),
        ("I", 2, 1, 0.5),
        (None, 1, 0, 0.0),
    ]


def test_totals_do_not_depend_on_partitioning(claims):
    amounts = [0.1, 0.2, 0.3, 1e9, 0.7, 123456.785, 0.005]
    df = claims(*({"claim_id": str(n), "billed_amount": a, "paid_amount": 0.0} for n, a in enumerate(amounts)))
    totals = set()
    for parts in (1, 3, 7):
        star = star_schema(silver_rows(df.repartition(parts), OPTIONS), RUN)
        totals |= {r["billed_amount"] for r in monthly_payer(star["fact_claims"], star["dim_date"]).collect()}
    assert totals == {1000123458.09}


def test_run_holds_the_month_only(spark, claims, layers):
    april = {"claim_id": "2", "service_date": dt.datetime(2001, 4, 1)}
    run_bronze(claims({}, april), RUN, layers, RUN)
    run_silver(spark, layers, options=OPTIONS)
    assert run_gold(spark, layers, run_ts=RUN)["fact_records"] == 2
    result = run_gold(spark, layers, 2001, 4, RUN)
    assert result["fact_records"] == 1 and result["tables"]["dim_date"] == 1
    assert cells(spark.table(layers.table("fact_claims")), "claim_id") == [("2",)]


def test_other_format(spark, claims, layers):
    run_bronze(claims({}), RUN, layers, RUN)
    run_silver(spark, layers, options=OPTIONS)
    assert run_gold(spark, layers, run_ts=RUN, fmt="orc", options={"compression": "zlib"})["fact_records"] == 1
    assert spark.table(layers.table("fact_claims")).count() == 1


def test_outside_the_catalog(spark, claims, layers):
    run_bronze(claims({}), RUN, layers, RUN)
    run_silver(spark, layers, options=OPTIONS)
    run_gold(spark, layers, run_ts=RUN, in_catalog=False)
    assert not spark.catalog.tableExists(layers.table("dim_date"))
    assert spark.read.parquet(layers.path("dim_date")).count() == 1


def test_packed_texts_come_back_and_hex_takes_half(spark):
    texts = [None, "", "0", "00", "0a", "0A", "abc", "zz", "\x01", "é", "d41d8cd98f00b204e9800998ecf8427e", " 0a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", packed("t"))
    rows = df.select("t", "p", unpacked("p").alias("back")).collect()
    assert [r["back"] for r in rows] == texts
    assert len({bytes(r["p"]) for r in rows if r["p"] is not None}) == len(texts) - 1
    assert len(rows[10]["p"]) == 17


def test_keys_of_star_reads_travel_as_bytes(spark, silver):
    star = star_schema(silver, RUN)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read = star_read(star["fact_claims"], star)
        got = {r["claim_key"]: r for r in read.collect()}
        plan = plan_of(read)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    fact = {r["claim_key"]: r for r in star["fact_claims"].collect()}
    assert len(fact) == 4 and got.keys() == fact.keys()
    members = {r["member_key"]: r["member_id_hash"] for r in star["dim_member"].collect()}
    for key, row in got.items():
        assert all(row[c] == fact[key][c] for c in star["fact_claims"].columns)
        assert row["member_id_hash"] == members[row["member_key"]] and len(row["provider_id_hash"]) == 64
    assert "unhex(" in plan and "SortMergeJoin" in plan
