"""FHIR and HL7 feeds, streaming, batches run again, deletes, and code descriptions."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from claimstrata.operators.bronze import latest_per_key
from claimstrata.operators.gold import build_dim_diagnosis, describe_codes
from claimstrata.operators.sinks import replace_batch
from claimstrata.plans import bronze as bronze_plan
from claimstrata.plans.bronze import run_bronze, run_bronze_files
from claimstrata.plans.gold import run_gold
from claimstrata.plans.silver import SilverOptions, run_silver
from claimstrata.plans.stream import stream_bronze
from claimstrata.schemas import CLAIMS_SCHEMA
from claimstrata.sources.fhir import REASON, fhir_rows, write_fhir
from claimstrata.sources.files import CORRUPT, SOURCE_FILE, read_feed, write_feed
from claimstrata.sources.forms import claim_forms
from claimstrata.sources.hl7 import escape, read_hl7, unescape, write_hl7
from conftest import CLEAN, cells, plan_of

RUN = dt.datetime(2024, 1, 1)
FIELDS = CLAIMS_SCHEMA.fieldNames()

# Every field NULL or odd in turn.
ODD = [
    {},
    {"claim_id": None},
    {"claim_id": None, "member_id": None, "provider_id": None},
    {"claim_id": "no line number"},
    {"claim_id": ""},
    {"claim_id": "CLM2", "member_id": "", "payer_id": None},
    {"claim_id": "CLM3", "provider_id": "PRV/9", "diagnosis_code": None},
    {"claim_id": "CLM4", "procedure_code": ' a|b^c&d~e\\f\r\n"g" ', "denial_reason": '""'},
    {"claim_id": "CLM5", "denial_reason": "\\F\\", "claim_status": "\\E\\F\\E\\", "claim_type": "\\"},
    {"claim_id": "CLM6", "billed_amount": None, "allowed_amount": -0.1, "paid_amount": 1e-9},
    {"claim_id": "CLM7", "ingestion_ts": None, "place_of_service": None, "source_system": None, "batch_id": None},
    {"claim_id": "CLM8", "service_date": dt.datetime(2001, 5, 3, 23, 59, 59, 123456)},
]


# --- messages -----------------------------------------------------------------


@pytest.mark.parametrize("fmt", ["fhir", "hl7"])
def test_messages_keep_every_value(claims, tmp_path, fmt):
    rows = claims(*ODD, *ODD[:2])
    write_feed(rows.repartition(3), str(tmp_path / fmt), fmt)
    read, rejects = read_feed(rows.sparkSession, str(tmp_path / fmt), fmt)
    assert cells(read, *FIELDS) == cells(rows, *FIELDS)
    assert rejects.count() == 0
    assert read.where(~F.col(SOURCE_FILE).contains(str(tmp_path))).count() == 0


@pytest.mark.parametrize("fmt", ["fhir", "hl7"])
def test_no_messages(spark, claims, tmp_path, fmt):
    write_feed(claims({}).limit(0), str(tmp_path / fmt), fmt)
    read, rejects = read_feed(spark, str(tmp_path / fmt), fmt)
    assert (read.count(), rejects.count()) == (0, 0)


def test_lines_of_a_claim_share_its_form(claims):
    lines = [{"claim_id": f"CLM77{i}", "provider_id": f"PRV{i % 2}"} for i in range(5)]
    forms = claim_forms(claims(*lines).coalesce(1)).collect()
    assert [(f["form"], len(f["lines"])) for f in forms] == [("CLM77", 5)]


def test_a_claim_id_of_all_rows_makes_no_large_form(spark, claims):
    many = claims({}).crossJoin(spark.range(20_000, numPartitions=2)).drop("id")
    assert claim_forms(many).agg(F.max(F.size("lines"))).first()[0] <= 4096


def _bundle(*entries, **more):
    return json.dumps({"resourceType": "Bundle", "entry": list(entries), **more})


def _entry(**changes):
    item = {"sequence": 1, "servicedDate": "2001-05-03", "adjudication": []}
    resource = {"resourceType": "ExplanationOfBenefit", "id": "CLM9", "item": [item, {**item, "sequence": 2}]}
    return {"resource": {**resource, **changes}}


def test_a_bad_entry_does_not_take_its_bundle_along(spark):
    lines = [
        _bundle(_entry(), {"resource": {"resourceType": "Patient", "id": "p"}}, _entry(id="CLM8")),
        _bundle(_entry(item=[]), {}, _entry(item=[{"sequence": 1, "servicedDate": "no date"}]), _entry(unknown=1)),
        _bundle(),
        '{"resourceType": "Bundle"}',
        '{"resourceType": "Claim"}',
        "no json",
        "   ",
        None,
    ]
    text = spark.createDataFrame([(x, "f") for x in lines], f"value string, {SOURCE_FILE} string")
    rows, rejects = fhir_rows(text)
    assert sorted(r["claim_id"] for r in rows.collect()) == ["CLM81", "CLM82", "CLM91", "CLM91", "CLM92", "CLM92"]
    found = sorted(r[REASON] for r in rejects.collect())
    assert found == ["no bundle"] * 2 + ["no entry"] * 2 + ["no item"] + ["other resource"] * 2 + ["unreadable entry"]
    assert [json.loads(r[CORRUPT])["resource"]["id"] for r in rejects.where(F.col(REASON) == "no item").collect()] == ["CLM9"]


def test_codes_and_providers_are_found_by_their_sequence(spark):
    concept = lambda code: {"coding": [{"code": code}]}
    item = {
        "sequence": 1, "careTeamSequence": [7], "diagnosisSequence": [2, 1], "servicedDate": "2001-05-03",
        "adjudication": [{"category": concept("benefit"), "amount": {"value": 5}}, {"category": concept("submitted"), "amount": {"value": 9}}],
    }
    entry = _entry(
        item=[item],
        careTeam=[{"sequence": 1, "provider": {"reference": "Practitioner/A"}}, {"sequence": 7, "provider": {"reference": "Practitioner/B"}}],
        diagnosis=[{"sequence": 1, "diagnosisCodeableConcept": concept("I10")}, {"sequence": 2, "diagnosisCodeableConcept": concept("J06")}],
    )
    text = spark.createDataFrame([(_bundle(entry, meta={"source": "S"}), "f")], f"value string, {SOURCE_FILE} string")
    row = fhir_rows(text)[0].first()
    assert (row["provider_id"], row["diagnosis_code"], row["paid_amount"], row["billed_amount"], row["source_system"]) == ("B", "J06", 5.0, 9.0, "S")


HL7 = "\n".join(
    [
        r"MSH|^~\&|LAB|||||| DFT^P03|B7",
        "EVN|P03",
        "PID|||M1^^^X~M2^^^Y",
        "IN1|||P1",
        "FT1||C1||20010503||inpatient|99213||||10.5",
        "ZCL|paid||8|7|20010504101112",
        "FT1||C2||20010503",
        "FT1||C3||May 3||x|y||||ten",
        "NTE|1|a note",
        "ZCL|denied",
    ]
)


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_segments_are_grouped_by_message(spark, tmp_path, end):
    texts = [HL7, HL7.replace("|C", "|D"), HL7.replace("^~", "#~"), "no message"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.hl7").write_bytes(("".join(t.replace("\n", end) + end for t in texts[:3])).encode())
    (tmp_path / "in" / "b.hl7").write_bytes(texts[3].encode())
    rows, rejects = read_hl7(spark, str(tmp_path / "in"), "\rMSH|" if end == "\r" else "\nMSH|")
    assert cells(rows, "claim_id", "member_id", "payer_id", "claim_status", "billed_amount", "paid_amount") == [
        ("C1", "M1", "P1", "paid", 10.5, 7.0),
        ("C2", "M1", "P1", None, None, None),
        ("D1", "M1", "P1", "paid", 10.5, 7.0),
        ("D2", "M1", "P1", None, None, None),
    ]
    assert rows.select("service_date", "ingestion_ts").first() == (dt.datetime(2001, 5, 3), dt.datetime(2001, 5, 4, 10, 11, 12))
    found = sorted(r[REASON] for r in rejects.collect())
    assert found == ["ZCL without FT1"] * 2 + ["other delimiters or no MSH"] * 2 + ["unreadable: service_date, billed_amount"] * 2


def test_messages_that_the_reader_did_not_split_are_rejects(spark, tmp_path):
    (tmp_path / "a.hl7").write_bytes((HL7 + "\n" + HL7).replace("\n", "\r").encode())
    rows, rejects = read_hl7(spark, str(tmp_path))
    assert rows.count() == 0
    assert cells(rejects, REASON) == [("several messages",)]


def test_large_message_files_are_split(spark, claims, tmp_path):
    rows = claims(*[{"claim_id": f"CLM{i}"} for i in range(500)]).coalesce(1)
    write_hl7(rows, str(tmp_path / "x"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        read = read_hl7(spark, str(tmp_path / "x"))[0]
        assert read.rdd.getNumPartitions() > 5
        assert cells(read, *FIELDS) == cells(rows, *FIELDS)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_escapes_are_undone(spark):
    values = ["", '""', '"', "|", "\\", "\\F\\", "\\E\\", "\\E", "a\\\\|b", "\r\n^~&", "\\X0D\\", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    back = df.select("v", unescape(escape(F.col("v"))).alias("w"), escape(F.col("v")).alias("e"))
    for row in back.collect():
        assert row["v"] == row["w"]
        assert not set(row["e"]) & set("|^~&\r\n")


# --- batches that are run again -------------------------------------------------


def test_a_batch_replaces_only_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda rows: spark.createDataFrame(rows, "id int, _batch_id string")
    assert replace_batch(frame([(1, "it's a"), (2, "it's a")]), "t_once", "it's a", path=path) == 2
    assert replace_batch(frame([(3, "b")]), "t_once", "b", path=path) == 1
    assert replace_batch(frame([(9, "it's a")]), "t_once", "it's a", path=path) == 1
    assert cells(spark.table("t_once"), "id", "_batch_id") == [(3, "b"), (9, "it's a")]
    assert replace_batch(frame([]), "t_once", "b", path=path) == 0
    assert cells(spark.table("t_once"), "id") == [(9,)]
    with pytest.raises(Exception, match="row outside batch b"):
        replace_batch(frame([(1, "c")]), "t_once", "b", path=path)


def test_a_batch_run_again_after_a_failure(spark, claims, layers, monkeypatch):
    rows = claims({}, {"claim_id": "C2", "member_id": None}, {"claim_id": "C3"})
    run = lambda df: run_bronze(df, RUN, layers, RUN, nulls="reject", once=True)
    monkeypatch.setattr(bronze_plan, "_reject", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(rows.unionByName(claims({"claim_id": "GONE", "service_date": dt.datetime(1999, 1, 1)})))
    monkeypatch.undo()
    for _ in range(2):
        assert run(rows)["records_loaded"] == 2
    assert cells(spark.table(layers.table("bronze")), "claim_id") == [("C3",), ("CLM1",)]
    assert cells(spark.table(layers.table("bronze_rejects")), "claim_id") == [("C2",)]
    assert cells(spark.table(layers.table("batch_log")), "year", "month") == [(2001, 5)]


def test_batches_and_buckets_exclude_each_other(claims, layers):
    with pytest.raises(ValueError, match="batch or by bucket"):
        run_bronze(claims({}), RUN, layers, once=True, buckets=4)


# --- arriving files -------------------------------------------------------------


def arrive(claims, folder, fmt, ids, number):
    rows = claims(*[{"claim_id": i} for i in ids]).coalesce(1)
    if fmt == "parquet":
        rows.write.mode("append").parquet(folder)
    elif fmt == "json":
        rows.write.mode("append").json(folder)
    else:
        write = write_fhir if fmt == "fhir" else write_hl7
        write(rows, f"{folder}-{number}")
        import pathlib
        import shutil

        pathlib.Path(folder).mkdir(exist_ok=True)
        for file in pathlib.Path(f"{folder}-{number}").glob("part-*"):
            shutil.copy(file, f"{folder}/{number}-{file.name}")


@pytest.mark.parametrize("fmt", ["json", "parquet", "fhir", "hl7"])
def test_each_file_is_stored_once(spark, claims, layers, tmp_path, fmt):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    stored = lambda: cells(spark.table(layers.table("bronze")), "claim_id", "_batch_id")
    arrive(claims, folder, fmt, ["CLM1", "CLM2"], 0)
    stream_bronze(spark, folder, fmt, layers, checkpoint, run_ts=RUN)
    assert stored() == [("CLM1", "claims_stream_000000000000"), ("CLM2", "claims_stream_000000000000")]
    arrive(claims, folder, fmt, ["CLM3"], 1)
    assert sum(s["records_loaded"] for s in stream_bronze(spark, folder, fmt, layers, checkpoint, run_ts=RUN)) == 1
    assert stream_bronze(spark, folder, fmt, layers, checkpoint, run_ts=RUN) == []
    assert [r[0] for r in stored()] == ["CLM1", "CLM2", "CLM3"]


def test_a_restart_after_a_failed_batch_stores_nothing_twice(spark, claims, layers, tmp_path, monkeypatch):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    for n in range(4):
        arrive(claims, folder, "json", [f"CLM{n}"], n)
    log, calls = bronze_plan._log_months, []

    def failing(*args):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("executor lost")
        log(*args)

    monkeypatch.setattr(bronze_plan, "_log_months", failing)
    with pytest.raises(Exception, match="executor lost"):
        stream_bronze(spark, folder, "json", layers, checkpoint, run_ts=RUN, files_per_batch=1)
    # The failed batch is in Bronze already.
    assert spark.table(layers.table("bronze")).count() == 3
    assert len(stream_bronze(spark, folder, "json", layers, checkpoint, run_ts=RUN, files_per_batch=1)) == 2
    assert cells(spark.table(layers.table("bronze")), "claim_id") == [(f"CLM{n}",) for n in range(4)]
    assert spark.table(layers.table("batch_log")).count() == 4


def test_unreadable_records_of_a_stream_are_rejects(spark, claims, layers, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"claim_id": "C1"}\nno json\n' + json.dumps({**CLEAN, "claim_id": "C2"}, default=str) + "\n")
    (summary,) = stream_bronze(spark, str(tmp_path / "in"), "json", layers, str(tmp_path / "checkpoint"), run_ts=RUN)
    assert (summary["records_loaded"], summary["records_failed"]) == (1, 2)
    assert cells(spark.table(layers.table("bronze")), "claim_id") == [("C2",)]


def test_unknown_stream_format(spark, layers):
    with pytest.raises(ValueError, match="format"):
        stream_bronze(spark, "x", "csv", layers, "y")


# --- maps, deletes, descriptions -------------------------------------------------


def test_rows_with_maps_have_a_latest_version(spark):
    rows = [("a", {"x": "1"}, [{"m": {"k": 1}}]), ("a", {"y": "2"}, None), ("b", None, None), ("a", {"x": "3"}, None)]
    df = spark.createDataFrame(rows, "claim_id string, m map<string,string>, n array<struct<m:map<string,int>>>")
    for n in (1, 3):
        assert cells(latest_per_key(df.repartition(n), "claim_id", []), "claim_id", "m") == [("a", {"y": "2"}), ("b", None)]


def test_unknown_fields_are_kept_in_bronze(spark, layers, tmp_path):
    record = json.dumps({**CLEAN, "tier": "gold"}, default=str)
    (tmp_path / "a.json").write_text(f"{record}\n{record}\n{json.dumps({**CLEAN, 'claim_id': 'C2'}, default=str)}\n")
    run_bronze_files(spark, str(tmp_path), "json", RUN, layers, RUN, unknown="keep")
    run_silver(spark, layers, 2001, 5, SilverOptions(as_of=dt.date(2002, 1, 1), run_ts=RUN))
    assert cells(spark.table(layers.table("silver")), "claim_id", "_unknown_fields") == [("C2", {}), ("CLM1", {"tier": "gold"})]


def tombstone(spark, claim_id, service_date=None):
    none = {f.name: F.lit(None).cast(f.dataType) for f in CLAIMS_SCHEMA}
    date = F.lit(service_date).cast("timestamp")
    return spark.range(1).select(*[c.alias(n) for n, c in (none | {"claim_id": F.lit(claim_id), "service_date": date}).items()], F.lit(True).alias("_is_deleted"))


def test_deletes_and_later_versions(spark, claims, layers):
    day = lambda n: dt.datetime(2024, 1, n)
    options = SilverOptions(as_of=dt.date(2002, 1, 1), run_ts=RUN, deletes=True)
    ids = ("dated", "undated", "back", "invalid", "stays")
    run_bronze(claims(*[{"claim_id": i} for i in ids]), day(1), layers, day(1))
    run_silver(spark, layers, 2001, 5, options)
    silver = lambda: cells(spark.table(layers.table("silver")), "claim_id", "paid_amount")
    assert len(silver()) == 5
    gone = tombstone(spark, "dated", dt.datetime(2001, 5, 9))
    for claim_id in ("undated", "back", "invalid", None):
        gone = gone.unionByName(tombstone(spark, claim_id))
    run_bronze(gone, day(2), layers, day(2), nulls="keep")
    run_bronze(claims({"claim_id": "back", "paid_amount": 1.0}, {"claim_id": "invalid", "claim_type": "?"}), day(3), layers, day(3))
    result = run_silver(spark, layers, 2001, 5, options)
    assert silver() == [("back", 1.0), ("stays", 60.0)]
    assert (result["input_records"], result["quarantined"]) == (7, 1)
    run_gold(spark, layers, 2001, 5, RUN)
    assert cells(spark.table(layers.table("fact_claims")), "claim_id") == [("back",), ("stays",)]
    run_silver(spark, layers, options=options)
    assert silver() == [("back", 1.0), ("stays", 60.0)]


def test_a_delete_as_new_as_the_version_wins(spark, claims):
    from claimstrata.functions.rules import claim_rules
    from claimstrata.operators.silver import latest_not_deleted, standardize_codes

    rows = claims({"claim_id": "a"}, {"claim_id": "b"}).withColumn("_is_deleted", F.lit(None).cast("boolean"))
    both = standardize_codes(rows.unionByName(tombstone(spark, "a"))).withColumn("_ingested_at", F.lit(RUN))
    for df in (both, both.repartition(5)):
        assert cells(latest_not_deleted(df, claim_rules(dt.date(2002, 1, 1))), "claim_id") == [("b",)]


def test_codes_take_the_longest_known_prefix(spark):
    codes = spark.createDataFrame([("J06.9",), ("J06.91",), ("j18",), ("K21.0",), ("Z00",), ("",), ("J",)], "code string")
    known = [("J", "letter"), ("J06", "three"), ("j06.9", "b four"), ("J069", "a four"), ("K210", "whole"), ("", "nothing"), (None, "none")]
    reference = spark.createDataFrame(known, "icd10_prefix string, description string")
    described = describe_codes(codes, "code", reference)
    assert dict(cells(described, "code", "description")) == {
        "J06.9": "a four", "J06.91": "a four", "j18": "letter", "K21.0": "whole", "Z00": None, "": None, "J": "letter",
    }
    plan = plan_of(described)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_diagnoses_without_reference_are_as_before(claims):
    silver = claims({}, {"diagnosis_code": None})
    empty = silver.sparkSession.createDataFrame([], "icd10_prefix string, description string")
    assert cells(build_dim_diagnosis(silver)) == cells(build_dim_diagnosis(silver, empty))


@pytest.mark.parametrize("fmt", ["fhir", "hl7", "json", "csv"])
def test_compressed_feeds_hold_the_same_rows(spark, claims, tmp_path, monkeypatch, fmt):
    from claimstrata.sources import files

    monkeypatch.setitem(files._RECORDS_PER_FILE, fmt, 10)
    rows = claims(*[{"claim_id": f"CLM{i}1", "procedure_code": None if i % 3 else "9|9\\1^3"} for i in range(35)]).coalesce(1)
    folder = tmp_path / "feed"
    write_feed(rows, str(folder), fmt, compressed=True)
    assert len(list(folder.glob("*.gz"))) == len(list(folder.glob("part-*"))) == 4
    read, corrupt = read_feed(spark, str(folder), fmt)
    assert cells(read.drop(SOURCE_FILE)) == cells(rows) and corrupt.count() == 0


@pytest.mark.parametrize("fmt", ["fhir", "hl7"])
def test_messages_are_parsed_once(spark, claims, layers, tmp_path, monkeypatch, fmt):
    seen, run = [], bronze_plan.run_bronze

    def watched(rows, *args, set_aside=None, **others):
        seen.extend((plan_of(rows), plan_of(set_aside)))
        return run(rows, *args, set_aside=set_aside, **others)

    monkeypatch.setattr(bronze_plan, "run_bronze", watched)
    folder = tmp_path / "feed"
    write_feed(claims({"claim_id": "CLM11"}, {"claim_id": "CLM12"}), str(folder), fmt)
    (folder / "bad.txt").write_text("MSH|#~\\&|\n" if fmt == "hl7" else "no bundle\n")
    summary = run_bronze_files(spark, str(folder), fmt, dt.datetime(2024, 1, 1), layers)
    assert (summary["records_loaded"], summary["records_failed"]) == (2, 1)
    assert len(seen) == 2 and all("FileScan text" not in plan and "FileScan parquet" in plan for plan in seen)
    # The table that both were read from is gone, its rows as well.
    assert not [t for t in spark.catalog.listTables() if layers.prefix in t.name and "incoming" in t.name]
    assert spark.read.parquet(f"{layers.root}/incoming_*").count() == 0
