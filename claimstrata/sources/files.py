"""CSV, JSON, parquet, FHIR and HL7 feeds, typed by the contract schema."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimstrata.schemas import CLAIMS_SCHEMA, relaxed

CORRUPT = "_corrupt"
SOURCE_FILE = "_source_file"
UNKNOWN_FIELDS = "_unknown_fields"
REASON = "_reject_reason"

# One task reads a compressed file whole, so none holds more records than this.
_RECORDS_PER_FILE = {"csv": 1_000_000, "json": 1_000_000, "fhir": 250_000, "hl7": 250_000}

# Written timestamps keep their microseconds.  Reading takes any ISO form.
_WRITTEN_TIMESTAMPS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# NULL and the empty text are told apart: the former is written as \N; a reader
# takes that and nothing at all as NULL, and "" as empty.
_CSV = {
    "header": "true",
    "nullValue": "\\N",
    # Padding is data here: trimming codes is the Silver layer's job.
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_feed(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType = CLAIMS_SCHEMA,
    timestamp_format: str | None = None,
    multi_line: bool = False,
    unknown: str = "fail",
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(typed rows, corrupt records) of a "csv", "json", "parquet", "fhir" or "hl7" folder.

    Types are never inferred.  A record that does not fit the schema goes to the
    second frame with its raw text; both frames know the file they came from.
    Timestamps are read in any ISO form unless `timestamp_format` names one.

    `unknown` says what happens to fields outside the schema: "fail" stops the
    job, "keep" puts them as text into the map `_unknown_fields`, "reject" (JSON)
    treats the record as corrupt.  Parquet columns outside the schema are kept as
    columns.  `multi_line` reads CSV values with line breaks; such files cannot
    be split, so it is off unless asked for.  FHIR and HL7 messages hold claims only;
    what else they hold is not a field of a claim, and the options do not apply.

    Both frames parse the files.  With `keep`, which stores the frame it is given and
    returns it as stored, messages are parsed once, for both.
    """
    if unknown not in ("fail", "keep", "reject"):
        raise ValueError(f"unknown must be 'fail', 'keep' or 'reject', not {unknown!r}")
    options = {"timestampFormat": timestamp_format} if timestamp_format else {}
    if fmt == "parquet":
        rows = spark.read.parquet(path).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
        none = relaxed(schema).add(CORRUPT, T.StringType()).add(SOURCE_FILE, T.StringType())
        return rows, spark.createDataFrame([], none)
    if fmt == "json":
        return json_rows(spark.read.text(path).select("value", F.col("_metadata.file_path").alias(SOURCE_FILE)), schema, options, unknown)
    if fmt == "csv":
        return _read_csv(spark, path, schema, options | {"multiLine": str(multi_line).lower()}, unknown)
    if fmt in ("fhir", "hl7"):
        from claimstrata.sources import fhir, hl7

        return fhir.read_fhir(spark, path, keep) if fmt == "fhir" else hl7.read_hl7(spark, path, keep=keep)
    raise ValueError(f"format must be 'csv', 'json', 'parquet', 'fhir' or 'hl7', not {fmt!r}")


def split_records(
    records: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Parsed messages as claims and rejects; `keep` as in `read_feed`."""
    kept = keep(records) if keep else records
    good, bad = kept.where(F.col(REASON).isNull()), kept.where(F.col(REASON).isNotNull())
    return good.drop(CORRUPT, REASON), bad.select(CORRUPT, REASON, SOURCE_FILE)


def _read_csv(
    spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str], unknown: str
) -> tuple[DataFrame, DataFrame]:
    fields, extra = relaxed(schema), []
    if unknown == "reject":
        raise ValueError("fields of a CSV file are those of its header: use 'fail' or 'keep'")
    if unknown == "keep":
        header = spark.read.options(**_CSV, **options).csv(path).columns
        extra = [c for c in header if c not in schema.fieldNames()]
        fields = T.StructType([fields[c] if c in schema.fieldNames() else T.StructField(c, T.StringType()) for c in header])
    raw = (
        # Columns in another order than the contract, and unknown ones, are an
        # error, not shifted values.
        spark.read.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema="false")
        .options(**_CSV, **options)
        .schema(T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())]))
        .csv(path)
        .withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    )
    # Readers parse only the columns a query uses, and would miss a bad value
    # in the others.  Naming every field keeps the split the same for all queries.
    whole = reduce(add, [F.col(f).isNotNull().cast("int") for f in fields.fieldNames()]) >= 0
    if unknown == "keep":
        pairs = [x for c in extra for x in (F.lit(c), F.col(f"`{c}`"))]
        left = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()) if pairs else F.create_map()
        raw = raw.withColumn(UNKNOWN_FIELDS, left.cast("map<string,string>")).drop(*extra)
        known = [F.col(f).isNotNull().cast("int") for f in schema.fieldNames()]
        whole = reduce(add, [*known, F.size(UNKNOWN_FIELDS)]) >= 0
    corrupt = F.col(CORRUPT).isNotNull()
    return raw.where(~corrupt & whole).drop(CORRUPT), raw.where(corrupt & whole)


def json_rows(
    text: DataFrame, schema: T.StructType = CLAIMS_SCHEMA, options: dict[str, str] | None = None, unknown: str = "fail"
) -> tuple[DataFrame, DataFrame]:
    """(typed rows, corrupt records) of the records in `value`, one per line.

    Records are parsed from their text: the field names are part of it.
    """
    names = F.array(*[F.lit(n) for n in schema.fieldNames()])
    parsing = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **(options or {})}
    wanted = relaxed(schema).add(CORRUPT, T.StringType())
    lines = (
        text.where(F.trim("value") != "")
        .withColumn("record", F.from_json("value", wanted, parsing))
        .withColumn("unknown", F.array_except(F.json_object_keys("value"), names))
    )
    unreadable = F.col("record").isNull() | F.col(f"record.{CORRUPT}").isNotNull()
    wider = F.coalesce(F.size("unknown") > 0, F.lit(False))
    bad = unreadable | wider if unknown == "reject" else unreadable
    good, broken = lines.where(~bad), lines.where(bad)
    fields: list[Column] = [F.col(f"record.{n}").alias(n) for n in schema.fieldNames()]
    if unknown == "fail":
        stop = F.raise_error(F.concat(F.lit("unknown fields: "), F.array_join("unknown", ", ")))
        good = good.where(F.when(wider, stop.cast("boolean")).otherwise(True))
    if unknown == "keep":
        left = F.map_filter(
            F.from_json("value", T.MapType(T.StringType(), T.StringType())), lambda k, v: F.array_contains("unknown", k)
        )
        fields.append(F.when(wider, left).otherwise(F.create_map().cast("map<string,string>")).alias(UNKNOWN_FIELDS))
    raw = F.col("value").alias(CORRUPT)
    return good.select(*fields, SOURCE_FILE), broken.select(*fields, raw, SOURCE_FILE)


def compressed_files(fmt: str) -> dict[str, str]:
    """Writer options for compressed text files that one task can read."""
    # Feeds are read once or twice: a tenth of the text at the lowest level is enough.
    return {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": str(_RECORDS_PER_FILE[fmt])}


def write_feed(df: DataFrame, path: str, fmt: str, multi_line: bool = False, compressed: bool = False) -> None:
    """Write rows in the layout `read_feed` expects.

    A CSV value with a line break stops the write unless `multi_line` says that
    the files will be read as such.  Text takes several times the space of what it
    says: with `compressed`, it is stored in gzip files of a bounded number of records,
    each read by one task; without, files of any size are split.
    """
    packed = compressed_files(fmt) if compressed and fmt != "parquet" else {}
    if fmt in ("fhir", "hl7"):
        from claimstrata.sources import fhir, hl7

        return fhir.write_fhir(df, path, packed) if fmt == "fhir" else hl7.write_hl7(df, path, packed)
    options = packed | {"timestampFormat": _WRITTEN_TIMESTAMPS}
    if fmt == "csv":
        options |= _CSV
        texts = [] if multi_line else [f.name for f in df.schema if f.dataType == T.StringType()]
        stop = F.raise_error(F.lit("line break in a CSV value: write with multi_line=True"))
        df = df.withColumns(
            {c: F.when(F.col(c).rlike(r"[\r\n]"), stop.cast("string")).otherwise(F.col(c)) for c in texts}
        )
    elif fmt == "parquet":
        options = {}
    df.write.format(fmt).options(**options).mode("errorifexists").save(path)
