"""Registered queries of the operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstrata.llm import url_vocabulary
from claimstrata.llm.bottom_sketches import near_duplicates
from claimstrata.llm.fourier_quality import score_quality
from claimstrata.llm.html_regions import extract_pages
from claimstrata.llm.imatch import fingerprint_edits
from claimstrata.llm.language_ppm import held_out, identify_languages
from claimstrata.llm.length_buckets import pack
from claimstrata.llm.license_templates import scan_licenses
from claimstrata.llm.periodic_runs import RUN, find_runs
from claimstrata.llm.quote_links import reply_order
from claimstrata.llm.shared import split_words, table
from claimstrata.llm.target_ratio import QualityLimits, judge_quality, trusted_rows
from claimstrata.llm.temperature_mix import mix_sources
from claimstrata.llm.token_alignment import align, link_totals

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    said = identify_languages(docs.select("doc_id", "text"), docs)
    return said.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op3_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_vocabulary.filter_urls(table(spark, sf_dir, "pages"))


def op4_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op5_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_order(table(spark, sf_dir, "conversations"))


def op6_html_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op7_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_sources(docs).drop("text")


def op8_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op9_target_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = trusted_rows(table(spark, sf_dir, "labels"), QualityLimits())
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_quality(docs, trusted).drop("text")


def op10_bottom_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def stuttered(docs: DataFrame) -> DataFrame:
    """doc_id, text; every tenth text, by a hash of its id, repeats a stretch of words to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words, n = F.col("__words"), F.size("__words").cast("bigint")
    first = F.col("__first")
    hashed = docs.select("doc_id", "text", F.when(h % 10 == 0, split_words(F.col("text"))).alias("__words"))
    placed = hashed.withColumn("__first", F.when(n > 0, g % n)).withColumn(
        "__period", 1 + F.floor((n - first) / (3 + g % 8)).cast("bigint")
    )
    repeated = F.transform(
        words, lambda w, i: F.when(i < first, w).otherwise(F.get(words, (first + (i - first) % F.col("__period")).cast("int")))
    )
    return placed.select("doc_id", F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(stuttered(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    longer = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    # Runs come by start, then period, so the first of equals stays.
    top = F.aggregate("runs", F.lit(None).cast(RUN), lambda best, r: F.when(longer(best, r), r).otherwise(best))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        top.alias("top"),
    ).select(
        "doc_id",
        "n_runs",
        "top.start",
        "top.length",
        "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("bigint").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def op12_identity_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    return link_totals(aligned.withColumn("groups_sha256", digest).drop("groups"))


def op13_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_quality(docs, labels.where(~held_out(F.col("doc_id"))))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def queries() -> dict[str, Query]:
    return {
        "op1_language_ppm": op1_language_ppm,
        "op2_imatch": op2_imatch,
        "op3_url_vocabulary": op3_url_vocabulary,
        "op4_license_templates": op4_license_templates,
        "op5_quote_links": op5_quote_links,
        "op6_html_regions": op6_html_regions,
        "op7_temperature_mix": op7_temperature_mix,
        "op8_length_buckets": op8_length_buckets,
        "op9_target_ratio": op9_target_ratio,
        "op10_bottom_sketches": op10_bottom_sketches,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_identity_map": op12_identity_map,
        "op13_fourier_quality": op13_fourier_quality,
    }


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express."""
    return {"op3_url_vocabulary": url_vocabulary.oracle()}
