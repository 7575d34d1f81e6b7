"""Packing into batches of similar length.

Documents are cut into pieces of at most `max_tokens`; the lengths of all pieces
give one histogram (at most `max_tokens` rows), and dynamic programming over it
chooses the bucket lengths with the least padding.  Inside a bucket, pieces in a
seeded hash order fill batches of `batch_tokens` padded tokens.  Numbers in that
order come from counts per hash bin, so no bucket is ever ordered in one task.

Tokens are words between ASCII spaces.  Cases: NULL and empty texts, and texts of
spaces, have no piece; a NULL doc_id is packed like any other; rows that repeat a
doc_id are packed each; equal lengths need fewer buckets than asked for, and an
empty table needs none; columns beyond doc_id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimstrata.llm.shared import array_literal, stored
from claimstrata.llm.temperature_mix import count_tokens

BINS = 1024


@dataclass(frozen=True)
class Packing:
    buckets: int = 12
    max_tokens: int = 4096
    batch_tokens: int = 65_536
    seed: int = 29


def choose_buckets(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Bucket lengths with the least padding, for a histogram sorted by length."""
    if not lengths:
        return []
    top = np.array(lengths, np.int64)
    upto = np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])
    # cost[j]: padded tokens of the first j lengths; the last bucket ends at j.
    cost = np.concatenate([[0], top * upto[1:]])
    choice = []
    for _ in range(1, min(buckets, len(lengths))):
        best, came = cost.copy(), np.full(len(cost), -1)
        for j in range(1, len(cost)):
            tried = cost[:j] + top[j - 1] * (upto[j] - upto[:j])
            i = int(tried.argmin())
            if tried[i] < best[j]:
                best[j], came[j] = tried[i], i
        choice.append(came)
        cost = best
    bounds, j = [], len(lengths)
    for came in reversed(choice):
        if came[j] >= 0:
            bounds.append(int(top[j - 1]))
            j = int(came[j])
    if j > 0:
        bounds.append(int(top[j - 1]))
    return sorted(bounds)


def pieces_of(docs: DataFrame, packing: Packing) -> DataFrame:
    """doc_id, piece, start, n_tokens: parts of at most `max_tokens`."""
    longest = packing.max_tokens
    n = F.col("tokens")
    return (
        docs.select("doc_id", count_tokens(F.col("text")).alias("tokens"))
        .where(n > 0)
        .select("doc_id", "tokens", F.explode(F.sequence(F.lit(0), F.expr(f"(tokens - 1) DIV {longest}").cast("int"))).alias("piece"))
        .withColumn("start", F.col("piece").cast("bigint") * longest)
        .select("doc_id", "piece", "start", F.least(n - F.col("start"), F.lit(longest)).alias("n_tokens"))
    )


def pack(docs: DataFrame, packing: Packing | None = None) -> DataFrame:
    """A row for each piece: doc_id, piece, start, n_tokens, bucket_len, batch, slot."""
    packing = packing or Packing()
    pieces = stored(pieces_of(docs, packing), "pieces")
    histogram = sorted((r["n_tokens"], r["n"]) for r in pieces.groupBy("n_tokens").agg(F.count("*").alias("n")).collect())
    bounds = choose_buckets([n for n, _ in histogram], [c for _, c in histogram], packing.buckets)
    if not bounds:
        bounds = [packing.max_tokens]
    fits = F.element_at(F.filter(array_literal(bounds, "bigint"), lambda b: b >= F.col("n_tokens")), 1)
    key = F.xxhash64(F.col("doc_id").cast("string"), "piece", F.lit(packing.seed))
    placed = pieces.withColumns({"bucket_len": fits, "key": key}).withColumn("bin", F.pmod("key", F.lit(BINS)).cast("int"))
    before = Window.partitionBy("bucket_len").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("bucket_len", "bin")
        .agg(F.count("*").alias("in_bin"))
        .withColumn("offset", F.coalesce(F.sum("in_bin").over(before), F.lit(0)))
        .drop("in_bin")
    )
    in_bin = Window.partitionBy("bucket_len", "bin").orderBy("key", "doc_id", "piece", "n_tokens")
    per_batch = F.greatest(F.lit(1), F.expr(f"{packing.batch_tokens} DIV bucket_len"))
    number = F.col("offset") + F.row_number().over(in_bin) - 1
    return (
        placed.join(offsets, ["bucket_len", "bin"])
        .withColumn("number", number)
        .withColumn("per_batch", per_batch)
        .select(
            "doc_id",
            "piece",
            "start",
            "n_tokens",
            "bucket_len",
            F.expr("number DIV per_batch").alias("batch"),
            (F.col("number") % F.col("per_batch")).cast("int").alias("slot"),
        )
    )
