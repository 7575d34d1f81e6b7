"""Quality rules: base counts of a text, and how it compares with trusted texts.

Words and word pairs are hashed into buckets, `PER_ROOT` for each square root of the
corpus' characters and `BUCKETS` at least.  Two multinomials over the buckets, one of
all trusted documents and one of the whole corpus, give a log-likelihood ratio for
each bucket.  A document's score is the mean ratio of its words and pairs; it is kept
if the score reaches a fixed threshold and the base rules hold.

The model grows with the corpus: a word or pair stands out in its bucket once it is
more frequent than an average bucket, and of a corpus n times as large this holds for
all that are a root of n times rarer.  Rarer ones mix to ratios near 0.

One pass adds up the characters, one counts buckets and sums up before it shuffles,
one judges each text within its own row, by one array of all ratios that every task
holds: 2 bytes a bucket, 0.5 MB for 1 GB of text, 16 MB for 1 TB, 160 MB for 100 TB.
The plan is the same at every size.  Up to `BROADCAST_IDS` trusted ids are broadcast,
more are joined.

Cases: NULL and empty texts have no words and fail the base rules; a table
without trusted documents gives ratio 0 everywhere, so the base rules decide;
repeated rows are judged alike; a NULL doc_id is never trusted; columns of the
table beyond doc_id and text are passed through untouched or not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimstrata.llm.shared import own_name, split_words, stored

# Least number of buckets, and buckets for each square root of the corpus' characters.
BUCKETS = 8192
PER_ROOT = 8
# Buckets that one row of a step towards the array of ratios holds.
SLOT = 4096
# Bound of the ids that are broadcast: 8 MB.
BROADCAST_IDS = 1_000_000
SYMBOLS = r"[#*$%&|<>]"
# Ratios are kept as whole thousandths: short to send, exact to add.
SCALE = 1000


@dataclass(frozen=True)
class QualityLimits:
    min_words: int = 50
    # Share of words in repeated three-word windows, in percent.
    max_repeat_percent: int = 50
    # Least mean log ratio (natural logarithm) of a kept document.
    least_ratio: float = -0.10
    # All trusted documents, or so many: smallest hashes of doc_id first.
    trusted_docs: int | None = None
    smoothing: float = 1.0


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _tail(array: Column, first: int) -> Column:
    return F.slice(array, F.lit(first), F.greatest(F.size(array) - F.lit(first - 1), F.lit(0)))


def pair_hashes(left: Column, words: Column, skip: int) -> Column:
    """Hash of each element of `left` with the word `skip` places further on."""
    right = _tail(words, skip + 1)
    return F.zip_with(F.slice(left, F.lit(1), F.size(right)), right, lambda a, b: F.xxhash64(a, b))


def trusted_rows(labels: DataFrame, limits: QualityLimits) -> DataFrame:
    """doc_id of the documents labelled good and not toxic, each once."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    chosen = good.select("doc_id").distinct()
    if limits.trusted_docs is None:
        return chosen
    return chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limits.trusted_docs)


def trusted_ids(labels: DataFrame, limits: QualityLimits) -> list[int]:
    """The same on the driver, for few ids."""
    return [row["doc_id"] for row in trusted_rows(labels, limits).collect()]


def _marked(docs: DataFrame, trusted: DataFrame | list[int]) -> DataFrame:
    """text, trusted (boolean) of each row."""
    if isinstance(trusted, list):
        is_trusted = F.col("doc_id").isin(trusted) if trusted else F.lit(False)
        return docs.select("text", is_trusted.alias("trusted"))
    ids = trusted.select("doc_id").where(F.col("doc_id").isNotNull()).distinct().withColumn("trusted", F.lit(True))
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.select("doc_id", "text").join(ids, "doc_id", "left").select("text", "trusted")


def bucket_number(docs: DataFrame) -> int:
    """Number of buckets for the words and pairs of all rows."""
    n_chars = docs.select(F.sum(F.length("text"))).first()[0] or 0
    return max(BUCKETS, PER_ROOT * math.isqrt(n_chars))


def _bucket(gram: Column, n_buckets: int) -> Column:
    return F.pmod(gram, F.lit(n_buckets).cast("bigint")).cast("int")


def bucket_counts(docs: DataFrame, trusted: DataFrame | list[int], n_buckets: int) -> DataFrame:
    """bucket, n (all documents), n_trusted: words and word pairs of the corpus; a row for each bucket."""
    hashed = _marked(docs, trusted).select("trusted", word_hashes(split_words(F.col("text"))).alias("words"))
    grams = hashed.select(
        "trusted", F.explode(F.concat("words", pair_hashes(F.col("words"), F.col("words"), 1))).alias("gram")
    )
    counted = grams.groupBy(_bucket(F.col("gram"), n_buckets).alias("bucket")).agg(
        F.count("*").alias("n"), F.count_if("trusted").alias("n_trusted")
    )
    none = F.lit(0).cast("bigint")
    unused = docs.sparkSession.range(n_buckets).select(F.col("id").cast("int").alias("bucket"), none.alias("n"), none.alias("n_trusted"))
    return counted.unionByName(unused).groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("n_trusted").alias("n_trusted"))


def log_ratios(counts: DataFrame, n_buckets: int, smoothing: float) -> DataFrame:
    """bucket, ratio: scaled log ratio of each bucket; all 0 without trusted counts."""
    all_n, all_trusted = counts.select(F.sum("n"), F.sum("n_trusted")).first()
    if not all_trusted:
        return counts.select("bucket", F.lit(0).cast("smallint").alias("ratio"))
    more = smoothing * n_buckets
    log_share = lambda n, whole: F.log((F.col(n) + smoothing) / F.lit(whole + more))
    ratio = F.round((log_share("n_trusted", all_trusted) - log_share("n", all_n)) * SCALE)
    return counts.select("bucket", F.greatest(F.least(ratio, F.lit(32767)), F.lit(-32767)).cast("smallint").alias("ratio"))


def ratio_array(ratios: DataFrame) -> Column:
    """The ratios of all buckets as one array, by bucket.

    A scalar subquery travels with the tasks as plain bytes, not as a literal of the plan.
    """
    in_order = lambda key, value: F.transform(F.sort_array(F.collect_list(F.struct(key, value))), lambda x: x[value])
    slots = ratios.groupBy((F.col("bucket") / SLOT).cast("int").alias("slot")).agg(in_order("bucket", "ratio").alias("part"))
    return slots.agg(F.flatten(in_order("slot", "part")).alias("ratios")).scalar()


def _ratio_sum(grams: Column, ratios: Column, n_buckets: int) -> Column:
    return F.aggregate(
        grams, F.lit(0).cast("bigint"), lambda acc, g: acc + F.get(ratios, _bucket(g, n_buckets))
    )


def _repeat_words(places: Column) -> Column:
    """Words under the three-word windows that start at the sorted `places`."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last"))
    return F.aggregate(
        places,
        start,
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"],
    )


def judge_quality(
    docs: DataFrame, trusted: DataFrame | list[int], limits: QualityLimits | None = None, prefix: str = ""
) -> DataFrame:
    """All columns of `docs` and the counts, score and verdict, named with `prefix`."""
    limits = limits or QualityLimits()
    n_buckets = bucket_number(docs)
    counts = stored(bucket_counts(docs, trusted, n_buckets), "buckets")
    ratios = log_ratios(counts, n_buckets, limits.smoothing)
    col = lambda name: F.col(prefix + name)
    words, hashes, pairs, windows, ordered, lines, grams, array, total = (
        own_name(docs, f"{prefix}__{n}")
        for n in ("words", "hashes", "pairs", "windows", "ordered", "lines", "grams", "array", "total")
    )
    array_of_ratios = ratio_array(ratios)
    # One step names both and the next uses each once, so the optimizer merges
    # the steps; as a column the array would be copied for every row.
    with_sum = lambda df: (
        df.withColumns({array: array_of_ratios, grams: F.concat(hashes, pairs)})
        .withColumn(total, _ratio_sum(F.col(grams), F.col(array), n_buckets))
        .drop(array, grams)
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    same = lambda a, b: F.get(F.col(ordered), b)["gram"].eqNullSafe(a)
    n_grams = F.size(hashes) + F.size(pairs)
    places = F.sort_array(
        F.transform(
            F.filter(ordered, lambda x, k: same(x["gram"], k - 1) | same(x["gram"], k + 1)), lambda x: x["at"]
        )
    )
    counted = (
        docs.withColumns({words: split_words(F.col("text")), lines: F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\x0c\r"))) > 0)})
        .withColumns(
            {
                hashes: word_hashes(F.col(words)),
                f"{prefix}n_words": F.size(words).cast("bigint"),
                f"{prefix}word_chars": F.length(F.array_join(words, "")).cast("bigint"),
                f"{prefix}n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint"),
                f"{prefix}n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
            }
        )
        .drop(words, lines)
        .withColumn(pairs, pair_hashes(F.col(hashes), F.col(hashes), 1))
        .transform(with_sum)
        .withColumn(windows, pair_hashes(F.col(pairs), F.col(hashes), 2))
        .withColumns(
            {
                f"{prefix}ratio": F.when(n_grams > 0, F.col(total) / n_grams / SCALE),
                # Only texts with a repeated window are sorted.
                ordered: F.when(
                    F.size(F.array_distinct(windows)) < F.size(windows),
                    F.sort_array(F.transform(windows, lambda g, k: F.struct(g.alias("gram"), k.alias("at")))),
                ),
            }
        )
        .drop(hashes, pairs, windows, total)
        .withColumn(f"{prefix}n_repeat_words", F.when(F.col(ordered).isNotNull(), _repeat_words(places)).otherwise(F.lit(0)).cast("bigint"))
        .drop(ordered)
    )
    failed = (col("n_words") < limits.min_words) | (
        100 * col("n_repeat_words") > limits.max_repeat_percent * col("n_words")
    )
    return counted.withColumn(f"{prefix}base_failed", failed).withColumn(
        f"{prefix}kept", ~col("base_failed") & (F.coalesce(col("ratio"), F.lit(0.0)) >= limits.least_ratio)
    )


def keep_good(docs: DataFrame, trusted: DataFrame | list[int], limits: QualityLimits | None = None) -> DataFrame:
    """Documents that pass, as they are."""
    prefix = own_name(docs, "quality") + "__"
    judged = judge_quality(docs, trusted, limits, prefix)
    # Spark would push the verdict's filter below each of its steps and repeat them
    # there; it leaves a filter above a column that is not deterministic.
    row = f"{prefix}row"
    numbered = judged.withColumn(row, F.monotonically_increasing_id())
    return numbered.where(F.col(f"{prefix}kept") & (F.col(row) >= 0)).select(*docs.columns)
