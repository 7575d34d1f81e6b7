"""Document fingerprints by I-Match over several randomised lexicons.

The lexicon holds the terms whose inverse document frequency lies in a band:
terms that are neither in nearly every document nor in very few.  A document's
distinct lexicon terms are sorted and hashed; the same is done for randomised
subsets of the lexicon, so that small edits leave some of the hashes alone.  The
subsets of each draw thin out (1/4, 1/16, 1/64, 1/256 of the lexicon): whatever a
text's length, some of them keep about one of its terms, and the share of equal
hashes among the subsets with any term grows with the terms in common.

Terms are runs of letters and digits, lower-cased, known by their 64-bit hash.
Document frequencies of all terms are counted over all documents, summed up in each
task before they are shuffled.  A term of the band is in a share `least_share` of the
documents at least, so the lexicon has no more terms than distinct terms of an average
document / least_share, however large the corpus: some 2 MB for 250 terms a document.
Every task holds it as a table of small buckets.

`fingerprint_edits` also needs the next document in descending doc_id.  Documents
are split at quantiles of doc_id (at most 65,536 ranges) and sorted within a range;
the first document of each range is sent to the range before it as well, so one
shuffle carries each text once.

Cases: NULL text counts as empty; a text without a term in the band uses all its
terms, one without any term has the empty fingerprint; two empty fingerprints are
alike (1), an empty and another are not (0); equal texts have equal fingerprints;
a NULL doc_id sorts after all others; rows that repeat a doc_id are ordered by
text, descending; of one document alone the next is itself.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimstrata.llm.shared import array_literal, stored

MAX_RANGES = 1 << 16
# Buckets that one row of a step towards the lexicon's table holds.
PART = 1024


@dataclass(frozen=True)
class IMatch:
    """Band as shares of all documents; subsets of 1 / 2^level (8 at most) per draw."""

    least_share: float = 0.001
    most_share: float = 0.1
    draws: int = 16
    levels: tuple[int, ...] = (2, 4, 6, 8)
    docs_per_range: int = 64


def terms_of(text: Column) -> Column:
    """Sorted distinct hashes of a text's terms."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 0)
    return F.sort_array(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))


def lexicon(docs: DataFrame, n_docs: int, settings: IMatch) -> DataFrame:
    """term: hashes of the terms in the band, each once."""
    return (
        docs.select(F.explode(terms_of(F.col("text"))).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("df"))
        .where(F.col("df").between(settings.least_share * n_docs, settings.most_share * n_docs))
        .select("term")
    )


def _bucket(term: Column, n_buckets: int) -> Column:
    return term.bitwiseAND(F.lit(n_buckets - 1).cast("bigint")).cast("int")


def lexicon_table(terms: DataFrame, n_buckets: int) -> Column:
    """The terms as one array of buckets, by their last bits; a power of two of buckets."""
    none = F.lit(None).cast("bigint")
    every = terms.sparkSession.range(n_buckets).select(F.col("id").cast("int").alias("bucket"), none.alias("term"))
    buckets = terms.select(_bucket(F.col("term"), n_buckets).alias("bucket"), "term").unionByName(every)
    in_order = lambda key, value: F.transform(F.sort_array(F.collect_list(F.struct(key, value))), lambda x: x[value])
    filled = buckets.groupBy("bucket").agg(F.collect_list("term").alias("held"))  # one or two terms, on average
    parts = filled.groupBy((F.col("bucket") / PART).cast("int").alias("part")).agg(in_order("bucket", "held").alias("buckets"))
    # A scalar subquery travels with the tasks as plain bytes, not as a literal of the plan.
    return parts.agg(F.flatten(in_order("part", "buckets")).alias("table")).scalar()


def marked(terms: Column, table: Column, n_buckets: int) -> Column:
    """Each term and whether it is in the band."""
    known = lambda t: F.array_contains(F.get(table, _bucket(t, n_buckets)), t)
    return F.transform(terms, lambda t: F.struct(t.alias("term"), known(t).alias("known")))


def chosen(marks: Column) -> Column:
    """Terms in the band, or all of them if none is."""
    kept = F.filter(marks, lambda m: m["known"])
    return F.when(F.size(kept) > 0, kept).otherwise(marks)["term"]


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def with_fingerprint(df: DataFrame, terms: str, name: str, settings: IMatch) -> DataFrame:
    """`df` with the hashes of the sorted terms in each lexicon subset.

    An entry is NULL where the subset has none of the terms.  Entry 0 stands for
    the whole lexicon; subset `level` of a draw holds the terms whose eight bits
    for that draw begin with `level` zeros.  One hash has bits for eight draws.
    """

    def hashed(kept: str) -> Column:
        return F.when(F.size(kept) > 0, F.xxhash64(kept))

    def rehashed(seed: int) -> Column:
        return F.transform(terms, lambda t: F.xxhash64(t, F.lit(seed)))

    def thinned(array: str, mask: int) -> Column:
        return F.filter(array, lambda t: t.bitwiseAND(F.lit(_signed(mask))) == 0)

    draws = range(settings.draws)
    seeds = [f"{name}_seed{i}" for i in range(-(-settings.draws // 8))]
    left = {draw: f"{name}_left{draw}" for draw in draws}
    entries = [f"{name}_whole"]
    df = df.withColumns({c: rehashed(i) for i, c in enumerate(seeds)} | {entries[0]: hashed(terms)})
    # Each level filters what the one before has left.
    before = {draw: seeds[draw // 8] for draw in draws}
    for level in settings.levels:
        df = df.withColumns(
            {left[d]: thinned(before[d], ((1 << level) - 1) << 8 * (d % 8)) for d in draws}
        )
        found = {f"{name}_hash{level}_{d}": hashed(left[d]) for d in draws}
        df = df.withColumns(found)
        entries += found
        before = left
    return df.withColumn(name, F.array(*entries)).drop(*seeds, *left.values(), *entries)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that hold a term of either text."""
    either = F.size(F.filter(F.zip_with(a, b, lambda x, y: F.coalesce(x, y)), lambda x: x.isNotNull()))
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: F.coalesce(x, F.lit(False))))
    return F.when(either > 0, equal / either).otherwise(F.lit(1.0))


def readable(fingerprint: Column) -> Column:
    """The last eight hexadecimal digits per subset, `-` for an empty one."""
    return F.array_join(
        F.transform(fingerprint, lambda h: F.coalesce(F.lower(F.right(F.lpad(F.hex(h), 16, "0"), F.lit(8))), F.lit("-"))), ""
    )


def _ranges(docs: DataFrame, n_docs: int, settings: IMatch) -> tuple[Column, list[tuple[int, int | None]]]:
    """Range number of a doc_id, and the largest doc_id of each range in use."""
    wanted = min(MAX_RANGES, n_docs // settings.docs_per_range)
    splits: list[int] = []
    if wanted > 1:
        shares = F.array(*[F.lit(i / wanted) for i in range(1, wanted)])
        splits = docs.agg(F.percentile_approx("doc_id", shares, 10 * wanted)).collect()[0][0] or []
    splits = sorted(set(splits))
    number = F.lit(0)
    if splits:
        # Two steps of about the square root each find the place among the splits.
        step = max(1, math.isqrt(len(splits)))
        all_splits = array_literal(splits, "bigint")
        coarse = array_literal(splits[step - 1 :: step], "bigint")
        below = F.size(F.filter(coarse, lambda s: s < F.col("doc_id"))) * step
        fine = F.slice(all_splits, below + 1, F.lit(step))
        number = F.coalesce(below + F.size(F.filter(fine, lambda s: s < F.col("doc_id"))), F.lit(0))
    tops = docs.groupBy(number.alias("number")).agg(F.max("doc_id").alias("top")).collect()
    return number, sorted((row["number"], row["top"]) for row in tops)


def fingerprint_edits(docs: DataFrame, settings: IMatch | None = None) -> DataFrame:
    """One row per document: its fingerprint, its edited text's, and likenesses.

    The edited text is the document with its last half (rounded down, in code
    points) replaced by as much of the beginning of the next document.
    """
    settings = settings or IMatch()
    docs = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    n_docs = docs.count()
    known_terms = stored(lexicon(docs, n_docs, settings), "lexicon")
    n_buckets = 1 << max(1, known_terms.count() - 1).bit_length()
    number, tops = _ranges(docs, n_docs, settings)

    # Each range ends with a copy of the document that comes next, the last range
    # (number 0) with the first document of all.
    place = lambda n, extra: F.struct(n.cast("int").alias("number"), F.lit(extra).alias("extra"))
    copies = F.array(place(number, False))
    known = [(n, top) for n, top in tops if top is not None]
    below = [top for _, top in known[:-1]]
    if below:
        above = array_literal([n for n, _ in known[1:]], "int")
        at = F.array_position(array_literal(below, "bigint"), F.col("doc_id")).cast("int")
        copies = F.when(
            F.col("doc_id").isin(below), F.concat(copies, F.array(place(F.element_at(above, at), True)))
        ).otherwise(copies)
    first = F.col("doc_id") == known[-1][1] if known else F.col("doc_id").isNull()
    last_range = F.lit(tops[0][0] if tops else 0)
    copies = F.when(first, F.concat(copies, F.array(place(last_range, True)))).otherwise(copies)
    spread = docs.select("doc_id", "text", F.explode(copies).alias("place")).select(
        "doc_id", "text", "place.number", "place.extra"
    )

    order = Window.partitionBy("number").orderBy("extra", F.desc_nulls_last("doc_id"), F.desc("text"))
    n_chars, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substr("text", F.lit(1), n_chars - half), F.substr(F.coalesce("next_text", F.lit("")), F.lit(1), half)
    )
    paired = (
        spread.withColumn("next_text", F.lead("text").over(order))
        .withColumn("edited", edited)
        .withColumns({"terms": terms_of(F.col("text")), "edited_terms": terms_of(F.col("edited"))})
        .withColumns(
            {
                "edited_sha256": F.sha2("edited", 256),
                "own_table": lexicon_table(known_terms, n_buckets),
                "edited_table": lexicon_table(known_terms, n_buckets),
            }
        )
        # Tables and terms are used once, so the steps merge; as a column a table would be copied for every row.
        .withColumns(
            {
                "terms": marked(F.col("terms"), F.col("own_table"), n_buckets),
                "edited_terms": marked(F.col("edited_terms"), F.col("edited_table"), n_buckets),
            }
        )
        .drop("next_text", "edited", "own_table", "edited_table")
        .withColumns({"terms": chosen(F.col("terms")), "edited_terms": chosen(F.col("edited_terms"))})
    )
    own = with_fingerprint(with_fingerprint(paired, "terms", "own", settings), "edited_terms", "changed", settings)
    return (
        own.withColumn("next", F.lead("own").over(order))
        .where(~F.col("extra"))
        .select(
            "doc_id",
            n_chars.cast("bigint").alias("n_chars"),
            "edited_sha256",
            readable(F.col("own")).alias("fingerprint"),
            readable(F.col("changed")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("changed")).alias("near_edited"),
            likeness(F.col("own"), F.col("next")).alias("near_next"),
        )
    )
