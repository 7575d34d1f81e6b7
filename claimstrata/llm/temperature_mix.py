"""Mixing of sources by temperature.

A source's weight is its share of all tokens to the power of an exponent between
0 (all sources alike) and 1 (as they are), normalised.  Entropy falls and the
smallest source's number of repetitions falls as the exponent grows, so both
targets are met by bisection: the exponent is the larger one of what the target
entropy and the repetition limit ask for.  Each pass over the sources' totals
tries fifteen exponents, four bisections at once.

Weights times the token budget give each source a number of whole epochs and a
rest.  An epoch is a permutation of the source's documents by a seeded hash; the
rest is a prefix of one more permutation, cut where its tokens are used up.  Cuts
are found from token sums per hash bin; only the documents of the bin that holds
the cut are ordered one by one.  Every copy gets a place in the stream, spread
evenly over it for each source, and with it a block of about `block_tokens`.

Tokens are words between ASCII spaces.  Cases: NULL sources form a source of
their own; a source without a token has weight 0; NULL and empty texts have no
tokens and follow their hash; rows that repeat a doc_id share their place in each
permutation and are cut together; an empty table gives an empty result; a budget
that even proportional weights cannot meet within the repetition limit is used
with exponent 1.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimstrata.llm.shared import own_name, stored

BINS = 4096
TRIES = 15
PASSES = 5


@dataclass(frozen=True)
class Mix:
    """Target entropy as a share of its maximum; budget as a share of all tokens."""

    target_entropy: float = 0.95
    repetition_limit: float = 4.0
    budget: float = 1.0
    block_tokens: int = 1_000_000
    seed: int = 17


def count_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _key(doc_id: Column, copy: Column | int, mix: Mix) -> Column:
    copy = F.lit(copy) if isinstance(copy, int) else copy
    return F.xxhash64(doc_id.cast("string"), copy.cast("int"), F.lit(mix.seed))


def _unit(key: Column) -> Column:
    """A place in [0, 1) from a hash."""
    return F.shiftrightunsigned(key, 11) / float(1 << 53)


def find_exponent(sources: DataFrame, mix: Mix) -> float:
    """Exponent for `sources` (tokens per source); 1 for an empty table."""
    some = sources.where(F.col("tokens") > 0)
    total = some.agg(F.sum("tokens")).collect()[0][0]
    if not total:
        return 1.0
    logs = some.select(F.log(F.col("tokens") / total).alias("log_share"))

    def meets(exponents: list[float]) -> list[bool]:
        """For each exponent: entropy at most the target, repetitions within the limit."""
        # Rounded terms add up to the same sum in any order.
        exact = lambda c: F.sum(F.round(c * (1 << 20)).cast("decimal(38,0)")).cast("double") / (1 << 20)
        power = [F.exp(F.lit(a) * F.col("log_share")) for a in exponents]
        row = logs.agg(
            F.count("*").alias("n"),
            F.min("log_share").alias("least"),
            *[exact(p * 1e6).alias(f"z{i}") for i, p in enumerate(power)],
            *[exact(p * F.col("log_share") * 1e6).alias(f"s{i}") for i, p in enumerate(power)],
        ).collect()[0]
        said = []
        for i, a in enumerate(exponents):
            z, s = row[f"z{i}"] / 1e6, row[f"s{i}"] / 1e6
            entropy = math.log(z) - a * s / z
            repeats = mix.budget * math.exp((a - 1) * row["least"]) / z
            said.append(entropy <= mix.target_entropy * math.log(row["n"]) + 1e-12 and repeats <= mix.repetition_limit)
        return said

    low, high = 0.0, 1.0  # too flat or just right, steep enough or the end
    if meets([low])[0]:
        return low
    for _ in range(PASSES):
        tries = [low + (high - low) * (i + 1) / (TRIES + 1) for i in range(TRIES)]
        said = meets(tries)
        first = said.index(True) if True in said else TRIES
        low, high = (low, *tries)[first], (*tries, high)[first]
    return high


def plan_mix(docs: DataFrame, mix: Mix) -> DataFrame:
    """Per source: weight, whole epochs, cut (largest key of the rest), stretch.

    `docs` has source, doc_id and tokens.  `stretch` is the number of epochs,
    fraction included.
    """
    sources = stored(docs.groupBy("source").agg(F.sum("tokens").alias("tokens")), "sources")
    exponent = find_exponent(sources, mix)
    power = F.when(F.col("tokens") > 0, F.exp(exponent * F.log("tokens"))).otherwise(0.0)
    sums = sources.agg(F.sum(power.cast("decimal(38,6)")), F.sum("tokens")).collect()[0]
    whole, tokens = float(sums[0] or 1), int(sums[1] or 0)
    budgeted = (
        sources.withColumn("weight", power / whole)
        .withColumn("budget", F.floor(F.col("weight") * (mix.budget * tokens)).cast("bigint"))
        .withColumn("epochs", F.when(F.col("tokens") > 0, F.expr("budget DIV tokens")).otherwise(0).cast("int"))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
        .withColumn("stretch", F.when(F.col("tokens") > 0, F.col("budget") / F.col("tokens")).otherwise(0.0))
    )
    key = _key(F.col("doc_id"), -1, mix)
    keyed = docs.select("source", "tokens", key.alias("key"), F.floor(_unit(key) * BINS).cast("int").alias("bin"))
    bins = keyed.groupBy("source", "bin").agg(F.sum("tokens").alias("in_bin"))
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    counted = bins.withColumn("after", F.sum("in_bin").over(upto)).alias("c")
    filled = (
        counted.join(budgeted.alias("b"), F.col("c.source").eqNullSafe(F.col("b.source")))
        .groupBy(F.col("c.source"))
        .agg(
            # All bins that fit; the next one holds the cut.
            F.max(F.when(F.col("after") <= F.col("rest"), F.col("after"))).alias("used"),
            F.min(F.when(F.col("after") > F.col("rest"), F.col("bin"))).alias("cut_bin"),
        )
    )
    open_bins = (
        budgeted.alias("b")
        .join(filled.alias("f"), same(_Names("b"), _Names("f")), "left")
        .select("b.*", F.coalesce("used", F.lit(0)).alias("used"), F.coalesce("cut_bin", F.lit(BINS)).alias("cut_bin"))
    )
    peers = Window.partitionBy("k.source").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    last = (
        keyed.alias("k")
        .join(open_bins.alias("o"), same(_Names("k"), _Names("o")) & (F.col("bin") == F.col("cut_bin")))
        .withColumn("spent", F.col("used") + F.sum("k.tokens").over(peers))
        .where(F.col("spent") <= F.col("rest"))
        .groupBy(F.col("k.source"))
        .agg(F.max(_unit(F.col("key"))).alias("last_place"))
    )
    return (
        open_bins.alias("o")
        .join(last.alias("l"), same(_Names("o"), _Names("l")), "left")
        .select(
            "o.source",
            "weight",
            "epochs",
            "stretch",
            F.lit(max(1, round(mix.budget * tokens / mix.block_tokens))).alias("n_blocks"),
            # Without a budget there is no cut: nothing of the source is taken.
            F.when(F.col("budget") > 0, F.greatest(F.col("cut_bin") / float(BINS) - 2.0**-53, "last_place")).alias("cut"),
        )
    )


class _Names:
    """Columns of an aliased table, by name."""

    def __init__(self, alias: str) -> None:
        self.alias = alias

    def __getitem__(self, name: str) -> Column:
        return F.col(f"{self.alias}.{name}")


def mix_sources(docs: DataFrame, mix: Mix | None = None, prefix: str = "") -> DataFrame:
    """A row for each copy of a document in the mix: all columns of `docs` and
    n_tokens, weight (of the source), copy, place and block, named with `prefix`."""
    mix = mix or Mix()
    spare = {n: own_name(docs, f"mix__{n}") for n in ("source", "weight", "epochs", "stretch", "n_blocks", "cut", "copies")}
    tokens = F.when(F.length("text") > 0, count_tokens(F.col("text"))).otherwise(0).cast("bigint")
    counts = stored(docs.select("source", "doc_id", tokens.alias("tokens")), "tokens")
    plan = stored(plan_mix(counts, mix), "plan").select(
        *[F.col(n).alias(spare[n]) for n in ("source", "weight", "epochs", "stretch", "n_blocks", "cut")]
    )
    of = {n: F.col(c) for n, c in spare.items()}
    extra = F.when(_unit(_key(F.col("doc_id"), -1, mix)) <= of["cut"], 1).otherwise(0)
    copy = F.col(f"{prefix}copy")
    # The rest keeps the order in which it was cut, from the start of its epoch.
    key = F.when(copy < of["epochs"], _key(F.col("doc_id"), copy, mix)).otherwise(_key(F.col("doc_id"), -1, mix))
    place = F.least(F.try_divide(copy + _unit(key), of["stretch"]), F.lit(1 - 2.0**-53))
    return (
        docs.join(plan, docs["source"].eqNullSafe(of["source"]))
        .withColumn(spare["copies"], of["epochs"] + extra)
        .where(of["copies"] > 0)
        .withColumn(f"{prefix}copy", F.explode(F.sequence(F.lit(0), of["copies"] - 1)))
        .select(
            *docs.columns,
            tokens.alias(f"{prefix}n_tokens"),
            of["weight"].alias(f"{prefix}weight"),
            copy,
            place.alias(f"{prefix}place"),
            F.floor(place * of["n_blocks"]).cast("bigint").alias(f"{prefix}block"),
        )
    )


def mixed_documents(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """The copies as rows with the columns of `docs`."""
    prefix = own_name(docs, "mixed") + "__"
    return mix_sources(docs, mix, prefix).select(*docs.columns)
