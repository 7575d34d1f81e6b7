"""Conversations in reply order, by linking quotations to what they quote.

A line's quote level is the number of `>` marks at its start (blanks between them
allowed).  Runs of lines of one level are passages; those of level 0 are the
message's own words.  Passages and lines are normalised (lower case, one space
for each white space run) and hashed.  The first message of a conversation that
has a passage among its own words is its origin, found by one join on
(conversation, hash) against one row per hash; so a passage that stands in very
many messages adds no pairs.

A message replies to the latest earlier origin of its passages of level 1, or of
deeper ones if those have none.  Following replies upwards (by pointer doubling)
gives each message the first one of its thread and its depth; the reply order of a
conversation is (thread_turn, turn): threads by their first message, each in its
own order, and messages without quotations where they stood.

Cases: NULL and empty texts have no words and quote nothing; a quotation of words
that stand nowhere earlier links to nothing, and its lines are removed all the
same; a NULL conv_id or turn links to nothing; rows that repeat (conv_id, turn)
are read each on its own, and links to that turn lead to all of them; columns
beyond the four are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimstrata.llm.shared import stored

MARKS = r"^(?:[ \t]*>)+"


def normal(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), r"\s+", " "))


def passages(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, runs: array of (level, body), each row on its own."""
    lines = F.split(F.coalesce("text", F.lit("")), r"\r?\n")
    level = lambda line: F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))
    body = lambda line: F.regexp_replace(line, MARKS + " ?", "")
    changes = F.filter(
        F.sequence(F.lit(0), F.size("lines") - 1),
        lambda i: (i == 0) | (F.get("levels", i) != F.get("levels", i - 1)),
    )
    ends = F.concat(F.slice("starts", F.lit(2), F.greatest(F.size("starts") - 1, F.lit(0))), F.array(F.size("lines")))
    runs = F.zip_with(
        "starts",
        ends,
        lambda s, e: F.struct(
            F.get("levels", s).alias("level"), F.array_join(F.slice("lines", s + 1, e - s), "\n").alias("body")
        ),
    )
    return (
        messages.select("conv_id", "turn", "role", lines.alias("lines"))
        .withColumn("levels", F.transform("lines", level))
        .withColumns({"lines": F.transform("lines", body), "starts": changes})
        .select("conv_id", "turn", "role", runs.alias("runs"))
    )


def _units(body: Column) -> Column:
    """Hashes of a passage as a whole and of its lines, without empty ones."""
    texts = F.concat(F.array(body), F.split(body, "\n"))
    kept = F.filter(F.transform(texts, normal), lambda t: F.length(t) > 0)
    return F.transform(F.array_distinct(kept), lambda t: F.xxhash64(t))


def reply_links(runs: DataFrame) -> DataFrame:
    """conv_id, turn, parent_turn, n_linked for messages with a linked quotation."""
    known = runs.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    own = F.array_join(F.transform(F.filter("runs", lambda r: r["level"] == 0), lambda r: r["body"]), "\n")
    alone = F.flatten(F.transform(F.filter("runs", lambda r: r["level"] == 0), lambda r: _units(r["body"])))
    quoted = known.where(F.exists("runs", lambda r: r["level"] > 0)).select(
        "conv_id", "turn", F.explode(F.filter("runs", lambda r: r["level"] > 0)).alias("run")
    )
    quotes = quoted.select(
        "conv_id", "turn", F.col("run.level").alias("level"), F.explode(_units(F.col("run.body"))).alias("unit")
    ).distinct()
    origins = (
        known.select("conv_id", "turn", F.explode(F.array_distinct(F.concat(_units(own), alone))).alias("unit"))
        .groupBy("conv_id", "unit")
        .agg(F.min("turn").alias("origin"))
    )
    linked = quotes.join(origins, ["conv_id", "unit"]).where(F.col("origin") < F.col("turn"))
    nearest = F.coalesce(F.max(F.when(F.col("level") == 1, F.col("origin"))), F.max("origin"))
    return linked.groupBy("conv_id", "turn").agg(
        nearest.alias("parent_turn"), F.countDistinct("origin").alias("n_linked")
    )


def threads(links: DataFrame) -> DataFrame:
    """conv_id, turn, thread_turn, depth of each reply, by pointer doubling."""
    now = stored(
        links.select("conv_id", "turn", F.col("parent_turn").alias("thread_turn"), F.lit(1).alias("depth")), "threads"
    )
    while True:
        above = now.select("conv_id", F.col("turn").alias("thread_turn"), F.col("thread_turn").alias("up"), F.col("depth").alias("more"))
        joined = now.join(above, ["conv_id", "thread_turn"], "left")
        after = stored(
            joined.select(
                "conv_id",
                "turn",
                F.coalesce("up", "thread_turn").alias("thread_turn"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("up").isNotNull().alias("moved"),
            ),
            "threads",
        )
        now = after.drop("moved")
        if after.where("moved").isEmpty():
            return now


def reply_order(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, thread_turn, turn, depth, role, parent_turn,
    text (own words), n_quotes (passages), n_linked (messages quoted)."""
    runs = stored(passages(messages), "passages")
    links = stored(reply_links(runs), "replies")
    told = links.join(threads(links), ["conv_id", "turn"])
    words = F.transform(F.filter("runs", lambda r: r["level"] == 0), lambda r: F.btrim(r["body"], F.lit(" \t\r\n")))
    text = F.array_join(F.filter(words, lambda t: F.length(t) > 0), "\n")
    return (
        runs.join(told, ["conv_id", "turn"], "left")
        .select(
            "conv_id",
            F.coalesce("thread_turn", "turn").alias("thread_turn"),
            "turn",
            F.coalesce("depth", F.lit(0)).alias("depth"),
            "role",
            "parent_turn",
            text.alias("text"),
            F.size(F.filter("runs", lambda r: r["level"] > 0)).alias("n_quotes"),
            F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        )
    )
