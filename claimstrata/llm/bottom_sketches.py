"""Near-duplicate documents by bottom-k sketches.

A document's set holds its distinct shingles of `width` words (A-Z lower-cased,
split at ASCII spaces), each known by one 63-bit hash; a shorter text is one
shingle.  Documents are linked if their sets' Jaccard similarity is at least
`least_percent`; the result is the component of every document.

1. Each text yields the size of its set, a 128-bit digest of it, and its sketch,
   the k smallest hashes.  Equal sets form one class from here on.
2. Inverted lists: a linked pair has at least `least_overlap` of its retained
   values in common, so it meets in `least_meetings` lists of the values that are
   rarest among each class's own (all but a fixed number of its most frequent).
   Lists are cut by set size, since linked sets differ by a quarter at most.
   Pairs of small lists are counted: those that meet often enough are compared.
3. Each large list has a hub, its member with the most frequent values, and all
   its members are compared with the hub, so a pair with any meeting in a large
   list is in one group there.  The union of two sketches up to the smaller bound
   estimates the similarity, pairs far below are dropped, the others are confirmed
   on full sets.  A tight group of copies ends here, with one comparison each.
4. Members not linked to their hub are compared with each other and with those
   linked members that can reach them: Jaccard distance is a metric, so distances
   from the hub that differ by more than the link distance rule a pair out.
   Comparisons are dealt out as pairs of blocks of at most `block` members; a
   block pair yields a spanning forest of its links, not all of them.
5. Components of all links, then back to documents.

Bounds: sketches of sets up to 0.8 k hold the whole set and the bound on the
overlap is exact; for larger sets a pair just at the threshold misses
`least_overlap` = 28 of 64 with a probability below 1e-9.  Nothing is capped.

Cases: NULL and empty texts, and texts of spaces, have an empty set and are
linked with nothing; a NULL doc_id stands alone (component NULL, kept); rows that
repeat a doc_id are rows of their own that share what they are linked with; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimstrata.llm.components import components
from claimstrata.llm.shared import LOWER, UPPER, own_name, stored


@dataclass(frozen=True)
class NearDuplicates:
    width: int = 2
    least_percent: int = 80
    k: int = 64
    least_overlap: int = 28
    least_meetings: int = 3
    small_list: int = 8
    block: int = 128


_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_32 = np.uint64(32)
FILTER_BITS = 1 << 22
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = max(1 << 16, 1 << n.bit_length())
        with np.errstate(over="ignore"):
            _powers[:] = [
                np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size - 1, b, np.uint64))])
                for b in (_BASE, _INVERSE)
            ]
    return _powers


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _32)) * _MIX
    x = (x ^ (x >> _32)) * _MIX
    return x ^ (x >> _32)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial in its bytes, then mixed."""
    data = np.frombuffer(text.translate(_FOLD), np.uint8)
    inside = np.concatenate([[False], ~_IS_SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    powers, inverses = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    polynomial = (sums[ends] - sums[starts]) * inverses[starts]
    return _mixed(polynomial + (ends - starts).astype(np.uint64) * _STEP)


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    words = word_hashes(text or b"")
    if not len(words):
        return np.zeros(0, np.int64)
    size = min(width, len(words))
    hashed = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        hashed = _mixed(hashed * _STEP + words[i : len(words) - size + 1 + i])
    return np.unique(hashed >> np.uint64(1)).astype(np.int64)


def digest(hashes: np.ndarray) -> tuple[int, int]:
    raw = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def sketches(docs: DataFrame, settings: NearDuplicates) -> DataFrame:
    """doc_id, n_shingles, d1, d2 (digest), sketch of each row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), settings.width) for t in batch["__text"]]
            digests = [digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(map(len, sets), pa.int64()),
                    pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()),
                    _lists([s[: settings.k] for s in sets]),
                ],
                names=["doc_id", "n_shingles", "d1", "d2", "sketch"],
            )

    return docs.select("doc_id", F.col("text").cast("binary").alias("__text")).mapInArrow(
        sketch, f"doc_id {id_type}, n_shingles bigint, d1 bigint, d2 bigint, sketch array<bigint>"
    )


def _filter_words(ids: DataFrame) -> np.ndarray:
    """A bitmap of FILTER_BITS places in which those of the doc_ids are set."""
    bit = F.expr("shiftleft(1L, CAST(place & 63 AS INT))")
    rows = (
        ids.select(_filter_place("doc_id").alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .collect()  # at most FILTER_BITS / 64 rows
    )
    words = np.zeros(FILTER_BITS // 64, np.int64)
    for row in rows:
        words[row["word"]] = row["bits"]
    return words.view(np.uint64)


def _filter_place(doc_id: str) -> Column:
    return F.pmod(F.xxhash64(F.col(doc_id).cast("string")), F.lit(FILTER_BITS))


def full_sets(docs: DataFrame, classes: DataFrame, settings: NearDuplicates) -> DataFrame:
    """(cls, hashes): the whole sets of `classes` (cls, doc_id, d1, d2).

    A bitmap of fixed size spares most other documents the shuffle; those that it
    lets through are sorted out by the join.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(_filter_words(classes))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            place = batch["__place"].to_numpy().astype(np.uint64)
            met = np.flatnonzero((words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1))
            kept = batch.take(pa.array(met))
            sets = [shingle_set(t.as_py(), settings.width) for t in kept["__text"]]
            digests = [digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    kept["doc_id"],
                    pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()),
                    _lists(sets),
                ],
                names=["doc_id", "d1", "d2", "hashes"],
            )

    # The digest tells rows apart that repeat a doc_id with another text; equal
    # rows are one before they meet the classes.
    key = ["doc_id", "d1", "d2"]
    return (
        docs.where(F.col("doc_id").isNotNull())
        .select("doc_id", F.col("text").cast("binary").alias("__text"), _filter_place("doc_id").alias("__place"))
        .mapInArrow(build, f"doc_id {id_type}, d1 bigint, d2 bigint, hashes array<bigint>")
        .groupBy(*key)
        .agg(F.first("hashes").alias("hashes"))
        .join(classes, key)
        .select("cls", "hashes")
    )


def overlap_threshold(settings: NearDuplicates) -> Column:
    """Least number of retained values in common, from the set's size n."""
    whole = math.floor(settings.least_percent / 100 * settings.k)
    exact = F.ceil(F.col("n") * settings.least_percent / 100)
    return F.when(F.col("n") <= whole, exact).otherwise(F.lit(settings.least_overlap))


def hub_groups(classes: DataFrame, settings: NearDuplicates) -> DataFrame:
    """(hub, x) pairs to compare: members of large lists under each list's hub, and
    pairs that meet in at least `least_meetings` small lists."""
    values = classes.select("cls", F.explode("sketch").alias("v"))
    frequency = values.groupBy("v").agg(F.count("*").alias("df")).where(F.col("df") > 1)
    per_class = Window.partitionBy("cls")
    meetings = F.least(F.lit(settings.least_meetings), F.col("least"))
    shared = (
        values.join(frequency, "v")
        .withColumn("n_shared", F.count("*").over(per_class))
        .withColumn("rank", F.row_number().over(per_class.orderBy("df", "v")))
        .withColumn("fame", F.sum(F.round(F.log("df") * 1000).cast("bigint")).over(per_class))
        # The size of a class comes last: it does not travel with each of its values.
        .join(classes.select("cls", "n"), "cls")
        .withColumn("least", overlap_threshold(settings).cast("int"))
        .withColumn("meetings", meetings)
    )
    # Unshared values come first in the order, so they use up the prefix.  Linked
    # classes have `least` values in common, so `meetings` of them are in both prefixes.
    prefix = shared.where(F.col("rank") <= F.col("n_shared") - F.col("least") + F.col("meetings"))
    size = F.floor(F.log("n") / math.log(100 / settings.least_percent)).cast("int")
    # Written once: the joins above would else run again for every use below.
    lists = stored(prefix.select("v", "cls", size.alias("own"), "meetings", "fame"), "prefixes")
    # One shuffle by value: the lists of a value's sizes, their members and hubs need no other.
    placed = lists.repartition("v").select("*", F.explode(F.array("own", F.col("own") + 1)).alias("size"))
    in_order = Window.partitionBy("v", "size").orderBy("cls")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One number to choose a hub by: the fame, equals in an order of their own.
    standing = F.shiftleft("fame", 40) + F.xxhash64("cls").bitwiseAND(F.lit((1 << 40) - 1))
    member = F.struct("cls", "own", "meetings")
    met = placed.select(
        "*",
        F.count("*").over(whole).alias("members"),
        F.max_by("cls", standing).over(whole).alias("hub"),
        F.array(*(F.lead(member, i).over(in_order) for i in range(1, max(2, settings.small_list)))).alias("later"),
    ).where(F.col("members") > 1)
    # Small lists are written out: at most `small_list` members, each pair where
    # the larger of the two sizes is at home.
    at_home = lambda b: b.isNotNull() & (F.greatest(F.col("own"), b["own"]) == F.col("size"))
    row = lambda hub, x, wanted: F.struct(hub.alias("hub"), x.alias("x"), wanted.alias("wanted"))
    pairs = F.transform(
        F.filter("later", at_home), lambda b: row(F.col("cls"), b["cls"], F.least(F.col("meetings"), b["meetings"]))
    )
    # One meeting in a large list is enough.
    with_hub = F.filter(F.array(row(F.col("hub"), F.col("cls"), F.lit(1))), lambda r: r["hub"] != r["x"])
    return (
        met.select(F.explode(F.when(F.col("members") > settings.small_list, with_hub).otherwise(pairs)).alias("r"))
        .groupBy("r.hub", "r.x")
        .agg(F.count("*").alias("n"), F.min("r.wanted").alias("wanted"))
        .where(F.col("n") >= F.col("wanted"))
        .select("hub", "x")
    )


def estimate(a: Column, b: Column, k: int) -> Column:
    """Jaccard similarity from the union of two sketches up to the smaller bound."""
    everything = F.lit((1 << 63) - 1)
    bound = F.least(*(F.when(F.size(s) < k, everything).otherwise(F.element_at(s, -1)) for s in (a, b)))
    common = F.size(F.array_intersect(a, b))
    below = sum((F.size(F.filter(s, lambda v: v <= bound)) for s in (a, b)), F.lit(0))
    return common / (below - common)


def _linked(common: Column, union: Column, settings: NearDuplicates) -> Column:
    return 100 * common >= settings.least_percent * union


def compare_with_hub(groups: DataFrame, classes: DataFrame, settings: NearDuplicates) -> DataFrame:
    """(hub, x, candidate, far): what the sketches say about each member and its hub."""
    member = classes.select(F.col("cls").alias("x"), F.col("n").alias("n_x"), F.col("sketch").alias("sketch_x"))
    hub = classes.select(F.col("cls").alias("hub"), F.col("n").alias("n_h"), F.col("sketch").alias("sketch_h"))
    said = groups.join(member, "x").join(hub, "hub").withColumn("estimate", estimate(F.col("sketch_x"), F.col("sketch_h"), settings.k))
    alike = F.col("estimate") >= settings.least_overlap / settings.k
    sizes = _linked(F.least("n_x", "n_h"), F.greatest("n_x", "n_h"), settings)
    # So low an estimate that even twice the link distance is exceeded.
    far = F.col("estimate") <= 0.2
    return said.select("hub", "x", (alike & sizes).alias("candidate"), far.alias("far"))


def star_links(judged: DataFrame, sets: DataFrame, settings: NearDuplicates) -> DataFrame:
    """(hub, x, linked, least, most): exact distance of candidates, bounds for the rest."""
    mine = sets.select(F.col("cls").alias("x"), F.col("hashes").alias("of_x"))
    hubs = sets.select(F.col("cls").alias("hub"), F.col("hashes").alias("of_h"))
    common = F.size(F.array_intersect("of_x", "of_h"))
    exact = (
        judged.where("candidate")
        .select("hub", "x")
        .join(mine, "x")
        .join(hubs, "hub")
        .select("hub", "x", common.alias("common"), (F.size("of_x") + F.size("of_h")).alias("total"))
        .withColumn("union", F.col("total") - F.col("common"))
        .withColumn("distance", 1 - F.col("common") / F.col("union"))
        .select(
            "hub",
            "x",
            _linked(F.col("common"), F.col("union"), settings).alias("linked"),
            F.col("distance").alias("least"),
            F.col("distance").alias("most"),
        )
    )
    link = 1 - settings.least_percent / 100
    rest = judged.where(~F.col("candidate")).select(
        "hub", "x", F.lit(False).alias("linked"), F.when(F.col("far"), 2 * link).otherwise(0.0).alias("least"), F.lit(1.0).alias("most")
    )
    return exact.unionByName(rest)


def block_members(stars: DataFrame, settings: NearDuplicates) -> DataFrame:
    """(hub, p, q, x): members of the block pairs still to be compared.

    Blocks 0..a-1 hold members not linked to the hub, blocks a.. linked ones
    near enough to one of those.
    """
    link = 1 - settings.least_percent / 100
    loose = ~F.col("linked")
    open_groups = (
        stars.groupBy("hub")
        .agg(F.min(F.when(loose, F.col("least"))).alias("nearest"))
        .where(F.col("nearest").isNotNull())
    )
    within = stars.join(open_groups, "hub").where(loose | (F.col("most") >= F.col("nearest") - link - 1e-9))
    sizes = (
        within.groupBy("hub")
        .agg(F.count_if(loose).alias("n_loose"), F.count_if("linked").alias("n_near"))
        .where((F.col("n_loose") > 1) | (F.col("n_near") > 0))
        .select(
            "hub",
            F.ceil(F.col("n_loose") / settings.block).cast("int").alias("a"),
            F.ceil(F.col("n_near") / settings.block).cast("int").alias("b"),
        )
    )
    own = F.pmod(F.xxhash64("x"), F.when(loose, F.col("a")).otherwise(F.col("b"))).cast("int")
    pair = lambda p, q: F.struct(p.cast("int").alias("p"), q.cast("int").alias("q"))
    numbers = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    block = F.col("block")
    of_loose = F.concat(
        F.transform(numbers(F.col("a")), lambda j: pair(F.least(block, j), F.greatest(block, j))),
        F.transform(numbers(F.col("b")), lambda j: pair(block, F.col("a") + j)),
    )
    of_near = F.transform(numbers(F.col("a")), lambda i: pair(i, F.col("a") + block))
    return (
        within.join(sizes, "hub")
        .withColumn("block", own)
        .select("hub", "x", F.explode(F.when(loose, of_loose).otherwise(of_near)).alias("pair"))
        .select("hub", "pair.p", "pair.q", "x")
    )


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of incidence matrices."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    met = count[column] > 1
    owner, column = owner[met], column[met]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)))
    width = 8192
    for first in range(0, int(column.max(initial=-1)) + 1, width):
        a, b = np.searchsorted(column, [first, first + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        total += part @ part.T
    return total


def spanning_links(ids: list[int], sets: list[np.ndarray], least_percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the sets."""
    n = np.array([len(s) for s in sets])
    common = common_counts(sets)
    links = 100 * common >= least_percent * (n[:, None] + n[None, :] - common)
    seen, found = np.zeros(len(ids), bool), []
    for start in range(len(ids)):
        if seen[start]:
            continue
        seen[start] = True
        todo = [start]
        while todo:
            at = todo.pop()
            reached = np.flatnonzero(links[at] & ~seen)
            seen[reached] = True
            todo.extend(reached)
            found.extend((ids[at], ids[i]) for i in reached)
    return found


def block_links(members: DataFrame, sets: DataFrame, settings: NearDuplicates) -> DataFrame:
    """(u, v): spanning links of each block pair."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for group in batch["members"]:
                ids = group.values.field("x").to_pylist()
                hashes = group.values.field("hashes")
                sets = [hashes[i].values.to_numpy() for i in range(len(ids))]
                found += spanning_links(ids, sets, settings.least_percent)
            yield pa.RecordBatch.from_arrays(
                [pa.array([u for u, _ in found], pa.int64()), pa.array([v for _, v in found], pa.int64())], names=["u", "v"]
            )

    return (
        members.join(sets.withColumnRenamed("cls", "x"), "x")
        .groupBy("hub", "p", "q")
        .agg(F.collect_list(F.struct("x", "hashes")).alias("members"))  # two blocks at most
        .where(F.size("members") > 1)
        .select("members")
        .mapInArrow(compare, "u bigint, v bigint")
    )


def judged_rows(docs: DataFrame, settings: NearDuplicates) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, d1, d2 (digest of the set), component_id, kept."""
    rows = stored(sketches(docs, settings), "sketches")
    linkable = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    key = ["n_shingles", "d1", "d2"]
    classes = stored(
        linkable.groupBy(*key)
        .agg(F.min("doc_id").alias("doc_id"), F.first("sketch").alias("sketch"))
        .withColumnRenamed("n_shingles", "n")
        .withColumn("cls", F.monotonically_increasing_id()),
        "classes",
    )
    judged = stored(
        compare_with_hub(hub_groups(classes, settings), classes, settings), "hubs"
    )
    # Full sets: of candidates with their hubs, and of members that may meet others.
    candidates = judged.where("candidate")
    several = judged.groupBy("hub").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    needed = (
        candidates.select(F.col("hub").alias("cls"))
        .unionByName(candidates.select(F.col("x").alias("cls")))
        .unionByName(judged.join(several, "hub").select(F.col("x").alias("cls")))
        .distinct()
    )
    sets = stored(full_sets(docs, classes.join(needed, "cls").select("cls", "doc_id", "d1", "d2"), settings), "sets")
    stars = stored(star_links(judged, sets, settings), "stars")
    direct = stars.where("linked").select(F.col("hub").alias("u"), F.col("x").alias("v"))
    others = block_links(block_members(stars, settings), sets, settings)
    roots = components(direct.unionByName(others))

    # A component is named by its smallest doc_id.
    named = (
        classes.select(F.col("cls").alias("node"), "doc_id", "n", "d1", "d2")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    names = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_class = named.join(names, "root").select(F.col("n").alias("n_shingles"), "d1", "d2", "component_id")
    component = F.coalesce("component_id", F.col("doc_id"))
    return (
        rows.drop("sketch")
        .join(of_class, key, "left")
        .select(
            "doc_id",
            *key,
            F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def near_duplicates(docs: DataFrame, settings: NearDuplicates | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept."""
    return judged_rows(docs, settings or NearDuplicates()).drop("d1", "d2")


def with_digest(docs: DataFrame, settings: NearDuplicates, names: tuple[str, str]) -> DataFrame:
    """All columns of `docs` and the digest of each row's set."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t.as_py() for t in batch["text"])
            digests = [digest(shingle_set(None if t is None else t.encode(), settings.width)) for t in texts]
            halves = [pa.array([d[k] for d in digests], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *halves], names=[*batch.schema.names, *names])

    schema = T.StructType(docs.schema.fields + [T.StructField(n, T.LongType()) for n in names])
    return docs.mapInArrow(add, schema)


def keep_one_of_each(docs: DataFrame, settings: NearDuplicates | None = None) -> DataFrame:
    """One document of each component, as it is; rows without doc_id stay.

    Rows that repeat a doc_id are known by it and their set: one row of each such set
    that is kept stays, the smallest by text.
    """
    settings = settings or NearDuplicates()
    d1, d2, rank = (own_name(docs, f"__{n}") for n in ("d1", "d2", "rank"))
    kept = judged_rows(docs, settings).where("kept").select("doc_id", F.col("d1").alias(d1), F.col("d2").alias(d2)).distinct()
    order = Window.partitionBy("doc_id", d1, d2).orderBy("text")
    chosen = (
        with_digest(docs.where(F.col("doc_id").isNotNull()), settings, (d1, d2))
        .join(kept, ["doc_id", d1, d2], "left_semi")
        .withColumn(rank, F.row_number().over(order))
        .where(F.col(rank) == 1)
        .select(*docs.columns)
    )
    return chosen.unionByName(docs.where(F.col("doc_id").isNull()))
