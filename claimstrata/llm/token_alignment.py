"""Alignment of the tokens of two tokenizers, and how often their ids are linked.

A is a byte-level BPE (read as ranks), B a sentencepiece model.  Both spell the same
bytes, a space and the text.  The places where a token of A and one of B both end cut
the tokens into groups; the last tokens of a group end together and are linked.

Identity map: an array holds for each A id the B id with the same bytes.  Groups of
one such A and its B token are counted in one vector over A's vocabulary in each task.
Only the links of other groups are counted as pairs, summed up in the task before
they are shuffled.

Both tokenizers see a text in units, cut at every single space between two
characters that are no white space: no token of A holds such a space but at its
start, and no piece of B has one but at its start (checked when it is loaded).
Units that come again take their tokens from a bounded table in the worker.

Each text is encoded once; its distinct links are stored with it and counted from
there.  Corpus-wide counts come back to the texts in two ways: those of identity
groups and of at most `HOT` other pairs (with a share of 1/HOT of all links) are
broadcast, some 4 MB at any size of the corpus; a rarer pair, which at most a share of
1/HOT of the rows can hold, is joined.

Cases: texts that are NULL, empty, or not spelled alike by both have no tokens and
zeros; repeated rows are rows of their own; doc_id may have any type and may be NULL;
other columns are not read.  A text's rendered groups must fit a string (2 GB).
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimstrata.llm.shared import stored

# Pairs with at least 1/HOT of all links are broadcast.
HOT = 1 << 17
# Units in a worker's table and their characters; characters of texts cut at once.
TABLE_UNITS = 1 << 18
TABLE_CHARS = 1 << 24
PORTION_CHARS = 1 << 20
# Distinct pairs that a task sums up before it hands them on.
TASK_PAIRS = 1 << 20
# A pair of ids is one number: A id, then B id.
PAIR_SHIFT = 20
PAIR_MASK = (1 << PAIR_SHIFT) - 1

# The published pattern of the byte-level vocabulary, a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Vocabularies:
    """Files of the two tokenizers; every executor has them at this place."""

    folder: str = "/opt/tokenizers"
    a: str = "byte_bpe_50k.tiktoken"
    b: str = "piece_bpe_32k.model"


class Tokenizers:
    """Both tokenizers, the bytes of their tokens and the identity map."""

    def __init__(self, files: Vocabularies) -> None:
        import sentencepiece
        import tiktoken

        lines = Path(files.folder, files.a).read_bytes().splitlines()
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=str(Path(files.folder, files.b)))
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.a_bytes[rank] = token
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        if any(b" " in token.lstrip(b" ") for token in self.b_bytes):
            raise ValueError("a piece holds a space after its start, so texts cannot be cut into units")
        self.a_sizes, self.b_sizes = (np.array([len(token) for token in of]) for of in (self.a_bytes, self.b_bytes))
        self.names = np.array([str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))], object)
        # Lowest B id of the same bytes, -1 without one.
        by_bytes = {token: i for i, token in reversed(list(enumerate(self.b_bytes)))}
        self.same = np.array([by_bytes.get(token, -1) if token else -1 for token in self.a_bytes], np.int64)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Tokens of A (of a space and the text) and of B; None if not both spell that."""
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text)
        spelled = b" " + text.encode()
        if any(b"".join(map(by.__getitem__, ids)) != spelled for by, ids in ((self.a_bytes, a), (self.b_bytes, b))):
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


@cache
def tokenizers(files: Vocabularies) -> Tokenizers:
    return Tokenizers(files)


# White space that can stand before a space.
_BEFORE = [c + " " for c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"]
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_NOT_BEFORE_TEXT = re.compile(r" (?!\S)")


def units_of(text: str) -> list[str]:
    """The text cut at single spaces between characters that are no white space."""
    plain = text.isascii() and text[0] != " " and not any(c in text for c in _BEFORE) and not _NOT_BEFORE_TEXT.search(text)
    return text.split(" ") if plain else _SINGLE_SPACE.split(text)


def _can_be_joined(unit: str) -> bool:
    """Joined with others by single spaces, the unit keeps its tokens and is spelled."""
    return not (unit[0].isspace() or unit[-1].isspace() or "▁" in unit)


def _all_can_be_joined(units: list[str]) -> bool:
    text = " ".join(units)
    return "▁" not in text and len(units_of(text)) == 1 + text.count(" ")


@dataclass(frozen=True)
class Alignment:
    """Tokens of each of several units, unit and pair of last tokens of each group, groups as text."""

    n_a: np.ndarray
    n_b: np.ndarray
    unit: np.ndarray
    pair: np.ndarray
    groups: list[str]


def align_units(t: Tokenizers, units: list[str]) -> Alignment | None:
    """None if the tokenizers do not spell the units, joined by spaces, alike."""
    spelled = t.encode(" ".join(units))
    if spelled is None:
        return None
    a, b = spelled
    ends_a, ends_b = t.a_sizes[a].cumsum(), t.b_sizes[b].cumsum()
    ending = np.zeros((2, ends_a[-1] + 1), bool)
    ending[0, ends_a] = ending[1, ends_b] = True
    last_a, last_b = np.flatnonzero(ending[1, ends_a]), np.flatnonzero(ending[0, ends_b])
    size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    unit_ends = np.cumsum([len(u.encode()) + 1 for u in units])
    of = lambda ends: np.searchsorted(unit_ends, ends)
    unit = of(ends_a[last_a])
    # All tokens group by group, each with the sign after it.
    of_a, of_b = (np.repeat(np.arange(len(size)), size) for size in (size_a, size_b))
    order = np.argsort(np.concatenate([2 * of_a, 2 * of_b + 1]), kind="stable")
    sign_a = np.where(ending[1, ends_a], "|", ",").astype(object)
    sign_b = np.where(ending[0, ends_b], ";", ",").astype(object)
    sign_b[last_b[np.flatnonzero(np.diff(unit, append=-1))]] = ""
    text = np.concatenate([t.names[a] + sign_a, t.names[b] + sign_b])[order].tolist()
    stops = np.cumsum(np.bincount(unit, size_a + size_b, len(units)).astype(np.int64)).tolist()
    groups = ["".join(text[x:y]) for x, y in zip([0, *stops], stops)]
    count = lambda ends: np.bincount(of(ends), minlength=len(units))
    return Alignment(count(ends_a), count(ends_b), unit, a[last_a] << PAIR_SHIFT | b[last_b], groups)


class _Numbers(dict):
    """Numbers of units in the order they are first asked for."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        self.new.append(unit)
        return number


class UnitTable:
    """What the tokenizers say of units seen before; starts anew when it is full."""

    def __init__(self, files: Vocabularies) -> None:
        self.tokenizers = tokenizers(files)
        self.clear()

    def clear(self) -> None:
        self.n_chars = 0
        self.numbers = _Numbers()
        self.groups: list[str] = []
        # n_a, n_b, n_groups, 1 if not spelled alike, and where the unit's links start.
        self.figures = np.zeros((1 << 10, 5), np.int64)
        self.links = np.zeros(1 << 12, np.int64)
        self.n_links = 0

    def full(self) -> bool:
        return len(self.numbers) > TABLE_UNITS or self.n_chars > TABLE_CHARS

    def number(self, texts: list[list[str]]) -> list[list[int]]:
        """Numbers of the units of each text."""
        found = [list(map(self.numbers.__getitem__, units)) for units in texts]
        new, self.numbers.new = self.numbers.new, []
        if new:
            while len(self.figures) < len(self.numbers):
                self.figures = np.concatenate([self.figures, np.zeros_like(self.figures)])
            self.groups += [""] * len(new)
            self.n_chars += sum(map(len, new))
            joined, single = new, []
            if not _all_can_be_joined(new):
                joined = [u for u in new if _can_be_joined(u)]
                single = [u for u in new if not _can_be_joined(u)]
            aligned = align_units(self.tokenizers, joined) if joined else None
            if aligned is None:
                single = new
            else:
                self._add(joined, aligned)
            for unit in single:
                self._add([unit], align_units(self.tokenizers, [unit]))
        return found

    def _add(self, units: list[str], aligned: Alignment | None) -> None:
        at = np.array([self.numbers[u] for u in units], np.int64)
        if aligned is None:
            self.figures[at, 3] = 1
            return
        for number, groups in zip(at.tolist(), aligned.groups):
            self.groups[number] = groups
        n_groups = np.bincount(aligned.unit, minlength=len(units))
        starts = self.n_links + np.cumsum(n_groups) - n_groups
        self.figures[at] = np.stack([aligned.n_a, aligned.n_b, n_groups, np.zeros_like(n_groups), starts], axis=1)
        while len(self.links) < self.n_links + len(aligned.pair):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        self.links[self.n_links : self.n_links + len(aligned.pair)] = aligned.pair
        self.n_links += len(aligned.pair)

    def links_of(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct links of the units, each taken as often as it comes, and how often."""
        sizes, starts = self.figures[units, 2], self.figures[units, 4]
        before = np.cumsum(sizes) - sizes
        places = np.arange(sizes.sum()) + np.repeat(starts - before, sizes)
        return np.unique(self.links[places], return_counts=True)


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[list[str]]]]:
    """(first row, end row, units of each text): some of the rows at a time."""
    texts = batch["text"]
    first, units, n_chars = 0, [], 0
    for row in range(len(texts)):
        text = texts[row].as_py()
        units.append(units_of(text) if text else [])
        n_chars += len(text or "")
        if n_chars > PORTION_CHARS:
            yield first, row + 1, units
            first, units, n_chars = row + 1, [], 0
    if units:
        yield first, len(texts), units


ALIGNED = "n_a bigint, n_b bigint, n_groups bigint, groups string, links array<bigint>, times array<bigint>"


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def align(docs: DataFrame, files: Vocabularies | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, n_a, n_b, n_groups, groups (`a1,a2|b1;a3|b2,b3`),
    links (distinct pairs of ids as numbers) and how many times each comes."""
    files = files or Vocabularies()

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = UnitTable(files)
        for batch in batches:
            for first, end, texts in _portions(batch):
                if table.full():
                    table.clear()
                sums, groups, links = [], [], []
                for numbers in table.number(texts):
                    units = np.array(numbers, np.int64)
                    figures = table.figures[units].sum(axis=0)[:4]
                    if figures[3]:
                        figures, numbers, units = np.zeros(4, np.int64), [], units[:0]
                    sums.append(figures)
                    groups.append(";".join(map(table.groups.__getitem__, numbers)))
                    links.append(table.links_of(units))
                figures = np.array(sums)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, end - first),
                        *(pa.array(figures[:, k]) for k in range(3)),
                        pa.array(groups, pa.string()),
                        _lists([pairs for pairs, _ in links]),
                        _lists([times for _, times in links]),
                    ],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups", "links", "times"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(tokens, f"doc_id {id_type}, {ALIGNED}")


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch[name].flatten().to_numpy(zero_copy_only=False)


def count_links(aligned: DataFrame, files: Vocabularies) -> DataFrame:
    """pair, same (of an identity group), n: how many links of the corpus hold each pair of ids."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identity = tokenizers(files).same
        same = np.zeros(len(identity), np.int64)
        other: dict[int, int] = {}

        def rows(pairs: np.ndarray, identical: bool, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs, pa.int64()), pa.array(np.full(len(pairs), identical)), pa.array(n, pa.int64())],
                names=["pair", "same", "n"],
            )

        def others() -> pa.RecordBatch:
            return rows(np.array(list(other), np.int64), False, np.array(list(other.values()), np.int64))

        for batch in batches:
            pair, times = _flat(batch, "links"), _flat(batch, "times")
            # Tokens of the same bytes that end together also start together.
            identical = identity[pair >> PAIR_SHIFT] == pair & PAIR_MASK
            np.add.at(same, pair[identical] >> PAIR_SHIFT, times[identical])
            pairs, place = np.unique(pair[~identical], return_inverse=True)
            n = np.zeros(len(pairs), np.int64)
            np.add.at(n, place, times[~identical])
            for p, k in zip(pairs.tolist(), n.tolist()):
                other[p] = other.get(p, 0) + k
            if len(other) > TASK_PAIRS:
                yield others()
                other.clear()
        ids = np.flatnonzero(same)
        yield rows(ids << PAIR_SHIFT | identity[ids], True, same[ids])
        yield others()

    counted = aligned.select("links", "times").mapInArrow(count, "pair bigint, same boolean, n bigint")
    return counted.groupBy("pair", "same").agg(F.sum("n").alias("n"))


def judge_links(counts: DataFrame) -> DataFrame:
    """`counts` and best: the count is the highest of all pairs with that B id."""
    b = F.col("pair").bitwiseAND(F.lit(PAIR_MASK).cast("bigint"))
    highest = counts.groupBy(b.alias("b")).agg(F.max("n").alias("highest"))
    # One row for each id of B's vocabulary at most.
    return counts.withColumn("b", b).join(F.broadcast(highest), "b").select("pair", "same", "n", (F.col("n") == F.col("highest")).alias("best"))


@dataclass(frozen=True)
class Known:
    """Sorted pairs with a last one above all, their counts, and 1 where that is the B id's highest."""

    pairs: np.ndarray
    counts: np.ndarray
    best: np.ndarray


def link_totals(aligned: DataFrame, files: Vocabularies | None = None) -> DataFrame:
    """`aligned` with n_links, n_best and count_sum instead of its links.

    n_best: links whose count is their B id's highest; count_sum: the counts of all links.
    Stores its input, so leave out the rendered groups if only a digest is wanted.
    """
    row = "__row"
    rows = stored(aligned.withColumn(row, F.monotonically_increasing_id()), "aligned")
    counts = stored(count_links(rows, files or Vocabularies()), "links")
    total = counts.agg(F.sum("n")).first()[0] or 0
    judged = stored(judge_links(counts), "judged-links")
    is_known = F.col("same") | (F.col("n") * HOT >= total)
    # A's vocabulary and HOT rows at most.
    table = judged.where(is_known).orderBy("pair").toArrow()
    known = Known(
        np.append(table["pair"].to_numpy(), np.iinfo(np.int64).max),
        np.append(table["n"].to_numpy(), 0),
        np.append(table["best"].to_numpy().astype(np.int64), 0),
    )
    shared = aligned.sparkSession.sparkContext.broadcast(known)

    def add_known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            pair, times = _flat(batch, "links"), _flat(batch, "times")
            owner = np.repeat(np.arange(len(batch)), batch["links"].value_lengths().to_numpy())
            at = np.searchsorted(known.pairs, pair)
            met = known.pairs[at] == pair
            sums = np.zeros((2, len(batch)), np.int64)
            np.add.at(sums[0], owner[met], times[met] * known.best[at[met]])
            np.add.at(sums[1], owner[met], times[met] * known.counts[at[met]])
            left = np.bincount(owner[~met], minlength=len(batch))
            offsets = pa.array(np.concatenate([[0], np.cumsum(left)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch[row],
                    pa.array(sums[0]),
                    pa.array(sums[1]),
                    pa.ListArray.from_arrays(offsets, pa.array(pair[~met], pa.int64())),
                    pa.ListArray.from_arrays(offsets, pa.array(times[~met], pa.int64())),
                ],
                names=[row, "known_best", "known_sum", "links", "times"],
            )

    met = stored(
        rows.select(row, "links", "times").mapInArrow(
            add_known, f"{row} bigint, known_best bigint, known_sum bigint, links array<bigint>, times array<bigint>"
        ),
        "known-links",
    )
    rare = (
        met.select(row, F.explode(F.arrays_zip("links", "times")).alias("r"))
        .select(row, F.col("r.links").alias("pair"), F.col("r.times").alias("times"))
        .join(judged.where(~is_known), "pair")
        .select(row, F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    )
    sums = (
        met.select(row, F.col("known_best").alias("n_best"), F.col("known_sum").alias("count_sum"))
        .unionByName(rare)
        .groupBy(row)
        .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )
    return rows.drop("links", "times").join(sums, row).withColumn("n_links", F.col("n_groups")).drop(row)
