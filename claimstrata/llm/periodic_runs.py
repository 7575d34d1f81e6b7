"""Periodic runs of words, found by catching squares online.

Words are appended one after another.  A square is a stretch of 2p words whose
halves are equal.  Every completed block of b = 4, 8, 16, ... words (at a multiple
of b) becomes a catcher for squares with a half of 2b to 4b - 1 words: the first
half of such a square holds a whole block, which comes again p words later.  When an
appended word is the last word of a live catcher's block, the last b words are
compared with the block.  If they are equal, the stretch of period p is extended to
the left; each further word extends it to the right or ends it.  Halves below eight
words are caught by comparing the last words directly.  A stretch of at least two
periods is a run; squares of a multiple of its period cover the same words and merge
into it.

Four blocks of each length are live, so a text of n words has O(log n) catchers and
the words themselves in memory.  A text is one row and never leaves its task: one
pass over the table, no shuffle.

Cases: NULL and empty texts, and texts of spaces, have no words and no runs;
repeated rows are rows of their own; doc_id may have any type and may be NULL;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunRule:
    """A run counts if it has so many words and periods."""

    least_words: int = 6
    least_periods: int = 4


# Halves below this are caught without blocks; blocks start at a quarter of it.
_SHORT = 8
_WORD_BYTES = array("i").itemsize


class SquareCatchers:
    """Runs of a sequence of word numbers (below 2^31) that grows at its end."""

    def __init__(self, longest_period: int) -> None:
        self.longest_period = longest_period
        self.words: list[int] = []
        self._data = bytearray()
        # Last word of a block -> its live catchers (start, length).
        self._waiting: dict[int, list[tuple[int, int]]] = {}
        # Period -> start of the stretch that reaches the last word.
        self._open: dict[int, int] = {}
        # (start, end) -> smallest period.
        self._runs: dict[tuple[int, int], int] = {}

    def extend(self, more: list[int]) -> None:
        """Append words; each is judged by what came before it."""
        words, waiting, reaching = self.words, self._waiting, self._open
        first = len(words)
        words.extend(more)
        self._data += array("i", more).tobytes()
        short = min(_SHORT - 1, self.longest_period)
        least_block = _SHORT // 2
        blocks = 2 * least_block <= self.longest_period
        for t in range(first, len(words)):
            word = words[t]
            if reaching:
                for p in [p for p in reaching if words[t - p] != word]:
                    self._close(p, t)
            if word in (last := words[t - short if t > short else 0 : t]):
                self._catch_short(t, word, last)
            if blocks:
                if word in waiting:
                    self._catch(t, waiting[word])
                if not (t + 1) % least_block:
                    self._complete_blocks(t)

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, smallest period) of all runs of two periods or more, by start and period."""
        found = dict(self._runs)
        for p, start in self._open.items():
            self._note(found, start, len(self.words), p)
        return sorted((start, end - start, p) for (start, end), p in found.items())

    def _catch_short(self, t: int, word: int, last: list[int]) -> None:
        words, reaching = self.words, self._open
        at = -1
        for _ in range(last.count(word)):
            at = last.index(word, at + 1)
            p = len(last) - at
            if p == 1:
                reaching.setdefault(p, t - 1)
            # A longer half needs two equal words in a row.
            elif t > p and words[t - 1] == words[t - 1 - p]:
                reaching.setdefault(p, t - 1 - p)

    def _catch(self, t: int, catchers: list[tuple[int, int]]) -> None:
        words, data = self.words, self._data
        for start, b in catchers:
            at = t + 1 - b
            p = at - start
            if words[start] != words[at] or p < 2 * b or p > self.longest_period or p in self._open:
                continue
            # Inside a stretch whose period fits the block, p is a multiple of that period.
            if any(s <= start and q <= b for q, s in self._open.items()):
                continue
            if data[_WORD_BYTES * start : _WORD_BYTES * (start + b)] == data[_WORD_BYTES * at :][: _WORD_BYTES * b]:
                self._open[p] = start - self._equal_before(start, at)

    def _complete_blocks(self, t: int) -> None:
        """Blocks that end with word t start to wait; those four blocks earlier are done."""
        words, waiting = self.words, self._waiting
        b = _SHORT // 2
        while not (t + 1) % b and 2 * b <= self.longest_period:
            start = t + 1 - b
            waiting.setdefault(words[t], []).append((start, b))
            done = start - 4 * b
            if done >= 0:
                last = words[done + b - 1]
                catchers = waiting[last]
                if len(catchers) == 1:
                    del waiting[last]
                else:
                    catchers.remove((done, b))
            b *= 2

    def _equal_before(self, i: int, j: int) -> int:
        """Number of equal words just before the places i < j."""
        data, equal, step = self._data, 0, 1

        def same(n: int) -> bool:
            return (
                data[_WORD_BYTES * (i - equal - n) : _WORD_BYTES * (i - equal)]
                == data[_WORD_BYTES * (j - equal - n) : _WORD_BYTES * (j - equal)]
            )

        while equal + step <= i and same(step):
            equal += step
            step *= 2
        while step:
            if equal + step <= i and same(step):
                equal += step
            step //= 2
        return equal

    def _close(self, p: int, end: int) -> None:
        self._note(self._runs, self._open.pop(p), end, p)

    @staticmethod
    def _note(found: dict[tuple[int, int], int], start: int, end: int, p: int) -> None:
        if end - start >= 2 * p and p < found.get((start, end), p + 1):
            found[start, end] = p


def word_runs(words: list[bytes], rule: RunRule) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs that count, by start and period."""
    if len(words) < rule.least_words:
        return []
    catchers = SquareCatchers(len(words) // rule.least_periods)
    numbers = {word: number for number, word in enumerate(dict.fromkeys(words))}
    catchers.extend(list(map(numbers.__getitem__, words)))
    return [
        (start, length, p)
        for start, length, p in catchers.runs()
        if length >= max(rule.least_words, rule.least_periods * p)
    ]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces; of each run only the first period stays."""
    kept, at = [], 0
    for first, end in sorted((start + p, start + length) for start, length, p in runs):
        kept += words[at:first]
        at = max(at, end)
    return b" ".join(kept + words[at:])


RUN = "struct<start:bigint,length:bigint,period:bigint>"


def find_runs(docs: DataFrame, rule: RunRule | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, runs (by start, then period), collapsed (text)."""
    rule = rule or RunRule()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found, texts = [], [], []
            for text in batch["__text"]:
                words = (text.as_py() or b"").split()  # the six ASCII spaces
                runs = word_runs(words, rule)
                sizes.append(len(words))
                found.append([dict(zip(("start", "length", "period"), run)) for run in runs])
                texts.append(collapse(words, runs).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(sizes, pa.int64()),
                    pa.array(found, pa.list_(run_type)),
                    pa.array(texts, pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("__text")).mapInArrow(
        scan, f"doc_id {id_type}, n_words bigint, runs array<{RUN}>, collapsed string"
    )
