"""License scan by template markup.

A template is license wording with markup: `<<optional>> ... <<end>>` may be left
out, `<<any;max=N>>` stands for up to N words.  It is compiled into an automaton
over words; a text is accepted where a path through the automaton ends, which
holds only if all mandatory words stand there exactly and in order.  The
automaton runs once over the words of each text, whatever the text's length.
A text that lacks the longest mandatory run of a template is not walked for it.

Words are runs of ASCII letters and digits and of all characters beyond ASCII,
A-Z lower-cased.  Cases: NULL and empty texts have no words, no labels and score
0; overlapping places of a phrase all count; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases and labels of the base scan.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Public license notices; wording between the marks is fixed by the licenses.
TEMPLATES = (
    (
        "mit",
        "<<optional>> this <<any;max=3>> is <<end>> <<optional>> released <<end>> <<optional>> licensed <<end>> "
        "under the <<optional>> terms of the <<end>> mit license",
    ),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files <<optional>> the software <<end>> to deal in the software without "
        "restriction including without limitation the rights to use copy modify merge publish distribute "
        "sublicense and or sell copies of the software",
    ),
    (
        "apache-2",
        "licensed under the apache license <<optional>> version <<end>> 2 <<optional>> 0 <<end>> "
        "<<optional>> the license you may not use this file except in compliance with the license <<end>>",
    ),
    (
        "gpl-3",
        "<<optional>> this <<any;max=4>> is <<end>> <<optional>> licensed <<end>> under the <<optional>> terms of "
        "the <<end>> gnu general public license <<optional>> as published by the free software foundation "
        "either <<end>> version 3 <<optional>> of the license or at your option any later version <<end>>",
    ),
    (
        "gpl-2",
        "under the <<optional>> terms of the <<end>> gnu general public license <<optional>> as published by the "
        "free software foundation either <<end>> version 2 <<optional>> of the license or at your option any "
        "later version <<end>>",
    ),
    (
        "lgpl",
        "under the <<optional>> terms of the <<end>> gnu lesser general public license "
        "<<optional>> version <<any;max=2>> <<end>>",
    ),
    (
        "cc-by-nc",
        "licensed under <<optional>> a <<end>> <<optional>> the <<end>> cc by nc <<optional>> 4 0 <<end>> "
        "<<optional>> 3 0 <<end>>",
    ),
    (
        "cc-by-nc",
        "creative commons attribution noncommercial <<optional>> 4 0 <<end>> <<optional>> international <<end>> "
        "<<optional>> public <<end>> license",
    ),
    (
        "cc-by-sa",
        "licensed under <<optional>> a <<end>> <<optional>> the <<end>> cc by sa <<optional>> 4 0 <<end>> "
        "<<optional>> 3 0 <<end>>",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted",
    ),
    (
        "all-rights-reserved",
        "<<optional>> copyright <<optional>> c <<end>> <<any;max=8>> <<end>> all rights reserved",
    ),
)

_WORDS = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


@dataclass
class Automaton:
    """States with word steps, any-word steps and free steps; `anchor` must occur."""

    label: str
    steps: list[dict[bytes, int]]
    any_step: list[int | None]
    free: list[list[int]]
    accept: int
    anchor: bytes

    def closed(self, states: dict[int, int]) -> dict[int, int]:
        """`states` (state -> smallest start) and all that free steps reach."""
        todo = list(states.items())
        while todo:
            state, start = todo.pop()
            for to in self.free[state]:
                if to not in states or states[to] > start:
                    states[to] = start
                    todo.append((to, start))
        return states

    def spans(self, words: list[bytes]) -> list[tuple[int, int]]:
        """Accepted [start, end) word ranges: the longest for each start."""
        found: dict[int, int] = {}
        active: dict[int, int] = {}
        first = self.closed({0: 0})
        for i, word in enumerate(words):
            after: dict[int, int] = {}
            for state in first:
                active.setdefault(state, i)
            for state, start in active.items():
                for to in (self.steps[state].get(word), self.any_step[state]):
                    if to is not None and (to not in after or after[to] > start):
                        after[to] = start
            active = self.closed(after)
            if self.accept in active:
                found[active[self.accept]] = i + 1
        return sorted(found.items())


def compile_template(label: str, template: str) -> Automaton:
    """The automaton of one template."""
    steps: list[dict[bytes, int]] = [{}]
    any_step: list[int | None] = [None]
    free: list[list[int]] = [[]]

    def new() -> int:
        steps.append({})
        any_step.append(None)
        free.append([])
        return len(steps) - 1

    at, opened, run, anchor = 0, [], [], []
    for token in re.findall(r"<<[^>]*>>|\S+", template):
        if token == "<<optional>>":
            opened.append(at)
            run = []
        elif token == "<<end>>":
            free[opened.pop()].append(at)
            run = []
        elif token.startswith("<<any;max="):
            run, passed = [], []
            for _ in range(int(token[10:-2])):
                passed.append(at)
                any_step[at] = new()
                at = any_step[at]
            for state in passed:
                free[state].append(at)
        else:
            # A state of its own: free steps may leave the one before.
            steps[at][token.encode()] = to = new()
            at = to
            if not opened:
                run = [*run, token]
                anchor = max(anchor, run, key=len)
    return Automaton(label, steps, any_step, free, at, f" {' '.join(anchor)} ".encode())


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORDS).split()


def _places(joined: bytes, phrase: bytes) -> Iterator[int]:
    at = joined.find(phrase)
    while at >= 0:
        yield joined.count(b" ", 0, at)
        at = joined.find(phrase, at + 1)


def scan_text(
    text: bytes | None,
    phrases: tuple[tuple[str, str], ...],
    automata: list[Automaton],
) -> tuple[int, list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Number of words, base places and template places as (start, end, label)."""
    words = words_of(text)
    joined = b" " + b" ".join(words) + b" "
    base = [
        (start, start + phrase.count(" ") + 1, label)
        for phrase, label in phrases
        for start in _places(joined, f" {phrase} ".encode())
    ]
    found = [
        (start, end, automaton.label)
        for automaton in automata
        if automaton.anchor in joined
        for start, end in automaton.spans(words)
    ]
    return len(words), base, found


def _covered(spans: list[tuple[int, int, str]]) -> int:
    total, upto = 0, 0
    for start, end, _ in sorted(spans):
        total += max(0, end - max(start, upto))
        upto = max(upto, end)
    return total


def scan_licenses(
    docs: DataFrame,
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
) -> DataFrame:
    """One row per document; score is the share of its words in license wording."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [compile_template(label, template) for label, template in templates]
        for batch in batches:
            rows = []
            for text in batch["__text"]:
                n_words, base, found = scan_text(text.as_py(), phrases, automata)
                starts = [s for s, _, _ in base]
                base_labels = {label for _, _, label in base}
                rows.append(
                    {
                        "n_words": n_words,
                        "n_base": len(base),
                        "first_word": min(starts, default=None),
                        "last_word": max(starts, default=None),
                        "base_labels": ",".join(sorted(base_labels)),
                        "labels": ",".join(sorted(base_labels | {label for _, _, label in found})),
                        "score": _covered(base + found) / n_words if n_words else 0.0,
                    }
                )
            columns = [pa.array([r[n] for r in rows], kind) for n, kind in _COLUMNS]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=["doc_id", *(n for n, _ in _COLUMNS)])

    texts = docs.select("doc_id", F.col("text").cast("binary").alias("__text"))
    return texts.mapInArrow(
        scan,
        f"doc_id {id_type}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double",
    )


_COLUMNS = (
    ("n_words", pa.int64()),
    ("n_base", pa.int64()),
    ("first_word", pa.int64()),
    ("last_word", pa.int64()),
    ("base_labels", pa.string()),
    ("labels", pa.string()),
    ("score", pa.float64()),
)
