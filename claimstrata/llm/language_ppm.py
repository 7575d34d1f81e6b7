"""Language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts of 0 to `ORDER` bytes with the counts of
the bytes that followed.  A byte's probability is taken in its longest known
context; escape probabilities (method C, with exclusion of bytes ruled out by
longer contexts) lead to shorter ones and at last to the uniform distribution
over the bytes never seen.  Counts are frozen after training, so the code length
of a byte depends on it and the `ORDER` bytes before it only, and is tabulated
once: scoring a text is table look-ups over all of its bytes, language by
language.  The language with the shortest code wins; `score` is its posterior
probability under equal priors.

Training takes a bounded sample of labelled rows: per language the `docs` rows
with the smallest hash of doc_id, of each at most its share of `bytes`, cut before
it reaches the driver, so that one long text leaves room for all others.  Rows with
crc32(doc_id) mod 3 = 1 are held out; label, source and id play no part in a
prediction.  Tables have at most (bytes seen + 1)^3 entries plus one row for each
distinct context of the sample, so their size does not grow with the corpus.

The winner need not be the text's language: a text in a language never learned, or of
letters at random, has a winner too.  `excess` says how many bits a byte the winner's
code is longer than for its own sample; the stage of the pipeline rejects by it.

Cases: a NULL text, a text without a letter, or a training set without rows gives
`und` and score 0; languages with equal code lengths are taken in alphabetical
order; a NULL doc_id is never held out nor trained on; rows that repeat a doc_id
count once in training (smallest text) and are predicted each by its own text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimstrata.llm.shared import own_name

ORDER = 3
UNDETERMINED = "und"
SEGMENT = 1 << 20
# Bits a byte.  At sf0.1 clean texts of 100 bytes or more stay below 1.8 and texts
# in unlearned languages or of random letters lie between 4.8 and 18.
MARGIN = 4.0
SLACK = 64.0


@dataclass(frozen=True)
class Sample:
    """Bound of the training sample per language: so many texts, so many bytes in all."""

    docs: int = 400
    bytes: int = 1 << 20

    @property
    def share(self) -> int:
        """Bytes taken of one text."""
        return max(1, self.bytes // self.docs)


@dataclass(frozen=True)
class PpmTables:
    """Code lengths in bits of every language.

    `symbol` maps a byte to its class (bytes of the samples, then one class for
    all others); `state[l]` maps the three classes before a byte to the row of
    the longest known context; `bits[l][row * classes + class]` is the length.
    `usual[l]` is the mean length in the language's own sample.
    """

    languages: tuple[str, ...]
    symbol: np.ndarray
    classes: int
    state: tuple[np.ndarray, ...]
    bits: tuple[np.ndarray, ...]
    usual: np.ndarray


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _place(doc_id: str) -> Column:
    """A fixed random place of an id, from 0 to 2^32 - 1."""
    return F.shiftrightunsigned(F.xxhash64(doc_id), 32)


def training_texts(docs: DataFrame, sample: Sample) -> dict[str, list[bytes]]:
    """The bounded sample: texts per language, in a fixed order."""
    labelled = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull()
        & F.col("text").isNotNull()
        & F.col("doc_id").isNotNull()
        & ~held_out(F.col("doc_id"))
    )
    # Ids first: texts of rows that are not chosen never move.  Rows far beyond the
    # wanted rank are dropped by their hash before a language's rows meet.
    order = Window.partitionBy("lang").orderBy(_place("doc_id"), "doc_id")
    n = dict(labelled.groupBy("lang").count().collect())
    below = F.lit(0)
    for lang, rows in n.items():
        below = F.when(F.col("lang") == lang, min(1 << 32, (sample.docs << 34) // rows)).otherwise(below)
    ids = (
        labelled.where(_place("doc_id") < below)
        .groupBy("lang", "doc_id")
        .agg(F.lit(1))
        .withColumn("__rank", F.row_number().over(order))
        .where(F.col("__rank") <= sample.docs)
    )
    # At most `docs` ids a language meet the texts, and at most `share` bytes of each leave.
    rows = (
        labelled.join(F.broadcast(ids), ["lang", "doc_id"])
        .groupBy("lang", "__rank")
        .agg(F.substring(F.min("text").cast("binary"), 1, sample.share).alias("text"))
        .collect()
    )
    texts: dict[str, list[bytes]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["__rank"])):
        if row["text"]:
            texts.setdefault(row["lang"], []).append(bytes(row["text"]))
    return texts


def _counts(texts: list[bytes], symbol: np.ndarray, classes: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per order 0..ORDER: sorted context keys and their counts [context, class]."""
    grams = []
    for text in texts:
        s = symbol[np.frombuffer(b"\n" * ORDER + text, np.uint8)].astype(np.int64)
        key = s[ORDER:]
        for back in range(1, ORDER + 1):
            key = key + s[ORDER - back : -back] * classes**back
        grams.append(key)
    gram = np.concatenate(grams)
    tables = []
    for order in range(ORDER + 1):
        seen, n = np.unique(gram % classes ** (order + 1), return_counts=True)
        contexts, row = np.unique(seen // classes, return_inverse=True)
        table = np.zeros((len(contexts), classes), np.float32)
        table[row, seen % classes] = n
        tables.append((contexts, table))
    return tables


def _code_lengths(tables: list[tuple[np.ndarray, np.ndarray]], order: int, classes: int, unseen: int) -> np.ndarray:
    """Bits of each class in each context of `order`; the last class is unseen."""
    contexts, counts = tables[order]
    probability = np.zeros(counts.shape)
    mass = np.ones(len(contexts))
    excluded = np.zeros(counts.shape, bool)
    for shorter in range(order, -1, -1):
        keys, below = tables[shorter]
        n = np.where(excluded, 0, below[np.searchsorted(keys, contexts % classes**shorter)])
        distinct = (n > 0).sum(axis=1)
        total = n.sum(axis=1) + distinct
        known = total > 0
        share = np.where(known, mass / np.maximum(total, 1), 0)
        probability += n * share[:, None]
        mass = np.where(known, distinct * share, mass)
        excluded |= n > 0
    # What is left belongs to the bytes of no context: classes not seen by this
    # language stand for one byte each, the last class for `unseen` bytes.
    left = (~excluded[:, :-1]).sum(axis=1) + unseen
    probability = np.where(excluded, probability, (mass / np.maximum(left, 1))[:, None])
    return (-np.log2(np.maximum(probability, 2.0**-60))).astype(np.float32)


def build_tables(texts: dict[str, list[bytes]]) -> PpmTables | None:
    """Frozen tables from the sample; None without any text."""
    texts = {lang: t for lang, t in texts.items() if any(t)}
    if not texts:
        return None
    seen = np.zeros(256, bool)
    seen[ord("\n")] = True
    for group in texts.values():
        for text in group:
            seen[np.frombuffer(text, np.uint8)] = True
    classes = int(seen.sum()) + 1
    symbol = np.full(256, classes - 1, np.int32)
    symbol[seen] = np.arange(classes - 1)
    state, bits = [], []
    languages = tuple(sorted(texts))
    for lang in languages:
        tables = _counts(texts[lang], symbol, classes)
        rows = np.zeros(classes**ORDER, np.int32)
        lengths, first = [], 0
        for order, (contexts, _) in enumerate(tables):
            # Longer contexts overwrite the range of rows their suffix had.
            ids = np.arange(first, first + len(contexts), dtype=np.int32)
            rows.reshape(-1, classes**order)[:, contexts] = ids
            lengths.append(_code_lengths(tables, order, classes, 256 - classes + 1))
            first += len(contexts)
        state.append(rows)
        bits.append(np.concatenate(lengths).ravel())
    usual = np.zeros(len(languages))
    for i, lang in enumerate(languages):
        own = PpmTables((lang,), symbol, classes, (state[i],), (bits[i],), usual[i : i + 1])
        usual[i] = sum(code_lengths(t, own)[0] for t in texts[lang]) / sum(map(len, texts[lang]))
    return PpmTables(languages, symbol, classes, tuple(state), tuple(bits), usual)


def code_lengths(text: bytes, tables: PpmTables) -> np.ndarray:
    """Bits of the whole text under each language, long texts piece by piece."""
    total = np.zeros(len(tables.languages))
    before = b"\n" * ORDER
    for start in range(0, len(text), SEGMENT):
        piece = before + text[start : start + SEGMENT]
        before = piece[-ORDER:]
        s = tables.symbol[np.frombuffer(piece, np.uint8)]
        context = (s[:-3] * tables.classes + s[1:-2]) * tables.classes + s[2:-1]
        last = s[3:]
        for i, (state, bits) in enumerate(zip(tables.state, tables.bits)):
            total[i] += bits[state[context] * tables.classes + last].sum(dtype=np.float64)
    return total


def predict(text: bytes, tables: PpmTables | None) -> tuple[str, float, float]:
    """Language, posterior, and bits a byte above the usual length of that language."""
    if tables is None:
        return UNDETERMINED, 0.0, 0.0
    bits = code_lengths(text, tables)
    best = int(bits.argmin())
    posterior = float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())
    return tables.languages[best], posterior, float(bits[best] / len(text) - tables.usual[best])


def identify_languages(
    docs: DataFrame,
    model_docs: DataFrame | None = None,
    sample: Sample | None = None,
    names: tuple[str, ...] = ("lang_pred", "score"),
) -> DataFrame:
    """All columns of `docs` with the predicted language and its score added.

    `model_docs` (default: `docs`) has the labelled rows the model is trained on.
    Columns of `docs` that are called as in `names` are replaced; a third name asks
    for `excess` as well.
    """
    tables = build_tables(training_texts(docs if model_docs is None else model_docs, sample or Sample()))
    # Plain arrays: workers need no copy of this module to read them.
    shared = docs.sparkSession.sparkContext.broadcast(tables and astuple(tables))
    rest = [c for c in docs.columns if c not in names]
    read = own_name(docs, "text_bytes")
    lettered = F.when(F.col("text").rlike(r"\p{L}"), F.col("text").cast("binary")).alias(read)
    types = ("string", "double", "double")[: len(names)]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value and PpmTables(*shared.value)
        kinds = (pa.string(), pa.float64(), pa.float64())
        for batch in batches:
            said = [
                predict(text.as_buffer().to_pybytes(), tables) if text.is_valid else (UNDETERMINED, 0.0, 0.0)
                for text in batch[read]
            ]
            found = [pa.array([s[i] for s in said], kinds[i]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in rest), *found], names=[*rest, *names])

    schema = docs.select(*rest).schema
    for name, kind in zip(names, types):
        schema = schema.add(name, kind)
    return docs.select(*rest, lettered).mapInArrow(judge, schema)


def keep_identified(
    docs: DataFrame,
    model_docs: DataFrame | None = None,
    least: float = 0.5,
    margin: float = MARGIN,
    slack: float = SLACK,
) -> DataFrame:
    """Documents in a learned language, as they are.

    Their language has a posterior of `least` or more, and codes the text in at most
    `margin` bits a byte more than its own sample, `slack` bits a text aside: short
    texts vary more.
    """
    lang, score, excess = names = tuple(own_name(docs, c) for c in ("lang_pred", "score", "excess"))
    said = identify_languages(docs, model_docs, names=names)
    usual = F.col(excess) <= margin + slack / F.octet_length(F.col("text"))
    return said.where((F.col(lang) != UNDETERMINED) & (F.col(score) >= least) & usual).select(*docs.columns)
