"""Periodic runs, token alignment and the quality classifier against plain versions."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from samples import documents, odd_rows, rows_of, sentence

from claimstrata.llm import fourier_quality, token_alignment
from claimstrata.llm.fourier_quality import KernelRidge, pooled, score_quality, solve, usable_labels
from claimstrata.llm.periodic_runs import RunRule, SquareCatchers, collapse, find_runs, word_runs
from claimstrata.llm.queries import op11_periodic_runs, op12_identity_map, op13_fourier_quality
from claimstrata.llm.token_alignment import Vocabularies, align, link_totals, units_of
from conftest import SF_DIR


@pytest.fixture
def given(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture
def folder(spark, tmp_path):
    """The odd rows and the given documents as a folder of tables, with labels."""
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = documents(spark, [*odd_rows(), (20, "a▁b c"), (30, "x y " * 40), (31, "a  b\n\n c "), (-40, "o " * 9)])
    odd.unionByName(given, allowMissingColumns=True).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def by_row(df):
    return Counter(map(tuple, df.collect()))


# --- periodic runs ------------------------------------------------------------


def plain_runs(words, least_words=0, least_periods=2):
    """Every stretch of each period, the smallest period of a stretch first."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        start = 0
        for t in range(p, n + 1):
            if t == n or words[t] != words[t - p]:
                if t - start >= 2 * p:
                    found.setdefault((start, t), p)
                start = t - p + 1
    runs = sorted((s, e - s, p) for (s, e), p in found.items())
    return [(s, length, p) for s, length, p in runs if length >= max(least_words, least_periods * p)]


def periodic_words(rng):
    n, letters = rng.randint(0, 150), rng.choice([1, 2, 2, 3, 5, 20])
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n > 10 else 0):
        start, period = rng.randrange(n), rng.randint(1, n // 3)
        for i in range(start + period, rng.randint(start, n)):
            words[i] = words[i - period]
    return words


def test_catchers_find_every_run():
    rng = random.Random(11)
    for _ in range(4000):
        words = periodic_words(rng)
        catchers = SquareCatchers(len(words))
        cut = rng.randint(0, len(words))
        catchers.extend(words[:cut])
        catchers.extend(words[cut:])
        assert catchers.runs() == plain_runs(words)


def test_runs_of_a_prefix_are_known_before_the_rest_comes():
    words = [1, 2, 3] * 8 + [9, 9, 9]
    catchers = SquareCatchers(20)
    for n, word in enumerate(words, start=1):
        catchers.extend([word])
        assert catchers.runs() == plain_runs(words[:n])


def test_few_catchers_are_live():
    catchers = SquareCatchers(100_000)
    catchers.extend([i % 977 for i in range(50_000)])
    assert sum(map(len, catchers._waiting.values())) <= 5 * 15
    assert catchers.runs() == [(0, 50_000, 977)]


def test_collapse_keeps_one_period():
    words = b"s a b a b a b a b x x x x x x t".split()
    runs = word_runs(words, RunRule())
    assert runs == [(1, 8, 2), (9, 6, 1)]
    assert collapse(words, runs) == b"s a b x t"


def plain_row(doc_id, text):
    words = [w for w in (text or "").replace("\x0b", " ").translate({c: " " for c in (9, 10, 12, 13)}).split(" ") if w]
    h, n = (1 if doc_id is None else zlib.crc32(str(doc_id).encode())), len(words)
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words, 6, 4) if n < 3000 else word_runs([w.encode() for w in words], RunRule())
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *(top or (None,) * 3),
        1000 * top[1] // top[2] if top else None,
        digest("".join(f"{s},{length},{p}\n" for s, length, p in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_runs_of_documents_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plain = Counter(plain_row(*r) for r in rows_of(docs, "doc_id", "text"))
    found = op11_periodic_runs(spark, folder)
    assert by_row(found) == plain
    assert sum(r[1] > 0 for r in plain) > 10


def test_runs_of_no_rows(spark, given):
    assert find_runs(given.limit(0)).collect() == []


# --- token alignment ----------------------------------------------------------


@pytest.fixture(scope="module")
def published():
    """The published tokenizers, read in the other format."""
    from pathlib import Path

    import sentencepiece
    from tokenizers import Tokenizer

    folder = Path(Vocabularies().folder)
    a = Tokenizer.from_file(str(folder / "byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=str(folder / "piece_bpe_32k.model"))


def byte_of_sign():
    """The signs that byte-level vocabularies write for bytes: printable ones as they are, the rest from 256 on."""
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in same]
    return {chr(b): b for b in same} | {chr(256 + i): b for i, b in enumerate(others)}


def plain_groups(text, published):
    """Groups [(A ids, B ids)] of a whole text, token by token."""
    a, b = published
    signs, spelled = byte_of_sign(), b" " + (text or "").encode()
    if not text:
        return []
    of_a = [(i, bytes(signs[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    of_b = [(i, piece(i)) for i in b.encode(text)]
    if b"".join(t for _, t in of_a) != spelled or b"".join(t for _, t in of_b) != spelled:
        return []
    ends = {}
    for k, tokens in enumerate((of_a, of_b)):
        at = 0
        for i, token in tokens:
            at += len(token)
            ends.setdefault(at, [None, None])[k] = i
    groups, now = [], ([], [])
    for at in sorted(ends):
        for k in (0, 1):
            if ends[at][k] is not None:
                now[k].append(ends[at][k])
        if None not in ends[at]:
            groups.append(now)
            now = ([], [])
    return groups


def rendered(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def plain_alignment(rows, published):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups as text) of every row."""
    aligned = [(doc_id, plain_groups(text, published)) for doc_id, text in rows]
    links = [[(a[-1], b[-1]) for a, b in groups] for _, groups in aligned]
    counts = Counter(pair for of_text in links for pair in of_text)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return Counter(
        (
            doc_id,
            sum(len(a) for a, _ in groups),
            sum(len(b) for _, b in groups),
            len(groups),
            len(pairs),
            sum(counts[p] == highest[p[1]] for p in pairs),
            sum(counts[p] for p in pairs),
            hashlib.sha256(rendered(groups).encode()).hexdigest() if groups else "",
        )
        for (doc_id, groups), pairs in zip(aligned, links)
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("hot", [1 << 17, 20])
def test_alignment_equals_brute_force(spark, folder, published, monkeypatch, hot):
    monkeypatch.setattr(token_alignment, "HOT", hot)  # few known pairs: most are joined
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = op12_identity_map(spark, folder)
    assert by_row(found.select(*COLUMNS)) == plain_alignment(rows_of(docs, "doc_id", "text"), published)


def test_odd_spaces_do_not_move_tokens(spark, published):
    rng = random.Random(12)
    bits = ["a", "b ", "  ", "\n", " '", "s", "é", "▁", "1", "\t", "  \n", "\x85", "\x1c", " ", " ", "東", "<s>"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 25))) for _ in range(1500)]
    texts += ["it's 's x", "<|endoftext|> b", "<unk>", "  ", " ", "\x00 a"]
    found = dict(rows_of(align(documents(spark, list(enumerate(texts)))), "doc_id", "groups"))
    for i, text in enumerate(texts):
        assert found[i] == rendered(plain_groups(text, published)), repr(text)


def test_units_are_cut_at_plain_spaces_only():
    assert units_of("a b  c d") == ["a", "b  c", "d"]
    assert units_of("a\n b c") == ["a\n b", "c"]
    assert units_of(" a ") == [" a "]


def test_a_full_table_starts_anew(spark, given, monkeypatch):
    plain = by_row(align(given).select("doc_id", "groups"))
    monkeypatch.setattr(token_alignment, "TABLE_UNITS", 50)
    monkeypatch.setattr(token_alignment, "PORTION_CHARS", 2000)
    assert by_row(align(given).select("doc_id", "groups")) == plain


def test_alignment_of_no_rows(spark, given):
    assert link_totals(align(given.limit(0))).collect() == []


# --- quality classifier -------------------------------------------------------


def test_pooling_gives_the_nearest_rising_sequence():
    rng = np.random.default_rng(13)
    for _ in range(50):
        n = int(rng.integers(1, 12))
        weights, means = rng.integers(1, 5, n).astype(float), rng.random(n)
        got = pooled(weights, means)
        assert (np.diff(got) >= -1e-12).all()
        # The minimax formula of isotonic regression.
        mean = lambda i, j: np.average(means[i : j + 1], weights=weights[i : j + 1])
        want = [max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]
        assert np.allclose(got, want)


def test_weights_solve_the_ridge_problem(spark, given):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    settings = KernelRidge(features=24)
    training = (
        fourier_quality.document_statistics(given).join(usable_labels(labels), "doc_id").selectExpr("x", "y", "cast(doc_id % 2 as int) AS half")
    )
    model = fourier_quality.fit(training.repartition(5), "half", settings)
    rows = training.toPandas()
    x = np.array(rows["x"].tolist())
    z = np.column_stack([np.cos((x - model.features.mean) / model.features.scale @ model.features.directions + model.features.phases), np.ones(len(x))])
    y = 2 * rows["y"].to_numpy() - 1
    want = np.linalg.solve(z.T @ z / len(z) + settings.ridge * np.eye(25), z.T @ y / len(z))
    assert np.allclose(z @ want, model.raw(x), atol=0.02)
    # The projections' products approximate the kernel.
    many = fourier_quality.Features(model.features.mean, model.features.scale, KernelRidge(features=20_000))(x[:20])[:, :-1] / fourier_quality.UNIT
    scaled = (x[:20] - model.features.mean) / model.features.scale
    distances = ((scaled[:, None] - scaled[None, :]) ** 2).sum(axis=2)
    assert np.allclose(2 * many @ many.T / 20_000, np.exp(-distances / (2 * x.shape[1])), atol=0.05)


def test_solving_nothing_gives_no_weights():
    assert not solve(np.zeros((4, 5)), 1e-3).any()


def test_held_out_documents_are_judged_right(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = op13_fourier_quality(spark, sf_dir).join(labels, "doc_id").where("held_out")
    rows = rows_of(judged, "predicted", "quality")
    assert len(rows) > 100
    assert sum(p == q for p, q in rows) >= 0.98 * len(rows)
    assert all(p == 1 for p, q in rows if q == 1)


def test_scores_do_not_depend_on_the_partitions(spark, given):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    one, many = (by_row(score_quality(given.repartition(n), labels.repartition(n))) for n in (1, 7))
    assert one == many


def test_every_odd_row_has_a_score(spark, folder):
    found = rows_of(op13_fourier_quality(spark, folder), "doc_id", "held_out", "score", "predicted")
    ids = [r[0] for r in rows_of(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id")]
    assert Counter(r[0] for r in found) == Counter(ids)
    assert all(0 <= s <= 1 and p == (s >= 0.5) for _, _, s, p in found)
    assert all(h == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, h, _, _ in found)


def test_labels_that_cannot_be_used(spark):
    labels = spark.createDataFrame(
        [(None, 1, 0), (1, None, 0), (2, 7, 0), (3, 1, 1), (3, 0, 0), (4, 0, None)], "doc_id bigint, quality int, toxic int"
    )
    assert sorted(rows_of(usable_labels(labels), "doc_id", "y")) == [(3, 0.5), (4, 0.0)]


def test_without_labels_every_score_is_even(spark):
    docs = documents(spark, odd_rows())
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {(r[0], r[1]) for r in rows_of(score_quality(docs, labels), "score", "predicted")} == {(0.5, 1)}
    assert score_quality(docs.limit(0), labels).collect() == []


def test_labels_of_one_kind(spark):
    docs = documents(spark, [(i, sentence(i, 80)) for i in range(20)])
    labels = spark.createDataFrame([(i, 1) for i in range(10)], "doc_id bigint, quality int")
    assert {r[0] for r in rows_of(score_quality(docs, labels), "score")} == {1.0}
