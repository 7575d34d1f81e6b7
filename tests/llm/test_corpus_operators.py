"""Fingerprints, quality rules, near-duplicates, mixing, packing, quotations."""

import collections
import hashlib
import itertools
import re

import pytest
import regex
import xxhash
from samples import DOCUMENTS, documents, odd_rows, rows_of, sentence

from claimstrata.llm import bottom_sketches, imatch, length_buckets, quote_links, target_ratio, temperature_mix
from claimstrata.llm.components import components
from conftest import SF_DIR

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text):
    return [w for w in SPACES.split(text or "") if w]


def hash64(data: bytes, seed: int = 42) -> int:
    value = xxhash.xxh64(data, seed=seed).intdigest()
    return value - (1 << 64) if value >> 63 else value


def hash_numbers(values) -> int:
    seed = 42
    for v in values:
        seed = hash64(v.to_bytes(8, "little", signed=True), seed & ((1 << 64) - 1))
    return seed


# --- fingerprints -----------------------------------------------------------


def plain_fingerprints(rows, settings):
    """doc_id -> values, for distinct ids, from the texts alone."""
    ordered = sorted(((i, t or "") for i, t in rows), reverse=True)
    texts = [t for _, t in ordered]

    def terms(text):
        found = [w for w in re.split(r"[\W_]+", text.lower()) if w]
        return sorted({hash64(w.encode()) for w in found})

    df = collections.Counter(h for t in texts for h in set(terms(t)))
    band = {s for s, n in df.items() if settings.least_share * len(texts) <= n <= settings.most_share * len(texts)}

    def fingerprint(text):
        all_terms = terms(text)
        kept = [t for t in all_terms if t in band] or all_terms
        subsets = [kept]
        again = []
        for seed in range(-(-settings.draws // 8)):
            first = [hash64(t.to_bytes(8, "little", signed=True)) & ((1 << 64) - 1) for t in kept]
            again.append([xxhash.xxh64(seed.to_bytes(4, "little"), seed=f).intdigest() for f in first])
        for level in settings.levels:
            for draw in range(settings.draws):
                mask = ((1 << level) - 1) << 8 * (draw % 8)
                subsets.append([h - (1 << 64) if h >> 63 else h for h in again[draw // 8] if not h & mask])
        return [hash_numbers(s) if s else None for s in subsets]

    def like(a, b):
        either = [(x, y) for x, y in zip(a, b) if x is not None or y is not None]
        return sum(x == y for x, y in either) / len(either) if either else 1.0

    show = lambda f: "".join("-" if h is None else f"{h & 0xFFFFFFFF:08x}" for h in f)
    out = {}
    for k, (doc_id, text) in enumerate(ordered):
        after, half = texts[(k + 1) % len(texts)], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed = fingerprint(text), fingerprint(edited)
        out[doc_id] = (
            len(text), hashlib.sha256(edited.encode()).hexdigest(), show(own), show(changed),
            like(own, changed), like(own, fingerprint(after)),
        )
    return out


COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@pytest.mark.parametrize("per_range", [1, 3, 64])
def test_fingerprints_against_plain_ones(spark, per_range):
    rows = [(i * 37 % 101, sentence(i % 9, 5 + i)) for i in range(20)] + [(500, None), (-4, ""), (501, "a b"), (502, "日本 語 🙂")]
    settings = imatch.IMatch(least_share=0.05, most_share=0.6, docs_per_range=per_range)
    got = {r[0]: r[1:] for r in rows_of(imatch.fingerprint_edits(documents(spark, rows), settings), *COLUMNS)}
    expected = plain_fingerprints(rows, settings)
    assert got.keys() == expected.keys()
    for doc_id, values in expected.items():
        assert got[doc_id][:4] == values[:4]
        assert got[doc_id][4:] == pytest.approx(values[4:])


def test_lexicon_is_the_band_of_terms(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r["text"] for r in docs.select("text").collect()]
    words = [set(regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())) for t in texts]
    df = collections.Counter(w for of_text in words for w in of_text)
    n = len(texts)
    settings = imatch.IMatch(least_share=0.005)
    band = {hash64(w.encode()) for w, k in df.items() if 0.005 * n <= k <= 0.1 * n}
    assert len(band) > 1000
    assert {r["term"] for r in imatch.lexicon(docs, n, settings).collect()} == band


def test_the_lexicon_travels_outside_the_rows(spark):
    docs = documents(spark, [(i, sentence(i, 20)) for i in range(9)])
    plan = imatch.fingerprint_edits(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "own_table" not in plan and "edited_table" not in plan and "scalar-subquery" in plan


def test_fingerprints_of_odd_rows(spark):
    docs = documents(spark, odd_rows())
    got = imatch.fingerprint_edits(docs).collect()
    assert len(got) == len(odd_rows())
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[5]["fingerprint"] == by_id[6]["fingerprint"]
    assert by_id[6]["near_next"] == 1.0
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    alone = imatch.fingerprint_edits(documents(spark, [(None, "abcd")])).collect()[0]
    assert alone["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    assert imatch.fingerprint_edits(spark.createDataFrame([], DOCUMENTS)).count() == 0


# --- quality ----------------------------------------------------------------


def plain_base(text):
    words, lines = words_of(text), (text or "").split("\n")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {g for g, n in collections.Counter(grams).items() if n > 1}
    covered = {i + k for i, g in enumerate(grams) if g in often for k in range(3)}
    with_word = [line for line in lines if words_of(line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(with_word) - len(set(with_word)), len(covered), failed,
    )


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    rows = given + [(10_000 + i, r[1]) for i, r in enumerate(odd_rows())] + [
        (20_000, "a b c a b c a\n\n x\n x\nx\r\nx\r\n \n   b"),
        (20_001, "a a a a"),
        (20_002, "a\x0bb\x0cc\x1cd e"),
    ]
    docs = documents(spark, rows)
    texts = dict(rows)
    judged = target_ratio.judge_quality(docs.select("doc_id", "text"), [])
    for doc_id, *got in rows_of(judged, "doc_id", *BASE, "kept"):
        assert tuple(got[:-1]) == plain_base(texts[doc_id]), repr(texts[doc_id])[:200]
        assert got[-1] == (not got[-2])


def test_ratio_against_a_plain_one(spark):
    import math

    rows = [(i, sentence(i, 60 + i)) for i in range(12)] + [(90, "|||  one"), (91, None)]
    trusted, n = [0, 1, 2], target_ratio.BUCKETS
    grams = {}
    for doc_id, text in rows:
        h = [hash64(w.encode()) for w in words_of(text)]
        grams[doc_id] = [g % n for g in h + [hash_numbers(p) for p in zip(h, h[1:])]]
    raw = collections.Counter(g for v in grams.values() for g in v)
    good = collections.Counter(g for i in trusted for g in grams[i])
    ratio = lambda b: round(target_ratio.SCALE * (
        math.log((good[b] + 1) / (good.total() + n)) - math.log((raw[b] + 1) / (raw.total() + n))
    ))
    limits = target_ratio.QualityLimits(least_ratio=0.0)
    judged = target_ratio.judge_quality(documents(spark, rows).select("doc_id", "text"), trusted, limits)
    for doc_id, got, failed, kept in rows_of(judged, "doc_id", "ratio", "base_failed", "kept"):
        exact = sum(map(ratio, grams[doc_id])) / len(grams[doc_id]) / target_ratio.SCALE if grams[doc_id] else None
        assert got == (None if exact is None else pytest.approx(exact))
        assert kept == (not failed and exact >= 0)


def test_kept_documents_are_as_they_came(spark):
    docs = documents(spark, odd_rows())
    kept = target_ratio.keep_good(docs, [5])
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= {5, 6}
    assert target_ratio.keep_good(spark.createDataFrame([], DOCUMENTS), []).count() == 0


def test_trusted_sample_is_bounded(spark):
    labels = spark.createDataFrame([(i, i % 2, None if i % 3 else i % 2) for i in range(40)] + [(None, 1, 0)], "doc_id bigint, quality int, toxic int")
    ids = target_ratio.trusted_ids(labels, target_ratio.QualityLimits(trusted_docs=5))
    assert len(ids) == 5 and all(i % 2 and i % 3 for i in ids)


# --- near-duplicates --------------------------------------------------------


def shingles(text, width=2):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = words_of((text or "").translate(fold))
    size = min(width, len(w))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()


def plain_components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = sorted((find(i), find(j)))
            root[y] = x
    return {i: find(i) for i, _ in sets}


def mutated(text, every, tag):
    """The text with each `every`-th word changed."""
    words = text.split(" ")
    return " ".join(f"{tag}{k}" if k % every == every - 1 else w for k, w in enumerate(words))


def near_rows():
    base = sentence(1, 200)
    rows = [(i, sentence(i, 20 + i)) for i in range(40)]
    rows += [(100 + i, mutated(base, 8 + i, f"x{i}")) for i in range(60)]
    rows += [(200 + i, base.upper()) for i in range(5)] + [(300, base + " tail end"), (301, None), (302, " "), (303, "One"), (304, "one")]
    rows += [(400 + i, " ".join(f"c{k}" for k in range(i * 4, i * 4 + 60))) for i in range(10)]  # a chain
    return rows + [(500 + i, " ".join(f"w{k}" for k in range(i))) for i in range(2, 12)]


@pytest.mark.parametrize("block", [4, 128])
def test_components_against_all_pairs(spark, block):
    rows = near_rows()
    settings = bottom_sketches.NearDuplicates(block=block)
    got = {r["doc_id"]: r for r in bottom_sketches.near_duplicates(documents(spark, rows), settings).collect()}
    expected = plain_components(rows)
    assert {i: r["component_id"] for i, r in got.items()} == expected
    assert all(got[i]["n_shingles"] == len(shingles(t)) for i, t in rows)
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_given_documents_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    expected = plain_components(rows_of(docs, "doc_id", "text"))
    assert dict(rows_of(bottom_sketches.near_duplicates(docs), "doc_id", "component_id")) == expected


def test_near_duplicates_of_odd_rows(spark):
    docs = documents(spark, odd_rows())
    got = bottom_sketches.near_duplicates(docs).collect()
    assert len(got) == len(odd_rows())
    by_id = {r["doc_id"]: r for r in got}
    assert (by_id[6]["component_id"], by_id[6]["kept"]) == (5, False)
    assert (by_id[None]["component_id"], by_id[None]["kept"]) == (None, True)
    assert by_id[1]["n_shingles"] == 0 and by_id[1]["kept"]
    kept = bottom_sketches.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert collections.Counter(r["doc_id"] for r in kept.collect()) == {**{i: 1 for i in (None, 1, 2, 3, 4, 5, 7, 8, 10)}, 9: 2}
    empty = spark.createDataFrame([], DOCUMENTS)
    assert bottom_sketches.near_duplicates(empty).count() == bottom_sketches.keep_one_of_each(empty).count() == 0


def test_rows_that_repeat_an_id_are_judged_by_their_texts(spark):
    rows = [(1, sentence(1, 60)), (5, sentence(1, 60)), (5, sentence(2, 60)), (5, sentence(2, 60)), (5, sentence(3, 60)), (7, None), (7, "")]
    kept = rows_of(bottom_sketches.keep_one_of_each(documents(spark, rows)), "doc_id", "text")
    assert len(kept) == 4
    assert {t for i, t in kept if i == 5} == {sentence(2, 60), sentence(3, 60)}
    assert [i for i, _ in kept if i != 5] == [1, 7]


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 999), (5, 5), (999, 1000)]
    found = dict(rows_of(components(spark.createDataFrame(links, "u bigint, v bigint")), "node", "root"))
    assert found == {i: 0 for i in range(301)} | {999: 999, 1000: 999}


# --- mixing -----------------------------------------------------------------


def test_mix_meets_its_targets(spark):
    sizes = {"big": 600, "mid": 100, "small": 30, None: 20}
    rows, doc_id = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((doc_id, sentence(doc_id, 5 + doc_id % 7), "en", source))
            doc_id += 1
    rows += [(9000, None, "en", "empty"), (9001, "", "en", "big")]
    docs = documents(spark, rows)
    mix = temperature_mix.Mix(target_entropy=0.9, repetition_limit=4.0)
    got = temperature_mix.mix_sources(docs, mix, "m_").collect()
    assert got[0].asDict().keys() >= set(docs.columns)
    tokens = collections.Counter()
    for _, text, _, source in rows:
        tokens[source] += len(words_of(text))
    total = sum(tokens.values())
    weight = {r["source"]: r["m_weight"] for r in got}
    # One exponent explains all weights.
    import math

    a = {s: math.log(weight[s] / weight["big"]) / math.log(tokens[s] / tokens["big"]) for s in ("mid", "small", None)}
    assert max(a.values()) - min(a.values()) < 1e-6
    entropy = -sum(w * math.log(w) for w in weight.values())
    repeats = max(w * total / tokens[s] for s, w in weight.items())
    at_limit = abs(repeats - 4) < 1e-3 or abs(entropy - 0.9 * math.log(4)) < 1e-3
    assert at_limit and repeats <= 4.001 and entropy <= 0.9 * math.log(4) + 1e-3
    # Each source's copies: whole epochs, then the prefix of one more permutation.
    copies = collections.Counter((r["source"], r["doc_id"]) for r in got)
    for source, w in weight.items():
        own = {i: len(words_of(t)) for i, t, _, s in rows if s == source}
        budget = int(w * total + 1e-6)
        spent = sum(own[i] * n for (s, i), n in copies.items() if s == source)
        assert budget - max(own.values()) <= spent <= budget + 1
        assert {copies[source, i] for i in own} <= {budget // sum(own.values()), budget // sum(own.values()) + 1}
    assert all(0 <= r["m_place"] < 1 and r["m_block"] == 0 for r in got)
    assert temperature_mix.mixed_documents(docs, mix).columns == docs.columns


def test_mix_of_few_rows(spark):
    assert temperature_mix.mix_sources(spark.createDataFrame([], DOCUMENTS)).count() == 0
    assert temperature_mix.mix_sources(documents(spark, [(1, None), (2, " ")])).count() == 0
    odd = documents(spark, odd_rows())
    assert temperature_mix.mixed_documents(odd).count() > 0


def test_even_sources_stay_as_they_are(spark):
    docs = documents(spark, [(i, "a b c", "en", f"s{i % 2}") for i in range(10)])
    assert temperature_mix.mix_sources(docs).groupBy("doc_id").count().where("count = 1").count() == 10


# --- packing ----------------------------------------------------------------


@pytest.mark.parametrize("buckets", [1, 2, 3, 9])
def test_buckets_are_the_best_ones(buckets):
    lengths, counts = [1, 2, 5, 6, 9, 30], [5, 1, 7, 2, 4, 1]
    padded = lambda b: sum(n * min(x for x in b if x >= length) for length, n in zip(lengths, counts))
    best = min(
        padded([*inner, 30])
        for k in range(buckets)
        for inner in itertools.combinations(lengths[:-1], min(k, 5))
    )
    chosen = length_buckets.choose_buckets(lengths, counts, buckets)
    assert len(chosen) <= buckets and padded(chosen) == best


def test_batches(spark):
    rows = [(i, sentence(i, 1 + i * i % 90)) for i in range(200)] + odd_rows()
    packing = length_buckets.Packing(buckets=4, max_tokens=64, batch_tokens=256)
    got = length_buckets.pack(documents(spark, rows), packing).collect()
    pieces = collections.Counter((r["doc_id"], r["piece"], r["start"], r["n_tokens"]) for r in got)
    expected = collections.Counter()
    for doc_id, text, *_ in rows:
        n = len(words_of(text))
        expected.update((doc_id, k, 64 * k, min(64, n - 64 * k)) for k in range(-(-n // 64)))
    assert pieces == expected
    assert all(r["n_tokens"] <= r["bucket_len"] for r in got)
    batches = collections.defaultdict(list)
    for r in got:
        batches[r["bucket_len"], r["batch"]].append(r["slot"])
    for (bucket, batch), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= 256 // bucket
        last = max(b for k, b in batches if k == bucket)
        assert batch == last or len(slots) == 256 // bucket
    assert length_buckets.pack(spark.createDataFrame([], DOCUMENTS)).count() == 0


# --- quotations -------------------------------------------------------------


def test_replies(spark):
    rows = [
        (1, 0, "u", "Hello there\nHow are you?"),
        (1, 1, "a", "> hello   THERE\nFine"),
        (1, 2, "u", ">> Hello there\n> Fine\nok\n> nothing like it\nbye"),
        (1, 3, "a", None),
        (1, 4, "a", "> bye"),
        (1, 5, "a", "> > fine"),
        (2, 0, "u", "Fine"),
        (2, 1, "x", "> > bye\r\n>\n"),
        (2, 1, "x", "> > bye\r\n>\n"),
        (None, 1, "x", "> b\nc"),
        (3, None, "x", "> b"),
    ]
    chat = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").selectExpr("*", "1 AS depth")
    got = rows_of(quote_links.reply_order(chat), "conv_id", "thread_turn", "turn", "depth", "parent_turn", "text", "n_quotes", "n_linked")
    expected = [
        (1, 0, 0, 0, None, "Hello there\nHow are you?", 0, 0),
        (1, 0, 1, 1, 0, "Fine", 1, 1),
        (1, 0, 2, 2, 1, "ok\nbye", 3, 2),
        (1, 3, 3, 0, None, "", 0, 0),
        (1, 0, 4, 3, 2, "", 1, 1),
        (1, 0, 5, 2, 1, "", 1, 1),
        (2, 0, 0, 0, None, "Fine", 0, 0),
        (2, 1, 1, 0, None, "", 2, 0),
        (2, 1, 1, 0, None, "", 2, 0),
        (None, 1, 1, 0, None, "c", 1, 0),
        (3, None, None, 0, None, "", 1, 0),
    ]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert quote_links.reply_order(chat.limit(0)).count() == 0


def test_a_long_chain_of_replies(spark):
    rows = [(1, t, "u", (f"> word{t - 1}\n" if t else "") + f"word{t}") for t in range(70)]
    got = rows_of(quote_links.reply_order(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")), "turn", "depth", "thread_turn", "text")
    assert sorted(got) == [(t, t, 0, f"word{t}") for t in range(70)]


def test_sizes_of_sets_do_not_travel_with_each_value(spark, monkeypatch):
    lists = []
    monkeypatch.setattr(bottom_sketches, "stored", lambda df, name: lists.append(df) or df)
    classes = spark.createDataFrame([(i, 4, [1, 2, 3, 4 + i]) for i in range(6)], "cls long, n long, sketch array<long>")
    bottom_sketches.hub_groups(classes, bottom_sketches.NearDuplicates())
    plan = lists[0]._jdf.queryExecution().executedPlan().toString()
    carried = re.findall(r"Generate explode\(sketch#\d+\), \[([^\]]*)\]", plan)
    assert carried and not any(re.search(r"\bn#", columns) for columns in carried)


def test_inverted_lists_are_shuffled_once(spark):
    classes = spark.createDataFrame([(i, 4, [1, 2, 3, 4 + i]) for i in range(20)], "cls long, n long, sketch array<long>")
    groups = bottom_sketches.hub_groups(classes, bottom_sketches.NearDuplicates())
    plan = groups._jdf.queryExecution().executedPlan().toString()
    # By value after the lists are stored, then by pair: no list travels again to meet its hub.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    assert "Join" not in plan


@pytest.mark.parametrize("n", [3, 8, 9, 30])
def test_members_of_small_lists_are_paired_and_of_large_ones_meet_the_hub(spark, n):
    rows = [(i, 20, [*range(1, 20), 100 + i]) for i in range(n)] + [(1000, 12, [1, 2, *range(500, 510)])]
    classes = spark.createDataFrame(rows, "cls long, n long, sketch array<long>")
    got = {(r["hub"], r["x"]) for r in bottom_sketches.hub_groups(classes, bottom_sketches.NearDuplicates()).collect()}
    if n <= 8:
        assert got == {(a, b) for a in range(n) for b in range(a + 1, n)}
    else:
        assert len(got) == n - 1 and len({hub for hub, _ in got}) == 1
        assert {x for pair in got for x in pair} == set(range(n))
