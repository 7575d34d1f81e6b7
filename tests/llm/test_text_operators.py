"""Language ID, URL filter, license scan and page extraction."""

import re
import zlib

import pytest
from samples import DOCUMENTS, documents, odd_rows, rows_of

from claimstrata.llm import language_ppm, license_templates, url_vocabulary
from claimstrata.llm.html_regions import extract_pages, main_text
from conftest import SF_DIR


# --- language ---------------------------------------------------------------


def test_held_out_languages_are_found(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    said = language_ppm.identify_languages(docs.select("doc_id", "text"), docs).toPandas()
    truth = dict(rows_of(docs, "doc_id", "lang"))
    held = [i for i in said.doc_id if zlib.crc32(str(i).encode()) % 3 == 1]
    found = dict(zip(said.doc_id, said.lang_pred))
    assert sum(found[i] == truth[i] for i in held) >= 0.97 * len(held)
    assert said.score.between(0, 1).all()


def test_language_of_odd_rows(spark):
    docs = documents(spark, odd_rows())
    said = {
        (r["doc_id"], r["text"]): (r["lang_pred"], r["score"], r["kept"])
        for r in language_ppm.identify_languages(docs).collect()
    }
    for key in [(1, None), (2, ""), (3, " \t\n "), (8, "!!! ### $$$")]:
        assert said[key] == ("und", 0.0, "z")
    assert said[None, "no id here at all"][0] in ("en", "de", "fr")
    kept = language_ppm.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {r["score"] for r in kept.collect()} == {"x"}
    assert not kept.where("doc_id in (1, 2, 3, 8)").count()


def test_language_without_training_rows(spark):
    docs = documents(spark, [(1, "some words", None, "s")])
    assert rows_of(language_ppm.identify_languages(docs), "lang_pred", "score") == [("und", 0.0)]
    empty = spark.createDataFrame([], DOCUMENTS)
    assert language_ppm.identify_languages(empty).count() == 0


def test_unlearned_languages_and_letter_noise_go(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    foreign = [
        "人工智能是计算机科学的一个分支，它企图了解智能的实质，并生产出一种新的机器。" * 3,
        "Быстрая коричневая лиса прыгает через ленивую собаку, и это предложение написано по-русски. " * 2,
        "zxq" * 30,
        "qwrtp zxkvb mnbvc lkjhg fdsaq " * 10,
    ]
    own = "The committee agreed to publish the report next week, after the members had read it and sent their remarks."
    wide = documents(spark, [(i, t) for i, t in enumerate([*foreign, own, "Bonjour"])])
    assert sorted(r["doc_id"] for r in language_ppm.keep_identified(wide, docs).collect()) == [4, 5]
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1")
    clean = docs.join(labels, "doc_id", "left_semi").where(r"text rlike '\\p{L}'")
    assert language_ppm.keep_identified(clean.select(docs.columns), docs).count() >= 0.998 * clean.count()


def test_each_training_text_gives_its_share_at_most(spark):
    rows = [(i, "ä" * 5000 if i < 3 else f"text {i}", "de", "s") for i in range(60)]
    sample = language_ppm.Sample(docs=20, bytes=20 * 101)
    texts = language_ppm.training_texts(documents(spark, rows), sample)["de"]
    assert len(texts) == 20 and max(map(len, texts)) <= 101
    every = language_ppm.training_texts(documents(spark, rows), language_ppm.Sample(docs=60, bytes=60 * 101))["de"]
    trained = [t for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    assert sorted(every) == sorted(t.encode()[:101] for t in trained)


def plain_ppm(text, samples):
    """Code length of `text` by walking the contexts, one byte at a time."""
    import math

    counts = {}
    for sample in samples:
        padded = b"\n\n\n" + sample
        for i in range(3, len(padded)):
            for order in range(4):
                follow = counts.setdefault(padded[i - order : i], {})
                follow[padded[i]] = follow.get(padded[i], 0) + 1
    padded, bits = b"\n\n\n" + text, 0.0
    for i in range(3, len(padded)):
        out, mass = set(), 1.0
        for order in (3, 2, 1, 0):
            follow = counts.get(padded[i - order : i], {})
            left = {b: n for b, n in follow.items() if b not in out}
            if not left:
                continue
            total = sum(left.values()) + len(left)
            if padded[i] in left:
                mass *= left[padded[i]] / total
                break
            mass *= len(left) / total
            out |= set(left)
        else:
            mass /= 256 - len(out)
        bits -= math.log2(mass)
    return bits


def test_tables_hold_exact_code_lengths():
    samples = {"a": [b"the cat sat on the mat", b"that hat"], "b": [b"der Hund und die Katze", "größer".encode()]}
    tables = language_ppm.build_tables(samples)
    for text in (b"", b"the", b"das ist \xff neu\n", "Straße und Hut".encode(), b"zzzz"):
        exact = [plain_ppm(text, samples[lang]) for lang in tables.languages]
        assert language_ppm.code_lengths(text, tables) == pytest.approx(exact, rel=1e-5, abs=1e-4)


def test_long_texts_are_scored_piece_by_piece(monkeypatch):
    tables = language_ppm.build_tables({"a": [b"abcabcabd" * 5], "b": [b"xyz abc" * 5]})
    text = b"abcxyzabd " * 40
    whole = language_ppm.code_lengths(text, tables)
    monkeypatch.setattr(language_ppm, "SEGMENT", 7)
    assert language_ppm.code_lengths(text, tables) == pytest.approx(whole)


# --- urls -------------------------------------------------------------------


def test_urls(spark):
    urls = [
        (1, "http://A.Example.NET/en/x"),
        (2, "https://net/"),
        (3, "https://net"),
        (4, "https://x.example.com/de/1?casino"),
        (5, "http://spam-farm.example.org/fr/a"),
        (6, "http://spam-farm.example.org/en"),
        (7, "http://free.org/page"),
        (8, "http://free-bets.org/"),
        (9, "http://freebets.org/casinos"),
        (10, "no scheme casino"),
        (11, None),
        (12, ""),
        (13, "http://host?x=free#free"),
        (13, "http://host?x=free#free"),
        (None, "ftp://h/p?q"),
    ]
    pages = spark.createDataFrame(urls, "page_id bigint, url string").selectExpr("*", "'x' AS host", "1 AS verdict")
    got = rows_of(url_vocabulary.filter_urls(pages), "page_id", "host", "path", "rule", "verdict")
    assert got == [
        (1, "a.example.net", "/en/x", "example.net/en/", "allow"),
        (2, "net", "/", "net/", "block"),
        (3, "net", "", None, "allow"),
        (4, "x.example.com", "/de/1", "example.com/de/", "block"),
        (5, "spam-farm.example.org", "/fr/a", "org/fr/", "allow"),
        (6, "spam-farm.example.org", "/en", None, "block"),
        (7, "free.org", "/page", None, "allow"),
        (8, "free-bets.org", "/", None, "block"),
        (9, "freebets.org", "/casinos", None, "allow"),
        (10, "", "", None, "block"),
        (11, "", "", None, "allow"),
        (12, "", "", None, "allow"),
        (13, "host", "", None, "allow"),
        (13, "host", "", None, "allow"),
        (None, "h", "/p", None, "allow"),
    ]
    assert url_vocabulary.filter_urls(pages.limit(0)).count() == 0


# --- licenses ---------------------------------------------------------------


def test_license_cases(spark):
    docs = documents(
        spark,
        [
            *odd_rows(),
            (20, "Released UNDER the MIT-License. And again under the mit license"),
            (21, "This work is licensed under the GNU General Public License, version 3."),
            (22, "under the gnu public license version 3"),
            (23, "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
            (24, "apache license version 2"),
            (25, "Copyright (c) 2020 Some Body. All rights reserved. cc by-nc"),
        ],
    )
    got = {r["doc_id"]: r for r in license_templates.scan_licenses(docs).collect()}
    assert (got[20]["n_base"], got[20]["first_word"], got[20]["last_word"]) == (2, 1, 7)
    assert (got[20]["base_labels"], got[20]["labels"]) == ("mit", "mit")
    assert (got[21]["n_base"], got[21]["labels"], got[21]["score"]) == (0, "gpl-3", 1.0)
    assert got[22]["labels"] == ""
    assert (got[23]["labels"], got[23]["score"]) == ("apache-2", 1.0)
    assert (got[24]["base_labels"], got[24]["n_words"], got[24]["score"]) == ("apache-2", 4, 1.0)
    assert (got[25]["base_labels"], got[25]["labels"]) == ("cc-by-nc", "all-rights-reserved,cc-by-nc")
    assert (got[1]["n_words"], got[1]["labels"], got[1]["score"], got[1]["first_word"]) == (0, "", 0.0, None)
    assert len(license_templates.scan_licenses(docs).collect()) == docs.count()


def test_base_scan_equals_a_plain_one(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = dict(rows_of(docs, "doc_id", "text"))
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for r in license_templates.scan_licenses(docs).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (texts[r["doc_id"]] or "").translate(fold))
        places = [
            (i, label)
            for phrase, label in license_templates.PHRASES
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))


def as_regex(template):
    out = []
    for token in template.split():
        if token == "<<optional>>":
            out.append("(?:")
        elif token == "<<end>>":
            out.append(")?")
        elif token.startswith("<<any"):
            out.append("(?: \\S+){0,%s}" % token[10:-2])
        else:
            out.append(" " + token)
    return re.compile("".join(out) + "(?= )")


def test_automata_accept_what_regular_expressions_do():
    texts = [
        "x this work of ours is released under the terms of the mit license y",
        "this a b c d is under the mit license",
        "copyright c some people all rights reserved all rights reserved",
        "under gnu lesser general public license version 2 1",
        "under the gnu lesser general public license version 2 1 z",
    ]
    for label, template in license_templates.TEMPLATES:
        automaton = license_templates.compile_template(label, template)
        for text in texts:
            found = automaton.spans(text.encode().split())
            assert bool(found) == bool(as_regex(template).search(f" {text} ")), (template, text)


# --- pages ------------------------------------------------------------------


PAGE = """<html><head><title>T</title><script>var a="</p><p>no";</script></head><body>
<div class="cookie-notice">We use cookies</div><nav><ul><li><a href=x>Home</a></ul></nav>
<article><h1>Title &amp; more</h1><p>First   paragraph<br>goes on with many words in it.<p><b>Second
one</b> &copy; &#8364;<div class="ad">Buy now</div><aside>Aside</aside><p>Of.</p>
<form><input>Mail <button>Go</button></form></article>
<section id="comments"><p>Nice article, says a reader with a long comment that runs on.</p></section>
<footer>Foot</footer>"""


def test_article_only():
    assert main_text(PAGE) == "Title & more\n\nFirst paragraph goes on with many words in it.\n\nSecond one © €\n\nOf."


@pytest.mark.parametrize("html", [None, "", "   ", "<p></p>", "<nav>menu</nav>", "<script>x", "<!-- c -->", "<"])
def test_pages_without_text(html):
    assert main_text(html) in ("", "<")


def test_page_without_containers():
    body = "".join(f"<div>{'word ' * 40}{i}</div>" for i in range(4))
    page = f"<body><div><a href=1>one</a> <a href=2>two</a></div>{body}<div><a href=3>imprint</a></div>"
    got = main_text(page).split("\n\n")
    assert [g.split()[-1] for g in got] == ["0", "1", "2", "3"]


def test_pages_keep_every_row(spark):
    rows = [(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (2, None, None, "t"), (None, "v", "<p>x" * 5000, "t")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = extract_pages(pages).collect()
    assert [r["n_chars"] for r in got] == [len(r["text"]) for r in got]
    assert [(r["page_id"], r["url"]) for r in got] == [(1, "u"), (1, "u"), (2, None), (None, "v")]
    assert got[3]["text"] == "\n\n".join(["x"] * 5000)
    assert extract_pages(pages.limit(0)).count() == 0


def test_articles_of_given_pages(spark):
    import html

    for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        parts = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in parts]
        assert main_text(r["html"]) == "\n\n".join(b for b in blocks if b)
