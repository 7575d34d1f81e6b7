"""Small tables with all the odd rows, and the given documents."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators give to their own columns.
        T.StructField("score", T.StringType()),
        T.StructField("words", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("number", T.StringType()),
        T.StructField("copy", T.StringType()),
    ]
)

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def sentence(seed: int, n: int) -> str:
    """A made-up text of n words, different for each seed."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 16) % 10] + str((x >> 8) % 97))
    return " ".join(out)


def documents(spark, rows):
    """Rows (doc_id, text[, lang[, source]]) as documents with extra columns."""
    full = []
    for doc_id, text, *rest in rows:
        lang, source = (*rest, "en", "s0")[:2] if len(rest) < 2 else rest
        full.append((doc_id, text, lang, source, None if text is None else len(text), "x", "y", "z", "n", "c"))
    return spark.createDataFrame(full, DOCUMENTS)


def odd_rows():
    return [
        (None, "no id here at all", "en", None),
        (1, None, None, "s1"),
        (2, "", "en", "s1"),
        (3, " \t\n ", "de", "s1"),
        (4, "word", "en", None),
        (5, sentence(5, 300), "en", "s0"),
        (6, sentence(5, 300), "en", "s0"),
        (7, sentence(7, 120) + " " + sentence(7, 120), "de", "s0"),
        (8, "!!! ### $$$", "en", "s2"),
        (9, sentence(9, 20000), "en", "s0"),
        (9, sentence(9, 20000), "en", "s0"),
        (9, "another text of the same id", "en", "s0"),
        (10, "Ünïcode wörds 東京 🙂 " * 30, "fr", "s2"),
    ]


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
