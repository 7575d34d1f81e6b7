"""The corpus pipeline, stage by stage and as a whole."""

import collections

from samples import DOCUMENTS, documents, odd_rows, rows_of, sentence

import __spark_entry__ as registry
import corpus_pipeline
import oracle
from claimstrata.llm import url_vocabulary
from conftest import SF_DIR


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF_DIR).cache()
        seen[name] = (docs, after)
        if name != "packing":
            assert after.columns == docs.columns
            assert after.join(docs, docs.columns, "left_anti").count() == 0
        docs = after
    identified, good = seen["quality rules"]
    assert 0.6 * identified.count() < good.count() < identified.count()
    before, single = seen["MinHash near-dedup"]
    assert before.select("text").distinct().count() >= single.count() == single.select("doc_id").distinct().count()
    mixed, packed = seen["packing"]
    assert packed.where("piece = 0").count() == mixed.count()
    whole = collections.Counter(rows_of(corpus_pipeline.run(spark, SF_DIR), "doc_id", "piece", "n_tokens"))
    assert whole == collections.Counter(rows_of(packed, "doc_id", "piece", "n_tokens"))


def test_stages_on_odd_and_no_rows(spark):
    single, packed = [], []
    for docs in (documents(spark, odd_rows() + [(50 + i, sentence(i, 80)) for i in range(9)]), spark.createDataFrame([], DOCUMENTS)):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, SF_DIR).cache()
            assert name == "packing" or after.columns == docs.columns
            docs = after
            if name == "MinHash near-dedup":
                single.append({r["doc_id"] for r in docs.collect()})
        packed.append({r["doc_id"] for r in docs.collect()})
    # Sentences like the trusted ones come through the filters, empty and short texts and copies do not.
    assert single[0] >= {5, 9, 50, 51, 52, 53, 57}
    assert not single[0] & {1, 2, 3, 4, 6, 8}
    assert packed[0] and packed[0] <= single[0]
    assert single[1] == packed[1] == set()


def test_registered(spark):
    names = registry.queries()
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))


def test_urls_against_sql(spark):
    engine = oracle.connect(SF_DIR)
    result = registry.queries()["op3_url_vocabulary"](spark, SF_DIR)
    assert oracle.differences(result, engine, url_vocabulary.oracle()) == []
