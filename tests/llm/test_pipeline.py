"""The registered queries and the pipeline over the small tables."""

import collections

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from stratus.llm.catalog import ORACLES, QUERIES
from stratus.llm.ngram_jaccard import jaccard_groups
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    problems = compare(spark, duck(SF), name, QUERIES[name], ORACLES[name], SF)
    assert not problems, problems


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]


def test_stages_follow_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = corpus_pipeline.language_id(spark, docs, SF)
    assert one.columns == docs.columns and one.count() == docs.where("text rlike '[A-Za-z]'").count()
    two = corpus_pipeline.near_duplicates(spark, docs, SF)
    groups = QUERIES["op1_ngram_jaccard_join"](spark, SF)
    assert {r[0] for r in two.select("doc_id").collect()} == {r[0] for r in groups.select("component_id").collect()}
    assert two.columns == docs.columns
    three = corpus_pipeline.decontamination(spark, docs, SF)
    clean = QUERIES["op6_benchmark_decontamination"](spark, SF).where("not contaminated")
    assert {r[0] for r in three.select("doc_id").collect()} == {r[0] for r in clean.select("doc_id").collect()}
    four = corpus_pipeline.mixing(spark, docs, SF)
    report = {r.doc_id: r.taken // r.size for r in QUERIES["op5_mixing"](spark, SF).collect() if r.size}
    drawn = collections.Counter(r[0] for r in four.select("doc_id").collect())
    assert all(drawn[k] == n for k, n in report.items()) and four.columns == docs.columns


def test_near_duplicates_by_text(spark):
    """Ids with two texts, null ids, and a link through a text that only null ids have."""
    def text(name, a=0, b=100):
        return " ".join(f"{name}{k}" for k in range(a, b))

    rows = [(1, text("a")), (5, text("a")), (5, text("b")), (None, text("a")),
            (9, text("c", 16)), (None, text("c")), (None, text("c")), (8, text("c", 0, 84)),
            (None, text("d")), (None, text("d")), (7, text("e")), (7, text("E")), (7, text("e")),
            (None, None), (None, None), (10, ""), (5, "")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    kept = collections.Counter((r.doc_id, r.text and r.text.lower()) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect())
    assert kept == collections.Counter([(1, text("a")), (5, text("b")), (8, text("c", 0, 84)), (None, text("d")),
                                        (7, text("e")), (None, None), (10, ""), (5, "")])
    groups = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_groups(docs).collect()}
    assert groups == {(1, 96, 1), (5, 96, 1), (5, 96, 5), (None, 96, 1), (9, 80, 8), (None, 96, 8), (8, 80, 8),
                      (None, 96, None), (7, 96, 7), (None, 0, None), (10, 0, 10), (5, 0, 5)}


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    counts = collections.Counter(r.shard for r in rows)
    assert rows and max(counts.values()) - min(counts.get(k, 0) for k in range(40)) <= 1
