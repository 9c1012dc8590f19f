import pytest

import __spark_entry__ as entry
import corpus_pipeline
from corpus_pipeline import F
from opsledger.llm import bpe_codec, queries
from tests import oracle

#: Names that operators and stages use for their own columns.
OWN = ["n_lines", "n_removed", "n_spans", "kept_lines", "score", "quality score", "matches", "benchmark matches", "rest", "k", "f", "t", "c0",
       "__k", "__f", "__starts", "starts", "component_id", "n_shingles", "odd.name", "sig", "rep", "c", "found_key"]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows_as_sql(spark, con, name):
    assert oracle.compare(queries.QUERIES[name](spark, oracle.folder("0.001")), con, queries.SQL[name]) is None


def test_registered():
    numbers = {int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op") and n[2].isdigit()}
    assert numbers == set(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("place", range(4))
def test_stages_keep_odd_columns_and_rows(spark, odd, place):
    """Columns with every name that is used inside pass through a stage, and odd rows neither vanish nor crash."""
    folder = oracle.folder("0.001")
    given = spark.read.parquet(f"{folder}/documents.parquet")
    odd_rows = odd.select("doc_id", "text").withColumn("doc_id", -F.col("doc_id")) \
        .selectExpr("doc_id", "text", "'xx' as lang", "'s' as source", "cast(length(text) as bigint) as n_chars")
    docs = given.union(odd_rows).select("*", *[F.lit(77 + i).alias(n) for i, n in enumerate(OWN)])
    name, stage = corpus_pipeline.STAGES[place]
    out = stage(spark, docs, folder)
    assert out.columns == docs.columns, name
    first = out.select(*[F.col(f"`{n}`") for n in OWN]).distinct().collect()
    assert [tuple(r) for r in first] == [tuple(range(77, 77 + len(OWN)))], name
    assert out.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0, name
    assert stage(spark, docs.limit(0), folder).count() == 0
    assert stage(spark, given.select("doc_id", "text", "n_chars"), folder).columns == ["doc_id", "text", "n_chars"]


def test_last_stage_has_a_row_per_document(spark, odd):
    assert corpus_pipeline.STAGES[-1][1](spark, odd, "").count() == odd.count()


def test_run_removes_copies_and_passages(spark):
    folder = oracle.folder("0.001")
    found = {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()}
    texts = {r.doc_id: r.text for r in queries.table(spark, folder, "documents").collect()}
    kept = [texts[k] for k in found]
    assert 0 < len(found) < len(texts) and len(set(kept)) == len(kept)
    items = [r.text for r in queries.table(spark, folder, "benchmark").collect()]
    assert not any(i in t for i in items for t in kept)


def test_ids_outside_the_vocabulary_have_no_text(spark):
    rows = spark.createDataFrame([(1, [320]), (2, [-1]), (3, [320, 999_999]), (4, [None]), (5, []), (6, None), (None, [320])],
                                 "doc_id bigint, ids array<int>")
    found = {r.doc_id: r.decoded for r in bpe_codec.decode_ids(rows, queries.vocabulary("word_bpe_49k.json")).collect()}
    assert found[1] == found[None] and found[1] and (found[2], found[3], found[4], found[5], found[6]) == (None, None, None, "", "")
