"""The registered llm queries against their oracles, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from tools.compare import compare
from weblake.llm import queries
from weblake.session import stage

from . import helpers as H

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    import __spark_entry__ as E
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    assert compare(spark, SF, [name], verbose=False)[name][0] == "match"


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    seen = []
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF), name)
        seen.append(docs)
        sizes.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    rows = [[(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()] for d in seen[:4]]
    components = {c for _, _, c in H.jaccard_components(rows[0])}
    assert {d for d, _ in rows[1]} == components and len(rows[1]) == len(components)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {d for d, t in rows[1] for n, hit, _ in [H.contamination(t, items)] if not (hit > 0 and 20 * hit >= n)}
    assert {d for d, _ in rows[2]} == clean
    assert {d for d, _ in rows[3]} <= clean
    ids = seen[4].orderBy("start").collect()
    assert sorted(r.doc_id for r in ids) == sorted(d for d, _ in rows[3])
    at = 0
    for r in ids:
        assert r.start == at
        at += r.n_tokens
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3]
    again = {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()}
    assert again == {tuple(r) for r in ids}


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF), name)
        assert docs.count() == 0, name
