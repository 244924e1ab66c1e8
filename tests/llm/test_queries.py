"""Registered text queries against their SQL, and the pipeline's stages."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from touchline.llm.common import staged, table
from touchline.llm.oracle import ORACLE
from touchline.llm.queries import QUERIES


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    got = compare.spark_rows(QUERIES[name](spark, sf_dir))
    con = compare.connect(sf_dir)
    want = compare.duckdb_rows(con, ORACLE[name])
    con.close()
    assert got == want


def test_pipeline_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, before = docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
        assert docs.columns == columns, name
        ids = [r[0] for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= before
        before = set(ids)
    assert before
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    rows = mixed.collect()
    assert {r["doc_id"] for r in rows} <= before
    assert [r["mix_position"] for r in rows] == sorted(r["mix_position"] for r in rows)


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stage_keeps_clashing_columns(spark, sf_dir, stage, docs_of, words):
    rows = [(i, " ".join(words(30, i)), "s", "mix_position") for i in range(20)] + [(None, None, None, "x"), (50, "", None, "x")]
    docs = docs_of(rows)
    out = stage(spark, docs, sf_dir)
    assert out.columns[: len(docs.columns)] == docs.columns
    assert 1 <= out.count() <= 2 * len(rows)
    assert stage(spark, docs.limit(0), sf_dir).count() == 0
