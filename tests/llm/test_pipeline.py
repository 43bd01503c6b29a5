"""The registered queries against their SQL twins, and the pipeline stage by stage against brute force."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from tests.conftest import SF_SMALL
from tests.llm import cases
from tickerwise.llm import queries as Q
from tickerwise.llm.common import Workspace, read
from tools.oracle_check import TABLES, close, rows_of


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_all_queries_are_registered():
    names = set(E.queries())
    assert {n.split("_")[0] for n in Q.QUERIES} == {f"op{i}" for i in range(1, 14)} and set(Q.QUERIES) | {"pipeline"} <= names
    assert set(Q.ORACLE_SQL) <= set(E.oracle_sql())
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "ngram_jaccard", "decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_query_equals_its_sql_twin(spark, con, name):
    got = Q.QUERIES[name](spark, SF_SMALL).toArrow()
    want = con.sql(Q.ORACLE_SQL[name]).arrow()
    want = want.read_all() if hasattr(want, "read_all") else want
    assert sorted(got.column_names) == sorted(want.column_names)
    a, b = rows_of(got), rows_of(want)
    assert len(a) == len(b) > 0 and all(close(x, y) for x, y in zip(a, b))


@pytest.mark.parametrize("name", ["op1_language_id", "op4_packing", "op5_sharding", "op9_nearest"])
def test_query_covers_its_whole_table(spark, name):
    rows = Q.QUERIES[name](spark, SF_SMALL).collect()
    docs, pages, vectors = (read(spark, SF_SMALL, t).count() for t in ("documents", "pages", "embeddings"))
    if name == "op1_language_id":
        assert len(rows) == docs + pages and len({r.doc_id for r in rows if r.doc_id is not None}) == docs
    elif name == "op4_packing":
        assert len({r.doc_id for r in rows}) == docs
        per_doc: dict = {}
        for r in rows:
            per_doc[r.doc_id] = per_doc.get(r.doc_id, 0) + r.length
        assert all(per_doc[r.doc_id] == r.doc_tokens for r in rows)
    elif name == "op5_sharding":
        assert len(rows) == docs
    else:
        assert len(rows) == 10 * len({i for i in range(0, vectors, 100)})


def stage(spark, k, docs):
    work = Workspace(spark)
    return work.table(P.STAGES[k][1](spark, docs, SF_SMALL), "out")


def edge(spark):
    return cases.doc_frame(spark, clash=False)


def test_language_stage_rejects_only_texts_without_a_language(spark):
    both = read(spark, SF_SMALL, "documents").select(P.COLUMNS).unionByName(edge(spark).selectExpr("doc_id + 100000 as doc_id", "text", "lang", "source", "cast(n_chars as bigint) n_chars"))
    out = stage(spark, 0, both)
    assert out.columns == P.COLUMNS
    gone = {r.doc_id for r in both.join(out, ["doc_id", "text"], "left_anti").select("doc_id").collect()}
    assert gone >= {100000 + i for i in (111, 112, 113)} and all(i is None or i >= 100000 for i in gone)
    long = both.where("n_chars >= 40 and doc_id is not null")
    assert long.exceptAll(out).where("doc_id < 100000").count() == 0


def test_line_stage(spark):
    rows = cases.edge_docs()
    got = stage(spark, 1, edge(spark))
    assert got.columns == P.COLUMNS and got.schema["n_chars"].dataType == edge(spark).schema["n_chars"].dataType
    want = sorted(((i, d) for i, _, _, d in cases.lines_answer(rows)), key=repr)
    assert sorted(((r.doc_id, cases.sha(r.text)) for r in got.collect()), key=repr) == want
    assert all(r.n_chars == len(r.text) for r in got.collect())


def test_near_copy_stage_keeps_one_of_each_group(spark):
    rows = cases.edge_docs()
    got = stage(spark, 2, edge(spark))
    comp = {i: c for i, _, c in cases.jaccard_answer(rows, 5, 80, 100) if i is not None}
    assert got.columns == P.COLUMNS
    assert sorted((r.doc_id for r in got.collect()), key=repr) == sorted([i for i, c in comp.items() if i == c] + [None] * 3, key=repr)


def test_decontamination_stage(spark):
    items = [(r.item_id, r.text) for r in read(spark, SF_SMALL, "benchmark").collect()]
    planted = edge(spark).unionByName(spark.createDataFrame([(500, "before " + items[0][1] + " after", "en", "s", 1), (None, items[1][1], "en", "s", 1)], cases.DOC_SCHEMA))
    rows = [(r.doc_id, r.text) for r in planted.collect()]
    got = stage(spark, 3, planted)
    clean = [r[0] for r in cases.contamination_answer(rows, items) if not r[5]]
    assert sorted((r.doc_id for r in got.collect()), key=repr) == sorted(clean, key=repr) and 500 not in clean


def test_pipeline_runs_and_every_stage_takes_what_the_last_kept(spark):
    docs = read(spark, SF_SMALL, "documents")
    sizes = [docs.count()]
    for k in range(4):
        docs = stage(spark, k, docs)
        assert docs.columns == P.COLUMNS
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[3] < sizes[2]
    kept = {r.doc_id for r in docs.collect()}
    out = E.queries()["pipeline"](spark, SF_SMALL).collect()
    assert {r.doc_id for r in out} == kept


def test_pipeline_on_an_empty_table(spark):
    docs = edge(spark).where("false")
    for k in range(5):
        assert stage(spark, k, docs).count() == 0
