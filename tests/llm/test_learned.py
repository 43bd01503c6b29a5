"""Nearest neighbours (recall against brute force) and language ID (held-out accuracy)."""

from __future__ import annotations

import math
import random
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm import cases
from tickerwise.llm import langid
from tickerwise.llm.common import Workspace, read
from tickerwise.llm.nearest import nearest

SF_MORE = SF_SMALL.replace("0.001", "0.1")


def brute(rows, queries, k):
    ids, v = np.array([i for i, _ in rows]), np.array([x for _, x in rows], float)
    out = {}
    for q, x in queries:
        d = np.sqrt(((v - np.array(x, float)) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def answers(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert all([x[0] for x in sorted(v)] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [x[1:] for x in sorted(v)] for q, v in out.items()}


def test_recall(spark):
    df = read(spark, SF_MORE, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    queries = [x for x in rows if x[0] % 20 == 0]
    want, got = brute(rows, queries, 10), answers(nearest(df, df.where("vec_id % 20 = 0"), 10))
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.9
    true = dict(rows)
    for q, found in got.items():
        for i, s in found:
            assert math.isclose(s, math.dist(true[q], true[i]), rel_tol=1e-12)
        assert found == sorted(found, key=lambda x: (x[1], x[0]))


def test_unfit_vectors_ties_and_few_candidates(spark):
    bad = [(100, None), (101, []), (102, [0.0, 0.0]), (103, [1.0, None]), (104, [float("nan"), 1.0]), (105, [float("inf"), 1.0]), (106, [1.0]), (None, [1.0, 1.0])]
    good = [(0, [1.0, 0.0]), (9, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [1.0, 1.0]), (3, [2.0, 0.0]), (3, [2.0, 0.0]), (4, [1.0, -1.0])]
    df = spark.createDataFrame(bad + good, "vec_id long, embedding array<float>").selectExpr("*", "1 as list", "'x' as v", "2 as q", "3 as rank")
    got = answers(nearest(df, df.where("vec_id in (0, 100, 102)"), 10))
    assert got == {0: [(3, 1.0), (4, 1.0), (7, 1.0), (8, 1.0), (9, 1.0)]}
    assert nearest(df.where("false"), df, 10).count() == 0 and nearest(df, df.where("false"), 10).count() == 0


def test_many_equal_vectors_are_cut_into_blocks(spark, monkeypatch):
    from tickerwise.llm import nearest as module
    monkeypatch.setattr(module, "BLOCK", 50)
    monkeypatch.setattr(module, "QUERIES", 7)
    rng = np.random.default_rng(1)
    rows = [(i, [0.5] * 8) for i in range(400)] + [(1000 + i, rng.standard_normal(8).tolist()) for i in range(300)]
    df = spark.createDataFrame([(int(i), v) for i, v in rows], "vec_id long, embedding array<double>").repartition(4)
    queries = [x for x in rows if x[0] % 20 == 0]
    want, got = brute(rows, queries, 10), answers(nearest(df, df.where("vec_id % 20 = 0"), 10))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.9
    assert [i for i, _ in got[0]] == list(range(1, 11)) and [i for i, _ in got[380]] == list(range(10))


def test_copies_of_a_lone_query_are_never_abandoned():
    from tickerwise.llm.nearest import _scan
    rng = np.random.default_rng(5)
    rotation = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    for scale in (1.0, 1000.0):
        v = (scale * rng.standard_normal(64)).tolist()
        left = pa.table({"vec_id": pa.array(range(2048), pa.int64()), "v": pa.array([v] * 2048, pa.list_(pa.float64()))})
        right = pa.table({"query_id": pa.array([2000], pa.int64()), "q": pa.array([v], pa.list_(pa.float64())), "radius": pa.array([0.0])})
        got = _scan(rotation, 10)((0, 0, 0), left, right)
        assert got["vec_id"].to_pylist() == list(range(10)) and got["score"].to_pylist() == [0.0] * 10


def items(spark, rows):
    """(id, text, declared, host, domain, suffix) -> evidence rows"""
    df = spark.createDataFrame(rows, "id long, text string, declared string, host string, domain string, suffix string")
    return df.select(F.struct("id").alias("key"), "text", "declared", "host", "domain", "suffix")


def test_held_out_accuracy_by_text_alone(spark):
    docs = read(spark, SF_MORE, "documents").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(5)))
    languages, logp = langid.train(docs.where("part > 0"))
    assert set(languages) == {"en", "de", "fr", "es"}
    none = F.lit(None).cast("string")
    test = docs.where("part = 0 and n_chars >= 30").select(F.struct("doc_id", "lang").alias("key"), "text", none.alias("declared"), none.alias("host"),
                                                         none.alias("domain"), none.alias("suffix"))
    got = langid.identify(test, languages, logp, Workspace(spark)).selectExpr("key.lang = language as ok", "posterior").collect()
    assert len(got) > 1000 and sum(r.ok for r in got) / len(got) >= 0.97


def test_pages(spark):
    docs, pages = read(spark, SF_SMALL, "documents"), read(spark, SF_SMALL, "pages")
    languages, logp = langid.train(docs)
    found = langid.page_items(pages)
    urls = {r.page_id: (urlparse(r.url).hostname, r.html.split('lang="')[1][:2]) for r in pages.collect()}
    for r in found.collect():
        host, lang = urls[r.key.page_id]
        assert (r.declared, r.host, r.domain, r.suffix) == (lang, host, ".".join(host.split(".")[-2:]), host.split(".")[-1])
        assert "<p" not in r.text and "track(" not in r.text
    got = langid.identify(found, languages, logp, Workspace(spark))
    right = got.join(pages, F.col("key.page_id") == pages["page_id"]).selectExpr("avg(cast(regexp_extract(html, 'lang=\"([a-z]+)\"', 1) = language as int)) as a").first().a
    assert got.count() == pages.count() and right >= 0.95


def test_each_evidence_moves_an_ambiguous_text(spark):
    rng = random.Random(0)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(6))
    labelled = spark.createDataFrame([(" ".join(word("abcdmn") for _ in range(30)), "xx") for _ in range(40)]
                                     + [(" ".join(word("uvwymn") for _ in range(30)), "yy") for _ in range(40)], "text string, lang string")
    languages, logp = langid.train(labelled)
    train = [(i, r.text, r.lang, f"h{r.lang}.d{r.lang}.s{r.lang}", f"d{r.lang}.s{r.lang}", f"s{r.lang}") for i, r in enumerate(labelled.collect())]
    same = "mn nm mnm"  # the same letters in either language
    probes = [(100, same, "xx", None, None, None), (101, same, "yy", None, None, None), (102, same, None, None, None, "sxx"), (103, same, None, None, None, "syy"),
              (104, same, None, "hxx.dxx.sxx", None, None), (105, same, None, "hyy.dyy.syy", None, None),
              (106, same, None, "new.dxx.sxx", "dxx.sxx", None), (107, same, None, "new.dyy.syy", "dyy.syy", None),
              (108, "1234 !!", "xx", "hxx.dxx.sxx", None, "sxx"), (109, None, "xx", None, None, None), (110, "", None, None, None, None), (111, train[0][1], "yy", None, None, None),
              (112, "qq", "never seen", "h", "d", "s"), (112, "qq", "never seen", "h", "d", "s"), (113, "a" * 100_000, None, None, None, None)]
    got = {r.key.id: r for r in langid.identify(items(spark, train + probes), languages, logp, Workspace(spark)).collect()}
    for i in range(100, 108):
        assert got[i].language == ("xx", "yy")[i % 2], i
        assert 0.5 < got[i].posterior <= 1
    assert {got[i].language for i in (108, 109, 110, 112)} == {"und"} and {got[i].posterior for i in (108, 109, 110)} == {0.0}
    assert got[111].language == "xx" and got[113].language == "xx"
    assert all(got[i].language == train[i][2] for i in range(80))


def test_every_declared_language_is_modelled(spark):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = {f"l{i:02d}": [rng.sample(letters, 3) for _ in range(5)] for i in range(150)}
    text = lambda lang: " ".join("".join(rng.choice(own[lang])) for _ in range(40))
    labelled = [(text(lang), lang) for i, lang in enumerate(own) for _ in range(2 + (150 - i) // 30)]
    languages, logp = langid.train(spark.createDataFrame(labelled, "text string, lang string").repartition(3))
    assert sorted(languages) == sorted(own) and len(logp) == 3
    rows = items(spark, [(i, text(lang), None, None, None, None) for i, lang in enumerate(own)])
    got = {r.key.id: r for r in langid.identify(rows, languages, logp, Workspace(spark)).collect()}
    assert len(got) == 150 and sum(got[i].language == got[i].text_language == lang for i, lang in enumerate(own)) >= 148


def test_language_id_without_labels_or_rows(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    languages, logp = langid.train(empty)
    assert languages == []
    rows = items(spark, [(1, "some text here", "en", None, None, None)])
    assert [r.language for r in langid.identify(rows, languages, logp, Workspace(spark)).collect()] == ["und"]
    languages, logp = langid.train(read(spark, SF_SMALL, "documents"))
    assert langid.identify(rows.where("false"), languages, logp, Workspace(spark)).count() == 0
    edge = langid.document_items(cases.doc_frame(spark))
    got = langid.identify(edge, languages, logp, Workspace(spark))
    assert got.count() == len(cases.edge_docs())
    assert {r.key.doc_id for r in got.where("language = 'und'").collect()} >= {110, 111, 112, 113}
