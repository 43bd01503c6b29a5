"""Line dedup, substring dedup, n-gram Jaccard join and decontamination against brute force."""

from __future__ import annotations

import random

import pytest

from tests.llm import cases
from tickerwise.llm.common import Workspace, connected_components
from tickerwise.llm.decontaminate import contamination
from tickerwise.llm.jaccard import ngram_jaccard
from tickerwise.llm.lines import line_dedup
from tickerwise.llm.substring import lengths, substring_dedup

CONTAMINATION = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_line_dedup(spark):
    rows = cases.edge_docs()
    got = line_dedup(cases.doc_frame(spark), carry=["lang", "n"])
    assert cases.multiset(got.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()) == cases.lines_answer(rows)
    assert {cases.sha(r.kept_text) == r.kept_sha256 and (r.carry.lang, r.carry.n) == ("en", "n") for r in got.collect()} == {True}
    assert got.where("n_dropped > 0").count() > 10


def test_line_dedup_threshold_and_length(spark):
    rows = [(1, "a" * 20), (2, "a" * 20), (3, "é" * 20), (4, "É" * 20), (5, "b" * 19), (6, "b" * 19), (7, "b" * 19), (8, "a" * 20 + "\nz")]
    got = {r.doc_id: r.n_dropped for r in line_dedup(cases.doc_frame(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0, 8: 0}


@pytest.mark.parametrize("window,start", [(13, 7), (13, 13), (13, 3), (4, 1), (1, 1)])
def test_substring_dedup(spark, window, start):
    rows = cases.edge_docs()
    got = substring_dedup(cases.doc_frame(spark), window, start)
    assert cases.multiset(got.collect()) == cases.substring_answer(rows, window)


def test_levels_double():
    assert lengths(13, 7) == [7, 13] and lengths(50, 7) == [7, 14, 28, 50] and lengths(5, 9) == [5]


def test_substring_of_only_unique_texts_stops_early(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(40))) for i in range(5)]
    assert {r.n_removed for r in substring_dedup(cases.doc_frame(spark, rows)).collect()} == {0}


@pytest.mark.parametrize("n,num,den", [(3, 90, 100), (5, 80, 100), (1, 50, 100)])
def test_ngram_jaccard(spark, n, num, den):
    rows = cases.edge_docs()
    got = ngram_jaccard(cases.doc_frame(spark), n, num, den)
    assert cases.multiset(got.collect()) == cases.jaccard_answer(rows, n, num, den)


def test_jaccard_in_many_small_cells_and_stars(spark, monkeypatch):
    """A large clump that does not fit one cell, shingles with many holders, and chains of links."""
    from tickerwise.llm import jaccard
    monkeypatch.setattr(jaccard, "CELL", 4)
    monkeypatch.setattr(jaccard, "FEW", 3)
    rng = random.Random(3)
    words, rows = [f"w{i}" for i in range(200)], []
    for i in range(60):
        if i:
            words = list(words)
            words[rng.randrange(len(words))] = f"c{i}"
            if i % 7 == 0:
                words = words[:-6]
        rows.append((rng.randrange(10**6), " ".join(words)))
    got = ngram_jaccard(cases.doc_frame(spark, rows), 2, 90, 100)
    want = cases.jaccard_answer(rows, 2, 90, 100)
    assert cases.multiset(got.collect()) == want
    assert len({r[2] for r in want}) < 60


@pytest.mark.parametrize("tiers", [[(0, None), (5, 1.1)], [(0, None), (5, 1.6), (60, 1.2)], [(0, None), (20, 3.0), (100, 2.0)]])
def test_jaccard_with_sets_that_have_too_few_indexed_shingles(spark, monkeypatch, tiers):
    """A tiny indexed share leaves many sets short; they and the sizes beside them are indexed in full."""
    from tickerwise.llm import jaccard
    monkeypatch.setattr(jaccard, "TIERS", tiers)
    rows = cases.edge_docs()
    got = ngram_jaccard(cases.doc_frame(spark), 3, 90, 100)
    assert cases.multiset(got.collect()) == cases.jaccard_answer(rows, 3, 90, 100)


def test_jaccard_at_the_threshold(spark):
    """19 shared of 21 is 0.9048, 18 of 22 is 0.818: words as shingles, so that sizes are exact."""
    a = [f"t{i}" for i in range(20)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:19] + ["x"])), (3, " ".join(a[:18] + ["y", "z"])), (4, " ".join(a[:9])), (5, " ".join(a[:10]))]
    got = {r.doc_id: r.component_id for r in ngram_jaccard(cases.doc_frame(spark, rows), 1, 90, 100).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}


def test_contamination(spark):
    rows = cases.edge_docs()
    text = dict(rows)
    items = [(1, text[95][200:420]), (2, text[95][200:420] + " more"), (3, "one"), (4, "aa bb"), (5, None), (6, ""), (None, text[5]), (7, " ".join(text[200].split()[700:740])),
             (8, "never seen words of a benchmark item in this corpus at all really"), (9, "ünï cödé"), (1, "two words")]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as token", "1 as words")
    got = contamination(cases.doc_frame(spark), bench)
    assert cases.multiset(got.select(CONTAMINATION).collect()) == cases.contamination_answer(rows, items)
    for r in got.where("contaminated").collect():
        assert r.n_hit == len({p for s in r.spans for p in range(s.start, s.start + s.length)})


def test_contamination_bounds(spark):
    """A window is found at the very start and end of a document, never across two documents."""
    w = [f"q{i}" for i in range(12)]
    rows = [(1, " ".join(w[:10])), (2, "x " + " ".join(w)), (3, " ".join(w[:9])), (4, " ".join(w[5:])), (5, " ".join(w[:5])), (6, " ".join(w[5:]) + " y")]
    items = [(1, " ".join(w))]
    got = contamination(cases.doc_frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert cases.multiset(got.select(CONTAMINATION).collect()) == cases.contamination_answer(rows, items)


def test_empty_tables(spark):
    none = cases.doc_frame(spark).where("false")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert line_dedup(none).count() == substring_dedup(none).count() == ngram_jaccard(none).count() == 0
    assert contamination(none, bench).count() == 0
    got = contamination(cases.doc_frame(spark), bench)
    assert got.count() == len(cases.edge_docs()) and got.where("contaminated").count() == 0


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1100)] + [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(70)]
    edges += [(5, 5), (3000, 3000), (1, 0), (1, 0)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long"), Workspace(spark), "t").collect())
    linked = [(a, b) for a, b in edges if a != b]
    assert got == cases.components({x for e in linked for x in e}, linked)
    assert connected_components(spark.createDataFrame([], "a long, b long"), Workspace(spark), "t").count() == 0


def test_components_take_as_many_rounds_as_they_need(spark, monkeypatch):
    from tickerwise.llm import common
    monkeypatch.setattr(common, "range", lambda *a: [1], raising=False)  # no number of rounds is given beforehand
    got = dict(connected_components(spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long"), Workspace(spark), "r").collect())
    assert got == dict.fromkeys(range(41), 0)
