"""Collocations, prefix trie and secret scan against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tests.llm import cases
from tickerwise.llm import collocations as C
from tickerwise.llm import queries as Q
from tickerwise.llm import secrets as S
from tickerwise.llm import trie as T
from tickerwise.llm.common import Workspace

LONG_EXTRA = ["shard", "lo", "n", "m", "phrase", "rank", "depth", "k1", "node", "spans", "part", "pos"]


def clash(df):
    from pyspark.sql import functions as F
    for c in LONG_EXTRA:
        df = df.withColumn(c, F.lit(c))
    return df


# ---- collocations

def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", cases.ascii_lower(text or ""))]


def brute_collocations(rows, longest, at_least, absorb, top):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for p in pieces(text):
            n[lang] += len(p)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(p[i:i + m]) for i in range(len(p) - m + 1))
    out = []
    for lang, f in counts.items():
        f = {k: v for k, v in f.items() if v >= at_least}
        found = []
        for ws, a in f.items():
            if len(ws) < 2:
                continue
            longer = [v for k, v in f.items() if len(k) > len(ws) and any(k[i:i + len(ws)] == ws for i in range(len(k)))]
            if any(100 * v >= absorb * a for v in longer):
                continue
            score, k = min((1000 * a * n[lang] // (f[ws[:k]] * f[ws[k:]]), k) for k in range(1, len(ws)))
            left = sum(k[1:] == ws for k in f)
            right = sum(k[:-1] == ws for k in f)
            found.append((-score, -a, " ".join(ws).encode(), f[ws[:k]], f[ws[k:]], n[lang], left, right))
        for rank, (score, a, phrase, l, r, size, left, right) in enumerate(sorted(found)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, size, -score, left, right))
    return sorted(out)


def hostile_texts():
    rng = random.Random(3)
    words = ["The", "the", "of", "a\x00b", "naïve", "É", "x" * 300, " ", "und", "o'clock", "B"]
    rows = []
    for i in range(160):
        ws = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        rows.append(("".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r", "\x0b", "\x0c", "?!"]) for w in ws), rng.choice(["en", "en", "de", None, ""])))
    rows += [("a rose is a rose is a rose is a rose " * 40, "en"), ("same same " * 500, "en"), (None, "en"), ("", None), (" .\t,", "xx"), ("one. two", "yy")]
    rows += [("New York City is new york city, New York", "en")] * 30
    return rows


@pytest.mark.parametrize("shard,absorb,top", [(1 << 21, 100, 2000), (300, 100, 2000), (7, 80, 5), (300, 50, 2000)])
def test_collocations_equal_brute_force(spark, shard, absorb, top):
    rows = hostile_texts()
    df = clash(spark.createDataFrame(rows, "text string, lang string").repartition(4))
    got = [tuple(r) for r in C.collocations(df, longest=5, at_least=12, absorb=absorb, top=top, shard=shard).collect()]
    want = brute_collocations(rows, 5, 12, absorb, top)
    assert len(want) >= min(20, top) and sorted(got) == want


def test_collocations_of_other_depths_and_of_nothing(spark):
    rows = hostile_texts()
    df = spark.createDataFrame(rows, "text string, lang string")
    for longest in (2, 3, 6):
        assert sorted(tuple(r) for r in C.collocations(df, longest=longest, at_least=20).collect()) == brute_collocations(rows, longest, 20, 100, 2000)
    assert C.collocations(df.where("false")).count() == 0
    assert C.collocations(df.where("text is null or trim(text) = ''")).count() == 0


def test_intervals_grow_at_both_ends():
    rng = np.random.default_rng(1)
    text = np.concatenate([rng.integers(0, 5, 400), [0]]).astype(np.int32)
    fwd, mir = C.transform(text, 4), C.transform(text[::-1], 4)
    n = np.bincount(text, minlength=5)
    lo = np.cumsum(n) - n
    ids, size = np.arange(1, 5), n[1:]
    a, b = lo[1:], lo[1:]
    phrases = [(int(i),) for i in ids]
    doubled = np.concatenate([text, text]).tolist()
    for step in range(3):
        if step % 2 == 0:
            p, rest, b, a, size = C.grow(mir, b, a, size)
            phrases = [phrases[i] + phrases[j][-1:] for i, j in zip(p, rest)]
        else:
            p, rest, a, b, size = C.grow(fwd, a, b, size)
            phrases = [phrases[j][:1] + phrases[i] for i, j in zip(p, rest)]
        m = step + 2
        truth = Counter(tuple(doubled[i:i + m]) for i in range(len(text)))
        assert dict(zip(phrases, size.tolist())) == {k: v for k, v in truth.items() if 0 not in k}


# ---- prefix trie

def brute_rebuild(rows, every=5, heads=9):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [x[1:] for x in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % heads
        out[c] = convs.get(c - int(math.fmod(c, every)), [])[:h] + own[h:]
    return out


def brute_trie(convs):
    members, ends, last = defaultdict(list), defaultdict(list), {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            last[tuple(turns[:d])] = len(turns[d - 1][1].encode()) if d else 0
        ends[tuple(turns)].append(c)
    kids, leaves, saved = Counter(k[:-1] for k in members if k), Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * last[k]
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items())


def hostile_conversations():
    rng = random.Random(9)
    texts = ["", "hi", "hello", "é" * 7, "a:1:b", None]
    rows = []
    for c in [*range(-12, 60), 1000, 1003, 10**15]:
        for t in range(rng.randint(1, 14)):
            rows.append((c, rng.choice([t, t, t, 3, None]), rng.choice(["user", "assistant", None, ""]), rng.choice(texts[:2] if t < 4 else texts)))
    rows += [(200 + i, t, "user", "copy") for i in range(60) for t in range(6)]
    rows += [(300, t, "user", f"long {t % 3}") for t in range(700)] + [(301, t, "user", f"long {t % 3}") for t in range(650)]
    rows += [(None, 0, "user", "lost"), (None, None, None, None), (7, 2, "user", "x"), (7, 2, "user", "x"), (400, 0, "user", "z" * 300_000)]
    return rows


@pytest.mark.parametrize("band,queue", [(4096, 200_000), (3, 5), (5, 40)])
def test_trie_equals_brute_force(spark, band, queue):
    rows = hostile_conversations()
    df = clash(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5))
    work = Workspace(spark)
    convs, turns = T.spliced(T.ordered_turns(df, work), work)
    got = [tuple(r)[:-1] for r in T.prefix_trie(convs, turns, work, band=band, queue=queue).collect()]
    assert cases.multiset(got) == cases.multiset(brute_trie(brute_rebuild(rows)))


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    work = Workspace(spark)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    convs, turns = T.spliced(T.ordered_turns(empty, work), work)
    assert T.prefix_trie(convs, turns, work).count() == 0
    ids = spark.createDataFrame([(5,), (3,)], "conv_id long")
    row = T.prefix_trie(ids, T.ordered_turns(empty, work), work).drop("node").collect()
    assert [tuple(r) for r in row] == [(3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,5").hexdigest())]


def test_spilling_queue_keeps_the_order():
    rng, q, want = random.Random(2), T.SpillingQueue(limit=7), defaultdict(list)
    for i in range(500):
        k = (rng.randint(0, 20), rng.randint(0, 3))
        q.push((k, i, 1))
        want[k].append(i)
    for k in sorted(want):
        assert sorted(x[1] for x in q.pop_all(k)) == want[k]
    assert not q.heap and not q.runs


# ---- secrets

def brute_base(text):
    """The patterns as they are told, without any shortcut."""
    kinds = [("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), ("access", r"AKIA[A-Z0-9]+"), ("hex", r"[0-9a-f]+")]
    need, spans = {"assign": 8, "access": 16, "hex": 32}, []
    for k, (kind, pattern) in enumerate(kinds):
        for m in re.compile(pattern, re.A).finditer(text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= need[kind]:
                spans.append((m.start(), k, kind, m.end()))
    return [(kind, s, e) for s, _, kind, e in sorted(spans)]


def secret_docs():
    rng = random.Random(4)
    rnd = lambda n, a=string.ascii_letters + string.digits: "".join(rng.choice(a) for _ in range(n))
    rows = [f"password = '{rnd(12)}'", "PassWord:abc", f"token:token:{rnd(9)}", f"é\U0001f600 api_key=\"{rnd(30)}\" and API_KEY= {rnd(8)}", f"ſecret: {rnd(20)}",
            f"AKIA{rnd(11, string.ascii_uppercase)}", f"xAKIA{rnd(12, string.ascii_uppercase)}AKIAxAKIA{rnd(40, string.digits)}", "AKIAKIA" + rnd(12, string.digits),
            rnd(31, string.hexdigits.lower()), "g" + rnd(32, "0123456789abcdef") + "g", f"secret = {rnd(40, '0123456789abcdef')} x", "token" * 3000, "token=" * 3000, "", None,
            "secret" + " " * 5000, f"passwd\"  :  '{rnd(7)}", "a" * 100_000, rnd(200_000, "0123456789abcdef")]
    return [(i, t, None) for i, t in enumerate(rows)] + [(3, rows[3], "x"), (None, rows[0], "x")]


def test_base_spans_equal_the_patterns(spark):
    rows = secret_docs()
    got = S.scan_secrets(clash(spark.createDataFrame(rows, "doc_id long, text string, lang string"))).collect()
    want = []
    for doc, text, _ in rows:
        spans = brute_base(text)
        kinds = Counter(k for k, _, _ in spans)
        want.append((doc, kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()))
    assert cases.multiset(tuple(r)[:5] for r in got) == cases.multiset(want)
    for r in got:
        base = [f"{k}:{s}:{e}" for k, s, e in brute_base(next(t for d, t, _ in rows if d == r.doc_id))]
        assert [x for x in r.spans.split(",") if x and not x.startswith("novel")] == base


def test_novel_strings_in_sensitive_context(spark):
    rng = random.Random(8)
    rnd = lambda n: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
    prose = "the quick configuration of authorization headers and connection settings for every request handler " * 3
    code = "def connection_settings(request_handler):\n    authorization_headers = configuration\n"
    secret = [rnd(n - 1) + "7" for n in (24, 32, 48) for _ in range(20)]
    rows = [(i, f"{prose}\n{code}    Authorization: Bearer {s}\n{prose}") for i, s in enumerate(secret)]
    rows += [(100 + i, f"{prose}\nbuild id {s}\n{prose}") for i, s in enumerate(secret)]                                     # no sensitive context
    rows += [(200 + i, f"{prose}\nbearer connection_settings_request_handler_{i}\n{code}") for i in range(60)]              # made of identifiers
    rows += [(300, prose * 20), (301, f"auth {secret[0]}, auth {secret[0]}"), (302, "auth " + "ab1" * 50_000)]
    got = {r.doc_id: r for r in S.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = [r for i, r in got.items() if i < 100 and r.n_novel]
    assert len(found) >= 57
    for r in found:
        kind, start, end = r.spans.split(":")
        assert kind == "novel" and dict(rows)[r.doc_id][int(start):int(end)] == secret[r.doc_id]
    assert not any(r.n_novel for i, r in got.items() if 100 <= i <= 300 or i == 302) and got[301].n_novel == 2


def test_secret_scan_of_the_table_and_of_nothing(spark):
    rows = Q.QUERIES["op13_secret_scan"](spark, SF_SMALL).collect()
    texts = dict(duckdb.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet'").fetchall())
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        spans = brute_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, _, _ in spans) for x in ("assign", "access", "hex"))
    assert S.scan_secrets(spark.createDataFrame([], "doc_id long, text string")).count() == 0
