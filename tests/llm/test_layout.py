"""Packing, sharding, WARC derivatives and chat formatting: round trips and brute force."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from tickerwise.llm import warc
from tickerwise.llm.chat import chat_digests, escape, format_chats, loss_texts, unescape
from tickerwise.llm.packing import Levels, encoder, pack
from tickerwise.llm.queries import PROBE, tokenizer_path
from tickerwise.llm.sharding import capacity_and_cuts, shard_by_bytes

# ---- packing


def ids_of(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_encoder_equals_the_tokenizer():
    texts = ["", "Hello, World! it's  we'll 12 345\t\n x", "ÀÉ ́a é \U0001f600‍\U0001f600 İ ΣΑΣ ΟΔΟΣ.", "a b c\u0085d\x1ce", "<|endoftext|> x<|startoftext|>y",
             "̧́ q", "don't'll's", "x" * 3000, "한국어 テスト 中文。", "ﬁ ½ ²", "a\x00b", "क्ष क्षि"] + [t for _, t in cases.edge_docs()[:60] if t]
    texts += ["it's ''s 's's &&&'s 'LL 'Re", "a1b22²½ªº µß Ÿ ÿ Ǆ ǅ Ⱥ Ɱ", "x\u00a0y\u00ady\x1cz\x7f\u0085", "ŉ ſ ẞ ß", "".join(map(chr, range(0x21, 0x250))),
              " ".join(map(chr, range(0x21, 0x250))), "\u0130x", "_a_ __ a_b-c", "<|endoftext", "w" * 70 + " " + "&" * 70 + "9" * 70]
    encode = encoder(tokenizer_path())
    for _ in range(2):  # the second time from the cache
        assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == ids_of(texts)


def test_every_capital_inside_a_plain_word():
    capitals = [chr(c) for c in range(0x250) if chr(c).lower() != chr(c)]
    texts = [w for c in capitals for w in (f"az{c}rbaycan", f"{c}li", f"kasa {c}an", c)] + ["AZ\u018fRBAYCAN", "\u0190nd, \u0186kyena's \u023a1"]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder(tokenizer_path())(texts)] == ids_of(texts)


@pytest.mark.parametrize("window,max_gap,max_open", [(4096, 32, 1024), (64, 2, 1024), (64, 0, 3), (16, 1, 1)])
def test_packing_round_trip(spark, window, max_gap, max_open):
    rows = cases.edge_docs()
    got = pack(cases.doc_frame(spark), tokenizer_path(), window, 2, max_gap, max_open, with_ids=True).collect()
    # every id lies in exactly one piece
    pieces: dict = {}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length > 0 and zlib.crc32(r.ids) == r.ids_crc32
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, ids.tolist()))
    want: dict = {}
    for (i, _), ids in zip(rows, ids_of([t for _, t in rows])):
        want.setdefault((i, len(ids) + 1), []).append(ids + [2])
    assert set(pieces) == set(want)
    for k, parts in pieces.items():
        if len(want[k]) == 1:
            assert [x for _, p in sorted(parts) for x in p] == want[k][0]
        assert sum(len(p) for _, p in parts) == sum(len(x) for x in want[k])
    # sequences are gapless, within the window, and padded unless a power of two
    seqs: dict = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_tokens, r.sequence_length))
    for parts in seqs.values():
        at = 0
        for offset, length, used, padded in sorted(parts):
            assert offset == at
            at += length
        assert {(u, p) for _, _, u, p in parts} == {(at, padded)} and at <= padded <= window
        assert padded == window or (at == padded and at & (at - 1) == 0)
    waste = sum(p[0][3] - p[0][2] for p in seqs.values())
    assert waste <= (max_gap + 1) * len(seqs)


def test_level_choice_is_the_smallest_sum_of_squares():
    rng, window = random.Random(2), 12
    levels = Levels(window)
    for _ in range(400):
        size = rng.randint(1, window - 1)
        before = levels.count.copy()

        def cost(h):
            n = before.astype(object).copy()
            if h:
                n[h] -= 1
            if h + size < window:
                n[h + size] += 1
            return sum(x * x for x in n)
        options = [0] + [h for h in range(1, window - size + 1) if before[h]]
        best = min(cost(h) for h in options)
        full = levels.place(size, (None, 0, b"0000" * size, size))
        after = levels.count
        assert sum(int(x) ** 2 for x in after) == best
        assert levels.open == sum(after) == sum(len(x) for x in levels.at)
        if full:
            assert sum(len(p[2]) // 4 for p in full) == window


# ---- sharding


def minimax(sizes: list[int], shards: int) -> int:
    def parts(c):
        n, used = 1, 0
        for s in sizes:
            if used + s > c:
                n, used = n + 1, 0
            used += s
        return n
    return next(c for c in range(max(sizes), sum(sizes) + 1) if parts(c) <= shards)


def test_sharding(spark):
    rows = cases.edge_docs()
    got = shard_by_bytes(cases.doc_frame(spark), 5).collect()
    assert cases.multiset((r.doc_id, r.size, r.text_crc32) for r in got) == cases.multiset(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)} and {r.shard for r in got} <= set(range(5))
    home: dict = {}
    for r in got:
        home.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    assert {len(x) for x in home.values()} == {1}  # equal texts together
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


@pytest.mark.parametrize("hot", [1, 40])
def test_sharding_capacity_is_the_optimum(spark, hot):
    rng = random.Random(hot)
    rows = [(k, "t%d " % rng.randrange(10**6) * rng.randint(1, 30)) for k in range(300)] + [(1000 + k, "hot text " * 20) for k in range(hot)]
    df = cases.doc_frame(spark, rows, clash=False)
    table = df.select(F.xxhash64("text").alias("h"), (F.octet_length("text") + 8).cast("long").alias("size")).cache()
    groups: dict = {}
    for r in table.collect():
        groups[r.h] = groups.get(r.h, 0) + r.size
    sizes = [groups[h] for h in sorted(groups)]
    for shards in (2, 7, 24):
        capacity, cuts = capacity_and_cuts(table, shards)
        assert capacity == minimax(sizes, shards) and len(cuts) <= shards - 1 and cuts == sorted(cuts)
        total: dict = {}
        for r in shard_by_bytes(df, shards).collect():
            total[r.shard] = total.get(r.shard, 0) + r.size
        assert max(total.values()) <= capacity
    table.unpersist()


def test_sharding_is_refined_where_hashes_are_close(spark):
    """Sizes in a table whose hashes share their leading bits: the first cells hold everything."""
    rng = random.Random(9)
    groups = {(5 << 40) + k * 3: rng.randint(1, 500) for k in range(500)}
    table = spark.createDataFrame(list(groups.items()), "h long, size long")
    capacity, cuts = capacity_and_cuts(table, 6)
    assert capacity == minimax([groups[h] for h in sorted(groups)], 6) and len(cuts) == 5


def test_layout_of_empty_tables(spark):
    none = cases.doc_frame(spark).where("false")
    assert pack(none, tokenizer_path()).count() == 0 and shard_by_bytes(none).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.derivatives(warc.responses(pages)).count() == 0
    assert format_chats(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0

# ---- WARC


PAGES = [(1, "http://a.example.org/x?y=1", "<!DOCTYPE html><html lang=en><head><title>T &amp; t</title><style>p{}</style><script>var x='</p>';</script></head>"
          "<body><!-- no --><h1>Head</h1><p>One<b>two</b>  three<br>four &lt;x&gt;</p></body></html>"), (2, None, None), (None, "u\r\nX-Bad: 1", ""), (3, "u", "plain"), (3, "u", "plain")]


def test_warc_records(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' as kind", "'y' as block")
    source = warc.responses(pages)
    got = warc.derivatives(source).collect()
    assert len(got) == 2 * len(PAGES)
    ids = {r.record_id for r in source.collect()}
    for r in got:
        head, block = r.record.split("\r\n\r\n", 1)
        fields = dict(x.split(": ", 1) for x in head.split("\r\n")[1:])
        assert head.startswith("WARC/1.1\r\n") and block == r.block
        assert int(fields["Content-Length"]) == len(r.block.encode()) == r.content_length
        assert fields["WARC-Block-Digest"] == "sha256:" + cases.sha(r.block) and fields["WARC-Refers-To"] == r.refers_to in ids
        assert len(fields) == 9
        mates = [x for x in got if x.record_id == r.concurrent_to]
        assert mates and all(x.concurrent_to == r.record_id and x.kind != r.kind and x.refers_to == r.refers_to for x in mates)
        if r.kind == "metadata":
            payload = next(p or "" for i, u, p in PAGES if i == r.page_id)
            assert f"source-digest: sha256:{cases.sha(payload)}\r\n" in r.block and "source-header: Content-Type: text/html" in r.block
    text = {r.page_id: r.block for r in got if r.kind == "conversion"}
    assert text[1] == "T & t\nHead\nOnetwo three\nfour <x>" and text[2] == "" and text[3] == "plain"
    warc.write_warc(warc.derivatives(source), str(tmp_path / "out"))
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    at, seen = 0, 0
    while at < len(data):  # read the files back by their lengths
        end = data.index(b"\r\n\r\n", at)
        size = int(data[at:end].decode().split("Content-Length: ")[1].split("\r\n")[0])
        assert data[end + 4 + size:end + 8 + size] == b"\r\n\r\n"
        at, seen = end + 8 + size, seen + 1
    assert seen == len(got)


def test_every_character_reference_is_decoded(spark):
    import html
    texts = [f"a&{n}z &{n} 1" for n in html.entities.html5] + [f"a&#{i};b&#x{i:X};&#{i} &#X{i:x}z" for i in (*range(0x250), 8217, 0xD800, 0x1F600, 0x10FFFF, 0x110000, 99999999)]
    texts += ["&amp;copy; &amp;#8217;", "R&D & co &unknown; &# &#x; &#xg; &;", "x", "&" * 50]
    space = lambda t: "\n".join(x for x in (" ".join(y for y in re.split("[ \t\r\f]+", v) if y) for v in t.split("\n")) if x)
    want = [space(html.unescape(t).replace("\xa0", " ")) for t in texts]
    texts += ["&#" + "0" * 5000 + "169;&#" + "9" * 5000 + ";"]
    pages = spark.createDataFrame([(i, "u", t) for i, t in enumerate(texts)], "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.derivatives(warc.responses(pages)).where("kind = 'conversion'").collect()}
    assert [got[i].block for i in range(len(texts))] == want + ["\u00a9\ufffd"]
    assert all(r.content_length == len(r.block.encode()) and r.block_digest == "sha256:" + cases.sha(r.block) for r in got.values())

# ---- chat


NASTY = [PROBE, "", " ", "[INST]", "[/INST]", " [/INST]", "a [/INST] b", "</s>", " </s>", "~", "~1", "~01", "x ~0[INST]~2 </s> <s> y", "<<SYS>> a <</SYS>>", "[TURN user] b [/TURN]",
         "line\nline", "[IN[INST]ST]", "é\U0001f600", None, "[INST] a [INST] b", "<s", "0\n", "1\n", "]", "$1 \\1 \\E"]


def chat_rows():
    rng = random.Random(4)
    rows = []
    for c in range(120):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant", "assistant", "system", "tool", "a]b", "", None, "[INST]"]), rng.choice(NASTY + ["plain text"] * 10)))
    for i, x in enumerate(NASTY):
        rows += [(1000 + i, 0, "user", x), (1000 + i, 1, "assistant", x)]
    rows += [(None, 1, "user", "p"), (None, 0, "assistant", "q"), (2000, None, "user", "late"), (2000, 0, "user", "tie b"), (2000, 0, "user", "tie a"), (2001, 0, "user", "same"), (2001, 0, "user", "same")]
    rows.append((2002, 0, "assistant", "long " * 50_000 + "</s> tail"))
    return rows


def test_chat_round_trip(spark):
    rows = chat_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr("*", "1 as turns", "'x' as source", "'y' as formatted")
    chats = format_chats(df)
    want: dict = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    got = {r.conv_id: r for r in chats.select("*", loss_texts(chats).alias("loss")).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        turns = [x[1:] for x in sorted(turns)]
        assert [tuple(t) for t in got[c].turns] == turns and got[c].round_trip
        assert got[c].loss == [x for role, x in turns if role == "assistant"]
    assert 0 < sum(r.escaped for r in got.values()) < len(got)
    for r in chat_digests(chats).collect():
        turns = [x[1:] for x in sorted(want[r.conv_id])]
        loss = "".join(x for role, x in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), cases.sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r.loss_chars, r.loss_sha256, r.formatted_chars) == (len(loss), cases.sha(loss), len(got[r.conv_id].formatted))


def test_chat_escapes_only_where_needed(spark):
    rows = [(1, 0, "user", "a [INST] b"), (1, 1, "assistant", "c"), (2, 0, "user", "a [/INST] b"), (3, 0, "user", "plain ~1")]
    got = {r.conv_id: r.escaped for r in format_chats(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()}
    assert got == {1: False, 2: True, 3: False}


def test_escape_is_reversible(spark):
    df = spark.createDataFrame([(x or "",) for x in NASTY], "t string")
    controls = ["[INST]", "</s>", "]"]
    out = df.select("t", escape(F.col("t"), controls).alias("e")).select("t", "e", unescape(F.col("e"), controls).alias("b")).collect()
    assert all(r.t == r.b and not any(c in r.e for c in controls) for r in out)
