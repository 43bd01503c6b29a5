"""Benchmark decontamination: a prefix-filtered containment join of item windows against documents.

An item's windows are its runs of ``window`` words (a shorter item is one window).  A window's tokens are its shingles of
up to five words.  A document contains a window only if it holds all its tokens, so one token is a sufficient prefix: the
rarest in the documents, which is counted first.  Documents are joined with these prefix tokens only; a match at word p of a
token at offset j can only be the window from p - j, which must lie inside the document (positional and length bounds), and the
words there are then compared exactly.

Document shingles that no benchmark shingle can equal are dropped by a Bloom filter of fixed size while the texts
are read, whatever the size of the benchmark; a fuller filter lets more through but loses nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerwise.llm.common import Workspace
from tickerwise.llm.words import Chunk, chunks, mix

BLOOM_BITS, BLOOM_HASHES, TOKEN_WORDS = 24, 3, 5
_SEEDS = [np.uint64(x) for x in (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F)]


def _bits(token: np.ndarray) -> list[np.ndarray]:
    return [(mix(token ^ s) >> np.uint64(64 - BLOOM_BITS)).astype(np.int64) for s in _SEEDS[:BLOOM_HASHES]]


def _tokens(c: Chunk, n: int) -> tuple[np.ndarray, np.ndarray]:
    sh, fits = c.shingles(c.word_hash, n)
    return sh ^ np.uint64(n), fits


def _windows(window: int):
    """(item_id, text) -> a row per distinct window: its words, the length of its tokens and the tokens by offset."""
    def run(batches):
        for b in batches:
            rows = []
            for c in chunks(b.column(1), "alnum", True):
                c.word_hash = c.hashes()
                by_length = {n: _tokens(c, n)[0] for n in range(1, TOKEN_WORDS + 1)}
                for r in range(c.hi - c.lo):
                    words, first, seen = [w.decode() for w in c.word_bytes(r)], int(c.bound[r]), set()
                    size = min(window, len(words))
                    for i in range(len(words) - size + 1 if words else 0):
                        mine = tuple(words[i:i + size])
                        if mine not in seen:
                            seen.add(mine)
                            n = min(TOKEN_WORDS, size)
                            rows.append((b.column(0)[c.lo + r].as_py(), list(mine), n, by_length[n][first + i:first + i + size - n + 1].view(np.int64)))
            yield pa.record_batch([pa.array([x[0] for x in rows], b.column(0).type), pa.array([x[1] for x in rows], pa.list_(pa.string())),
                                   pa.array([x[2] for x in rows], pa.int32()), pa.array([x[3] for x in rows], pa.list_(pa.int64()))],
                                  names=["item_id", "words", "n", "tokens"])
    return run


def _filter(windows: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The Bloom filter of all window tokens (2 MB at any size) and the token lengths that occur (at most five)."""
    def build(batches):
        total = np.zeros(1 << (BLOOM_BITS - 3), np.uint8)
        for b in batches:
            for at in _bits(b.column(0).to_numpy().view(np.uint64)):
                np.bitwise_or.at(total, at >> 3, (1 << (at & 7)).astype(np.uint8))
        if total.any():
            yield pa.record_batch({"bits": pa.array([total.tobytes()], pa.binary())})

    def join(batches):
        total = None
        for b in batches:
            for x in b.column(0):
                part = np.frombuffer(x.as_buffer(), np.uint8)
                total = part.copy() if total is None else total | part
        if total is not None:
            yield pa.record_batch({"bits": pa.array([total.tobytes()], pa.binary())})

    parts = windows.select(F.explode("tokens").alias("t")).mapInArrow(build, "bits binary")
    got = parts.coalesce(8).mapInArrow(join, "bits binary").collect()  # at most eight filters reach the driver
    out = np.zeros(1 << (BLOOM_BITS - 3), np.uint8)
    for r in got:
        out |= np.frombuffer(r["bits"], np.uint8)
    return out, sorted(r["n"] for r in windows.select("n").distinct().collect())


def _matches(window: int, bits: np.ndarray, lengths: list[int]):
    """(row, doc_id, text, mark) -> words and, for each shingle that passes the filter, its position and the words around it."""
    def run(batches):
        for b in batches:
            count, hits = [], []
            for c in chunks(b.column(2), "alnum", True):
                c.word_hash = c.hashes()
                found: list[list] = [[] for _ in range(c.hi - c.lo)]
                for n in lengths:
                    token, fits = _tokens(c, n)
                    for at in _bits(token):
                        fits &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                    for p in np.flatnonzero(fits).tolist():
                        r = int(c.row[p])
                        lo, hi = max(int(c.bound[r]), p - window + 1), min(int(c.bound[r + 1]), p + window)
                        around = [c.buf[s:e].tobytes().decode() for s, e in zip(c.start[lo:hi].tolist(), c.end[lo:hi].tolist())]
                        found[r].append({"pos": p - int(c.bound[r]), "token": int(token[p].view(np.int64)), "first": lo - int(c.bound[r]), "around": around})
                count += c.count.tolist()
                hits += found
            kind = pa.list_(pa.struct([("pos", pa.int64()), ("token", pa.int64()), ("first", pa.int64()), ("around", pa.list_(pa.string()))]))
            yield pa.record_batch([b.column(0), b.column(1), b.column(3), pa.array(count, pa.int64()), pa.array(hits, kind)],
                                  names=["row", "doc_id", "mark", "n_words", "hits"])
    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Words of documents inside an occurrence of a benchmark window.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text.  Words are runs of ASCII letters and digits and of all
    characters beyond ASCII, A-Z lower-cased.  Returns per input row of ``docs``: doc_id, n_words, n_hit, n_items,
    items_sha256 (item ids as strings, sorted, comma-joined), contaminated, spans (start, length in words), items and mark
    (hash of the text, to find the row again).
    Null or empty text: no words, clean.  Items without words or without an id have no window.  An item id on several rows
    has the windows of all of them.  Repeated documents are judged alike.  Empty benchmark: every document is clean; empty
    documents: empty result.  Other columns are ignored.
    """
    work = Workspace(docs.sparkSession)
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    windows = work.table(items.mapInArrow(_windows(window), "item_id string, words array<string>, n int, tokens array<long>"), "windows")
    bits, lengths = _filter(windows)
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    found = work.table(base.mapInArrow(_matches(window, bits, lengths), "row long, doc_id long, mark long, n_words long, "
                                       "hits array<struct<pos: long, token: long, first: long, around: array<string>>>"), "matches")
    hits = found.where("size(hits) > 0").select("row", "n_words", F.explode("hits").alias("h")).select("row", "n_words", "h.*")
    held = hits.groupBy("token").agg(F.count("*").alias("held"))
    # the rarest token of each window is its prefix; a window with a token that no document holds cannot occur
    asked = windows.select("words", F.posexplode("tokens").alias("offset", "token")).distinct().join(held, "token", "left")
    prefix = (asked.groupBy("words").agg(F.min(F.struct(F.coalesce("held", F.lit(0)).alias("held"), "offset", "token")).alias("p"))
              .where("p.held > 0").select("words", "p.offset", "p.token"))
    owners = windows.groupBy("words").agg(F.collect_set("item_id").alias("items"))
    prefix = work.table(prefix.join(owners, "words"), "prefix")  # both sides of the join are dealt anew: a hot token's rows can be split
    start = F.col("pos") - F.col("offset")
    met = hits.join(prefix, "token").withColumn("start", start).where((F.col("start") >= 0) & (F.col("start") + F.size("words") <= F.col("n_words")))
    met = met.where((F.col("start") >= F.col("first")) & (F.slice("around", (F.col("start") - F.col("first") + 1).cast("int"), F.size("words")) == F.col("words")))
    per_row = met.select("row", "start", F.size("words").alias("length"), "items").groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))))
    out = found.select("row", "doc_id", "mark", "n_words").join(per_row, "row", "left")
    hit = F.when(F.col("spans").isNull(), 0).otherwise(covered).cast("long")
    ids = F.coalesce("items", F.expr("cast(array() as array<string>)"))
    return out.select("doc_id", "mark", "n_words", hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
                      (hit > 0).alias("contaminated"), F.coalesce("spans", F.expr("cast(array() as array<struct<start: long, length: int>>)")).alias("spans"),
                      ids.alias("items"))
