"""Phrase collocations: an FM-index per shard of words, phrases found by extending BWT intervals at both ends, counts summed across shards.

Every task turns its own rows into shards of about ``SHARD`` words of one language and writes, for each, the Burrows-Wheeler
transform of the word ids and of their mirror image.  Both are sorted by the first ``longest`` words only: intervals of phrases
up to that length are the same as in the full index.  Phrases grow a word at a time, at their right and their left end in
turn; a shard extends only phrases that are frequent over all shards, and only to phrases whose other end is frequent too.
The counts of each length are summed over the shards: a shard sends its grown phrases packed by hash range (about three bytes a
phrase), a range adds them up and answers every shard which of its phrases are frequent.  The shards meet the answers and
their index bucket by bucket: the index itself is never shuffled.  No vocabulary and no phrase table is broadcast.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerwise.llm.common import Workspace, partitions
from tickerwise.llm.words import mix

SHARD = 1 << 21  # words of a shard; a task holds at most about twice as many, and at least one whole text
RANGE = 1 << 19  # words of the input to one hash range of phrases, so no range grows with the input
_CUT = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n\n ")
_INDEX = "shard long, lang string, n_words long, words array<string>, lo array<int>, n array<int>, bwt binary, mirror binary"


def by_symbol(symbols: np.ndarray) -> np.ndarray:
    """Stable order of non-negative int32 symbols, by 16 bits at a time (numpy sorts those by radix)."""
    order = np.argsort((symbols & 0xFFFF).astype(np.uint16), kind="stable")
    if len(symbols) and int(symbols.max()) >> 16:
        order = order[np.argsort((symbols >> 16).astype(np.uint16)[order], kind="stable")]
    return order


def transform(text: np.ndarray, depth: int) -> np.ndarray:
    """BWT of the cyclic ``text`` whose rows are sorted by their first ``depth`` symbols."""
    rows = np.arange(len(text), dtype=np.int32)
    for _ in range(depth):
        rows -= 1  # one more symbol in front, by which the rows are sorted last
        rows[rows < 0] = len(text) - 1
        rows = rows[by_symbol(text[rows])]
    return text[rows - 1].astype(np.int32)


class Shard:
    """Words of one language; 0 marks the end of a piece."""

    def __init__(self):
        self.ids: defaultdict = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.parts: list[np.ndarray] = []
        self.size = self.ids[b""] + self.ids[b"\n"] - 1

    def add(self, texts: list[str]) -> int:
        data = "\n".join(texts).encode().lower().translate(_CUT).replace(b"\n", b" \n ") + b" \n"
        tokens = data.split(b" ")
        ids = np.fromiter(map(self.ids.__getitem__, tokens), np.int32, len(tokens))
        ids = ids[ids > 0] - 1
        ids = ids[(ids > 0) | np.concatenate([[False], ids[:-1] > 0])]  # one mark between pieces
        self.parts.append(ids)
        self.size += len(ids)
        return len(ids)

    def row(self, number: int, lang: str, depth: int) -> pa.RecordBatch | None:
        text = np.concatenate(self.parts)
        if not len(text):
            return None
        words = list(self.ids)[2:]
        count = np.bincount(text, minlength=len(words) + 1)
        lo = np.cumsum(count) - count
        return pa.record_batch({
            "shard": pa.array([number], pa.int64()), "lang": pa.array([lang]), "n_words": pa.array([int(count[1:].sum())], pa.int64()),
            "words": pa.array([[w.decode() for w in words]], pa.list_(pa.string())),
            "lo": pa.array([lo[1:].tolist()], pa.list_(pa.int32())), "n": pa.array([count[1:].tolist()], pa.list_(pa.int32())),
            "bwt": pa.array([transform(text, depth).tobytes()], pa.binary()), "mirror": pa.array([transform(text[::-1], depth).tobytes()], pa.binary())})


def _indexer(depth: int, size: int):
    def build(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        open_: dict[str, Shard] = {}
        held = 0
        for b in batches:
            texts: dict[str, list[str]] = {}
            for t, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if t:
                    texts.setdefault("und" if lang is None else lang, []).append(t)
            for lang, ts in texts.items():
                held += open_.setdefault(lang, Shard()).add(ts)
            while held >= size:  # the largest first, so that many small languages do not end in many small shards
                lang = max(open_, key=lambda x: open_[x].size)
                shard = open_.pop(lang)
                held -= shard.size
                if (row := shard.row(number, lang, depth)) is not None:
                    yield row
                number += 1
        for lang, shard in open_.items():
            if (row := shard.row(number, lang, depth)) is not None:
                yield row
            number += 1
    return build


def grow(bwt: np.ndarray, lo: np.ndarray, other: np.ndarray, size: np.ndarray):
    """One more symbol in front of every interval: (parent, interval of the other end, lo, other, size) of the children kept.

    ``lo`` are starts in this index, ``other`` the starts of the same phrases in the mirrored one, all of one length, hence disjoint.
    A child is kept if the phrase without its last symbol is one of the intervals as well.
    """
    rank = np.empty(len(bwt), np.int64)
    rank[by_symbol(bwt)] = np.arange(len(bwt))  # last-to-first mapping
    total = int(size.sum())
    parent = np.repeat(np.arange(len(lo)), size)
    rows = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(total)
    owner = np.full(len(bwt), -1, np.int32)  # which interval a row of this index belongs to
    owner[rows] = parent
    symbol = bwt[rows]
    target = rank[rows]
    came = np.full(len(bwt), -1, np.int32)
    came[target] = parent
    first = np.zeros(len(bwt), np.int32)
    first[target] = symbol  # a run of targets of one parent and one symbol is one child; the piece mark 0 is none
    at = np.flatnonzero(came >= 0)
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    p, s = came[at].astype(np.int64), first[at]
    new = np.concatenate([[True], (p[1:] != p[:-1]) | (s[1:] != s[:-1]) | (np.diff(at) > 1)])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(at)))
    p, s, start = p[begin], s[begin], at[begin]
    # in the mirrored index the children lie side by side in the order of their symbols, inside the parent's interval
    order = np.lexsort((s, p))
    p, s, start, count = p[order], s[order], start[order], count[order]
    before = np.cumsum(count) - count
    family = np.searchsorted(p, p, side="left")
    mirrored = other[p] + before - before[family]
    rest = owner[start]
    keep = (s > 0) & (rest >= 0)
    return p[keep], rest[keep], start[keep], mirrored[keep], count[keep]


def _ints(cell, kind) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), kind).astype(np.int64)


def _children(batch, i: int, front: bool):
    """Grown intervals of row ``i``: (head, tail, lo, rlo, n); head and tail number the phrase without its last and without its first word."""
    lo, rlo, n, gid = (_ints(batch.column(c)[i], kind) for c, kind in (("lo", np.int32), ("rlo", np.int32), ("n", np.int32), ("gid", np.int64)))
    bwt = np.frombuffer(batch.column("bwt")[i].as_buffer(), np.int32)
    if front:
        p, rest, lo, rlo, n = grow(bwt, lo, rlo, n)
        return gid[rest], gid[p], lo, rlo, n
    p, rest, rlo, lo, n = grow(bwt, rlo, lo, n)
    return gid[p], gid[rest], lo, rlo, n


def _dealt(head: np.ndarray, tail: np.ndarray, ranges: int):
    """(order, range) of phrases by hash range, head and tail: the order in which a shard sends them and gets its answers."""
    where = (mix(mix(head.astype(np.uint64)) + tail.astype(np.uint64)) % np.uint64(ranges)).astype(np.int64)
    order = np.lexsort((tail, head, where))
    return order, where[order]


def _pack(v: np.ndarray) -> bytes:
    """Integers as zstandard of their bytes, place by place: small ones and small steps take little."""
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(v, np.int64).view(np.uint8).reshape(len(v), 8).T.tobytes())


def _unpack(blob: bytes, size: int) -> np.ndarray:
    import zstandard
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, size).T).view(np.int64)[:, 0]


def _sender(front: bool, ranges: int):
    """Per shard and hash range: the grown phrases and their counts in the shard, packed."""
    def send(batches):
        for b in batches:
            for i in range(b.num_rows):
                head, tail, _, _, n = _children(b, i, front)
                order, where = _dealt(head, tail, ranges)
                head, tail, n = head[order], tail[order], n[order]
                cut = np.searchsorted(where, np.arange(ranges + 1))
                rows = [(r, x, y) for r, (x, y) in enumerate(zip(cut[:-1], cut[1:])) if y > x]
                yield pa.record_batch({
                    "shard": pa.array([b.column("shard")[i].as_py()] * len(rows), pa.int64()), "range": pa.array([r for r, _, _ in rows], pa.int32()),
                    "size": pa.array([int(y - x) for _, x, y in rows], pa.int32()),
                    "head": pa.array([_pack(np.diff(head[x:y], prepend=0)) for _, x, y in rows], pa.binary()),
                    "tail": pa.array([_pack(tail[x:y]) for _, x, y in rows], pa.binary()), "n": pa.array([_pack(n[x:y]) for _, x, y in rows], pa.binary())})
    return send


_SENT = "shard long, range int, size int, head binary, tail binary, n binary"
_JUDGED = "shard long, range int, size int, head binary, tail binary, total binary, passed binary, gid binary"


def _judge(enough: int):
    """All phrases of a hash range, summed over the shards: one row of those with ``enough`` (shard null), and an answer to every shard."""
    def judge(table: pa.Table) -> pa.Table:
        sizes = table.column("size").to_pylist()
        head, tail, n = (np.concatenate([fix(_unpack(x, k)) for x, k in zip(table.column(c).to_pylist(), sizes)])
                         for c, fix in (("head", np.cumsum), ("tail", np.asarray), ("n", np.asarray)))
        order = np.lexsort((tail, head))
        h, t = head[order], tail[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])])
        total = np.add.reduceat(n[order], np.flatnonzero(new))
        frequent = total >= enough
        number = np.where(frequent, np.cumsum(frequent) - 1, -1)[np.cumsum(new) - 1]  # of each row's phrase, among the frequent ones
        mine = np.empty(len(order), np.int64)
        mine[order] = number
        where = table.column("range")[0].as_py()
        lead, base = np.flatnonzero(new)[frequent], where << 32
        out = [(None, where, len(lead), _pack(h[lead]), _pack(t[lead]), _pack(total[frequent]), None, None)] if len(lead) else []
        ends = np.cumsum(sizes)
        for shard, e, k in zip(table.column("shard").to_pylist(), ends, sizes):
            got = mine[e - k:e]
            if (got >= 0).any():
                out.append((shard, where, k, None, None, None, np.packbits(got >= 0).tobytes(), _pack(got[got >= 0] + base)))
        cols = list(zip(*out)) or [()] * 8
        kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 5]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in _JUDGED.split(", ")])
    return judge


def _phrase_rows(batches):
    for b in batches:
        for r, k, *blobs in zip(*(b.column(c).to_pylist() for c in ("range", "size", "head", "tail", "total"))):
            head, tail, total = (_unpack(x, k) for x in blobs)
            yield pa.record_batch([pa.array((r << 32) + np.arange(k)), pa.array(head), pa.array(tail), pa.array(total)], names=["gid", "head", "tail", "total"])


_KNOWN = "shard long, lo binary, rlo binary, n binary, gid binary"


def _known_row(shard: int, lo, rlo, n, gid) -> pa.RecordBatch:
    return pa.record_batch([pa.array([shard], pa.int64()), *(pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in (lo, rlo, n)),
                            pa.array([gid.astype(np.int64).tobytes()], pa.binary())], names=["shard", "lo", "rlo", "n", "gid"])


def _keeper(front: bool, ranges: int):
    """The intervals of a shard's frequent phrases, by the answers to what it sent."""
    def keep(batches):
        for b in batches:
            for i in range(b.num_rows):
                head, tail, lo, rlo, n = _children(b, i, front)
                order, where = _dealt(head, tail, ranges)
                cut, chosen, gids = np.searchsorted(where, np.arange(ranges + 1)), [], []
                for x in b.column("answers")[i].as_py():
                    passed = np.unpackbits(np.frombuffer(x["passed"], np.uint8), count=x["size"]).astype(bool)
                    chosen.append(order[cut[x["range"]]:cut[x["range"] + 1]][passed])
                    gids.append(_unpack(x["gid"], int(passed.sum())))
                chosen = np.concatenate(chosen)
                yield _known_row(b.column("shard")[i].as_py(), lo[chosen], rlo[chosen], n[chosen], np.concatenate(gids))
    return keep


def _known_words(batches):
    for b in batches:
        for i in range(b.num_rows):
            lo, n, gid = (x.to_numpy(zero_copy_only=False) for x in b.column(1)[i].values.flatten())
            yield _known_row(b.column(0)[i].as_py(), lo, lo, n, gid)


def _frequent(rows: DataFrame, keys: list[str], at_least: int) -> DataFrame:
    """Rows of the phrases with ``at_least`` occurrences over all shards: their ``total`` and ``gid``, a number for each phrase.

    A phrase has one row for each shard, so no window partition is larger than the number of shards.
    """
    w = Window.partitionBy(*keys)
    numbered = rows.repartition(partitions(rows.sparkSession), *keys).withColumn("row", F.monotonically_increasing_id())
    return (numbered.withColumn("total", F.sum(F.col("n").cast("long")).over(w)).where(F.col("total") >= at_least)
            .withColumn("gid", F.min("row").over(w)).withColumn("lead", F.col("gid") == F.col("row")).drop("row"))


def phrases(docs: DataFrame, longest: int = 5, at_least: int = 100, work: Workspace | None = None, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, m, a) of all phrases of 1 to ``longest`` words with ``at_least`` occurrences, and (lang, n) of all languages.

    Texts are lower-cased (A-Z), cut at ``[.,;:!?\\n\\v\\f\\r]`` into pieces and at blanks and tabs into words; phrases do not reach over pieces.
    """
    spark = docs.sparkSession
    work = work or Workspace(spark)
    name = f"fm_{uuid.uuid4().hex}"

    def by_shard(df: DataFrame, table: str) -> DataFrame:
        """A written table whose files are buckets of shards: joins of such tables move no rows."""
        df.write.bucketBy(partitions(spark), "shard").option("path", f"{work.path}/{table}").option("compression", "zstd").format("parquet").saveAsTable(table)
        return spark.table(table)

    index = by_shard(docs.select("text", "lang").mapInArrow(_indexer(longest, shard), _INDEX), name)
    sizes = work.table(index.groupBy("lang").agg(F.sum("n_words").alias("n")).where("n > 0"), f"{name}-sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    ranges = -(-total // RANGE) or 1
    words = index.select("shard", "lang", F.explode(F.arrays_zip("words", "lo", "n")).alias("w")).select("shard", "lang", "w.words", "w.lo", "w.n")
    level = work.table(_frequent(words, ["lang", "words"], at_least).select("shard", "lo", "n", "gid", "lead", "total", "lang", F.col("words").alias("phrase")), f"{name}-1")
    named = level.where("lead").select("gid", "lang", "phrase", "total")
    out = named.select("lang", "phrase", F.lit(1).alias("m"), F.col("total").alias("a"))
    known = by_shard(level.groupBy("shard").agg(F.collect_list(F.struct("lo", "n", "gid")).alias("known")).mapInArrow(_known_words, _KNOWN), f"{name}_known_1")
    for m in range(2, longest + 1):
        front = m % 2 == 1
        met = index.select("shard", F.col("bwt" if front else "mirror").alias("bwt")).join(known.hint("shuffle_hash"), "shard")
        sent = met.mapInArrow(_sender(front, ranges), _SENT)
        judged = work.table(sent.groupBy("range").applyInArrow(_judge(at_least), _JUDGED), f"{name}-{m}")
        if m < longest:
            answers = judged.where("shard is not null").groupBy("shard").agg(F.collect_list(F.struct("range", "size", "passed", "gid")).alias("answers"))
            known = by_shard(met.join(answers.hint("shuffle_hash"), "shard").mapInArrow(_keeper(front, ranges), _KNOWN), f"{name}_known_{m}")
        ends = named.select(F.col("gid").alias("tail"), F.substring_index("phrase", " ", -1).alias("last"))
        begins = named.select(F.col("gid").alias("head"), "lang", F.col("phrase").alias("first"))
        found = judged.where("shard is null").mapInArrow(_phrase_rows, "gid long, head long, tail long, total long")
        named = found.join(begins, "head").join(ends, "tail").select("gid", "lang", F.concat_ws(" ", "first", "last").alias("phrase"), "total")
        named = work.table(named, f"{name}-{m}-named")
        out = out.unionByName(named.select("lang", "phrase", F.lit(m).alias("m"), F.col("total").alias("a")))
    for table in (name, *(f"{name}_known_{m}" for m in range(1, longest))):  # all that follows reads the written levels
        spark.sql(f"DROP TABLE {table}")
        work.drop(table)
    return out, sizes


def collocations(docs: DataFrame, longest: int = 5, at_least: int = 100, absorb: int = 100, top: int = 2000, work: Workspace | None = None,
                 shard: int = SHARD) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language by cohesion.

    Columns lang, rank, phrase, a (occurrences), l, r (of the two parts at the weakest cut), n (words of the language),
    score = floor(1000 * a * n / (l * r)) there, left_extensions and right_extensions (frequent phrases with one more word on that side).
    A phrase inside a longer frequent one with ``absorb`` percent of its occurrences is left out.

    Defined results: a null language is ``und``, a null or empty text has no words; repeated rows count each; ties are broken by
    a, then phrase in byte order; an empty table gives no rows; other columns of ``docs`` are not read.  A text is never cut:
    a task holds about 100 bytes a word of its two open million words, plus the longest single text.
    """
    work = work or Workspace(docs.sparkSession)
    found, sizes = phrases(docs, longest, at_least, work, shard)
    found = work.table(found, f"found-{uuid.uuid4().hex}")
    many = found.where("m >= 2").withColumn("words", F.split("phrase", " "))
    part = "array_join(slice(words, {}, {}), ' ')"
    inner = many.select("lang", "m", F.col("a").alias("longer"), F.expr(f"""explode(flatten(transform(sequence(2, m), k ->
        transform(sequence(1, m - k + 1), i -> struct({part.format('i', 'k')} as phrase, k as k, i as i)))))""").alias("s")).where("s.k < m")
    inner = inner.groupBy("lang", "s.phrase").agg(F.max("longer").alias("longer"),
                                                  F.count_if(F.expr("s.k = m - 1 and s.i = 2")).alias("left_extensions"),
                                                  F.count_if(F.expr("s.k = m - 1 and s.i = 1")).alias("right_extensions"))
    many = (many.join(inner, ["lang", "phrase"], "left").fillna(0, ["longer", "left_extensions", "right_extensions"])
            .where(F.col("longer") * 100 < F.col("a") * absorb))
    cuts = many.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cuts = cuts.withColumn("first", F.expr(part.format("1", "k"))).withColumn("rest", F.expr(part.format("k + 1", "m - k")))
    left = found.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = found.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    exact = "cast({} as decimal(19,0))"
    scored = (cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(sizes, "lang")
              .withColumn("score", F.expr(f"(1000 * {exact.format('a')} * {exact.format('n')}) div ({exact.format('l')} * {exact.format('r')})")))
    weakest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n", "left_extensions", "right_extensions")).alias("w"))
    order = [F.desc("w.score"), F.desc("w.a"), F.asc("phrase")]
    for keys in (["lang", "slice"], ["lang"]):  # the best of each slice first: no task sorts all phrases of a language
        weakest = weakest.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(64)))
        weakest = weakest.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return (weakest
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "w.a", "w.l", "w.r", "w.n", "w.score", "w.left_extensions", "w.right_extensions"))
