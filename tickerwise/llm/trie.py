"""Prefix trie of conversations: one row per distinct beginning, subtree totals by time-forward processing.

A node is named by its depth and the exclusive-or of 128-bit hashes of (position, role, text) along its path, so names are
prefix sums and even one conversation with a third of all rows is named block by block.  Subtree totals need no round per level:
the rows of the paths are dealt out to shards, whole within a band of ``band`` levels; Spark sorts each shard (spilling) by reverse
level order; one pass over it sends every node's total to its parent through a priority queue that spills as well, and the parent,
which comes later in that order, picks its messages up.  A node that lies in several shards adds up its partial totals.
Tries deeper than a band have the roots of the bands as nodes of a smaller trie, which is solved in the same way first.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerwise.llm.common import Workspace, partitions

BAND = 4096      # levels of a band, and turns of a block of one conversation
QUEUE = 200_000  # messages that a queue holds in memory
PIECE = 1 << 20  # characters of joined ids in one row
NODE = ["depth", "k1", "k2"]


class SpillingQueue:
    """Priority queue of tuples; beyond ``limit`` its content goes, sorted, to a file that only this task sees (unlinked at once)."""

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs, self.spilled = limit, [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            file = tempfile.TemporaryFile()
            for x in sorted(self.heap):
                pickle.dump(x, file)
            file.seek(0)
            self.heap = []
            self.spilled += 1
            self._next(self.spilled, file)

    def _next(self, number: int, file) -> None:
        try:
            heapq.heappush(self.runs, (pickle.load(file), number, file))
        except EOFError:
            file.close()

    def pop_all(self, key: tuple):
        """Items whose first field equals ``key``; none with a smaller one is left by then."""
        while True:
            run = bool(self.runs) and (not self.heap or self.runs[0][0] < self.heap[0])
            top = self.runs[0][0] if run else self.heap[0] if self.heap else None
            if top is None or top[0] != key:
                return
            if run:
                item, number, file = heapq.heappop(self.runs)
                self._next(number, file)
            else:
                item = heapq.heappop(self.heap)
            yield item


def _time_forward(limit: int):
    """Rows (band, depth, k1, k2, p1, p2, top, leaves, saved) in order of band, falling depth and name -> a shard's subtree totals."""
    def run(batches):
        queue, node, totals, out = SpillingQueue(limit), None, [0, 0], []

        def close():
            key, parent = node
            for _, leaves, saved in queue.pop_all(key):
                totals[0] += leaves
                totals[1] += saved
            if parent is not None:
                queue.push((parent, totals[0], totals[1]))
            out.append((-key[1], key[2], key[3], totals[0], totals[1]))

        def batch():
            cols = list(zip(*out))
            out.clear()
            return pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=[*NODE, "leaves", "saved"])

        for b in batches:
            for band, depth, k1, k2, p1, p2, top, leaves, saved in zip(*(c.to_pylist() for c in b.columns)):
                key = (band, -depth, k1, k2)
                if node is None or key != node[0]:
                    if node is not None:
                        close()
                    node, totals = (key, None if top else (band, 1 - depth, p1, p2)), [0, 0]
                totals[0] += leaves
                totals[1] += saved
            if len(out) >= 50_000:
                yield batch()
        if node is not None:
            close()
        if out:
            yield batch()
    return run


def ordered_turns(rows: DataFrame, work: Workspace) -> DataFrame:
    """(conv_id, pos, role, text): turns numbered from 1 in order of turn (null first), then role and text.

    Rows are sorted by range, not grouped by conversation, so a conversation of any length is spread; a null role or text is
    empty, and rows without a conv_id belong to no conversation.
    """
    name = f"turns-{uuid.uuid4().hex}"
    rows = rows.where("conv_id is not null").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    dealt = work.table(dealt.withColumn("part", F.spark_partition_id()).withColumn("i", F.monotonically_increasing_id()), name)
    parts = dealt.groupBy("conv_id", "part").agg(F.min("i").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = work.table(parts.select("conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift")), f"{name}-parts")
    return dealt.join(parts, ["conv_id", "part"]).select("conv_id", (F.col("i") + F.col("shift")).alias("pos"), "role", "text")


def spliced(turns: DataFrame, work: Workspace, every: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first h turns of conversation c - c % every and go on with their own after their first h.

    h = crc32 of the decimal conv_id modulo ``heads``; returns (conv_id) of all conversations and (conv_id, pos, role, text) of the rebuilt ones.
    """
    name = f"spliced-{uuid.uuid4().hex}"
    turns = work.table(turns, f"{name}-turns")
    sizes = work.table(turns.groupBy("conv_id").agg(F.count("*").alias("n")), f"{name}-sizes")
    convs = sizes.select("conv_id", (F.crc32(F.col("conv_id").cast("string")) % heads).alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("has"))
    convs = work.table(convs.join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("has", F.lit(0)))).drop("has"), f"{name}-convs")
    first = turns.where(F.col("pos") < heads).select(F.col("conv_id").alias("base"), "pos", "role", "text")
    begin = convs.join(first, "base").where("pos <= h").select("conv_id", "pos", "role", "text")
    own = turns.join(convs, "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "role", "text")
    return convs.select("conv_id"), begin.unionByName(own)


def _paths(turns: DataFrame, block: int) -> DataFrame:
    """Every turn with the name of the node it ends at (k1, k2) and of that node's parent (p1, p2)."""
    digest = F.md5(F.concat(F.col("pos").cast("string"), F.lit(":"), F.length("role").cast("string"), F.lit(":"), "role", "text"))
    rows = turns.select("conv_id", F.col("pos").alias("depth"), F.octet_length("text").cast("long").alias("bytes"), digest.alias("x"),
                        F.expr(f"(pos - 1) div {block}").alias("block"))
    rows = rows.select("conv_id", "depth", "bytes", "block", *(F.conv(F.substring("x", 16 * i + 1, 16), 16, -10).cast("long").alias(f"x{i + 1}") for i in (0, 1)))
    running = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "block").agg(F.bit_xor("x1").alias("y1"), F.bit_xor("x2").alias("y2"))
    blocks = blocks.select("conv_id", "block", *(F.coalesce(F.bit_xor(f"y{i}").over(before), F.lit(0).cast("long")).alias(f"z{i}") for i in (1, 2)))
    rows = rows.withColumn("r1", F.bit_xor("x1").over(running)).withColumn("r2", F.bit_xor("x2").over(running)).join(blocks, ["conv_id", "block"])
    for i in (1, 2):
        rows = rows.withColumn(f"k{i}", F.col(f"r{i}").bitwiseXOR(F.col(f"z{i}"))).withColumn(f"p{i}", F.col(f"k{i}").bitwiseXOR(F.col(f"x{i}")))
    return rows.select("conv_id", "depth", "k1", "k2", "p1", "p2", "bytes")


def _subtrees(paths: DataFrame, band: int, work: Workspace, queue: int) -> DataFrame:
    """Totals (depth, k1, k2, leaves, saved) over the subtree of every node.

    ``paths``: (conv_id, depth from 1, k1, k2, p1, p2, own, leaves, saved); ``own`` marks the one row that carries a node's weights.
    """
    name = f"subtrees-{uuid.uuid4().hex}"

    def local(rows: DataFrame, step: str) -> DataFrame:
        rows = rows.withColumn("band", F.expr(f"(depth - 1) div {band}")).withColumn("top", F.expr(f"(depth - 1) % {band} = 0"))
        # the first and the third node of the path in the band keep like paths together; the shard is dealt by range, so none is hot
        whole = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        near = rows.withColumn("s1", F.first("k1").over(whole)).withColumn("s3", F.nth_value("k1", 3).over(whole))
        dealt = near.repartitionByRange(partitions(rows.sparkSession), "band", "s1", "s3", "conv_id").sortWithinPartitions("band", F.desc("depth"), "k1", "k2")
        parts = (dealt.select("band", "depth", "k1", "k2", "p1", "p2", "top", "leaves", "saved")
                 .mapInArrow(_time_forward(queue), "depth long, k1 long, k2 long, leaves long, saved long"))
        return work.table(parts.groupBy(*NODE).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), f"{name}-{step}")

    totals = local(paths, "local")
    deepest = paths.agg(F.max("depth")).first()[0]
    if deepest is None or deepest <= band:
        return totals
    # roots of bands as nodes of a smaller trie; their weights are the totals of their bands
    roots = paths.where(f"(depth - 1) % {band} = 0").drop("leaves", "saved")
    weights = totals.where(f"(depth - 1) % {band} = 0")
    up = Window.partitionBy("conv_id").orderBy("depth")
    small = (roots.join(weights, NODE).withColumn("leaves", F.expr("if(own, leaves, 0)")).withColumn("saved", F.expr("if(own, saved, 0)"))
             .withColumn("p1", F.coalesce(F.lag("k1").over(up), F.lit(0).cast("long"))).withColumn("p2", F.coalesce(F.lag("k2").over(up), F.lit(0).cast("long")))
             .withColumn("depth", F.expr(f"(depth - 1) div {band} + 1")))
    full = _subtrees(work.table(small, f"{name}-roots"), band, work, queue).withColumn("depth", F.expr(f"(depth - 1) * {band} + 1"))
    # what hangs below a band's last level is a message from the roots there
    sent = (roots.where("own and depth > 1").join(full, NODE).groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
            .agg(F.sum("leaves").alias("more"), F.sum("saved").alias("more_saved")))
    at = work.table(paths.where(f"own and depth % {band} = 0").join(sent, NODE).select("conv_id", "depth", "more", "more_saved"), f"{name}-sent")
    loaded = (paths.join(at, ["conv_id", "depth"], "left").withColumn("leaves", F.col("leaves") + F.coalesce("more", F.lit(0)))
              .withColumn("saved", F.col("saved") + F.coalesce("more_saved", F.lit(0))).drop("more", "more_saved"))
    return local(loaded, "whole")


def _join_ids(batches):
    """Sorted rows (depth, k1, k2, conv_id) -> pieces of the comma-joined ids of each node."""
    node, ids, size, out = None, [], 0, []

    def piece():
        out.append((*node, ids[0], ",".join(map(str, ids))))

    def batch():
        cols = list(zip(*out))
        out.clear()
        return pa.record_batch([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string())], names=[*NODE, "first", "ids"])

    for b in batches:
        for d, k1, k2, c in zip(*(x.to_pylist() for x in b.columns)):
            if node != (d, k1, k2) or size > PIECE:
                if ids:
                    piece()
                    if size > PIECE or len(out) >= 20_000:
                        yield batch()
                node, ids, size = (d, k1, k2), [], 0
            ids.append(c)
            size += len(str(c)) + 1
    if ids:
        piece()
    if out:
        yield batch()


def _digest_ids(batches):
    """Sorted pieces of each node's ids -> one SHA-256 a node; one running digest is held."""
    node, sha, out = None, None, []

    def batch():
        cols = list(zip(*out))
        out.clear()
        return pa.record_batch([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], names=[*NODE, "ends_sha256"])

    for b in batches:
        for d, k1, k2, _, ids in zip(*(x.to_pylist() for x in b.columns)):
            if node == (d, k1, k2):
                sha.update(b"," + ids.encode())
                continue
            if node is not None:
                out.append((*node, sha.hexdigest()))
            node, sha = (d, k1, k2), hashlib.sha256(ids.encode())
        if len(out) >= 20_000:
            yield batch()
    if node is not None:
        out.append((*node, sha.hexdigest()))
        yield batch()


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): the SHA-256 of each node's conv_ids, ascending and comma-joined.

    Ids are joined range by range, so a node at which a third of all conversations end is joined by many tasks; one digest then runs
    over its pieces of about a million characters (a digest is sequential by nature).
    """
    p = partitions(ends.sparkSession)
    pieces = (ends.repartitionByRange(p, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").select(*NODE, "conv_id")
              .mapInArrow(_join_ids, "depth long, k1 long, k2 long, first long, ids string"))
    return (pieces.repartition(p, *NODE).sortWithinPartitions(*NODE, "first")
            .mapInArrow(_digest_ids, "depth long, k1 long, k2 long, ends_sha256 string"))


def prefix_trie(convs: DataFrame, turns: DataFrame, work: Workspace | None = None, band: int = BAND, queue: int = QUEUE) -> DataFrame:
    """One row per distinct beginning of the conversations ``convs`` (conv_id) with ``turns`` (conv_id, pos from 1 gapless, role, text).

    Columns conv_id (smallest member), depth, parent_conv_id (the parent's; null at the root), n_convs (members), n_children, n_leaves
    (childless nodes in the subtree), saved_tokens (sum over the subtree of (members - 1) x bytes of the node's last text),
    ends_sha256 (of the decimal ids of members that end here, ascending, comma-joined) and node, the node's name.

    Defined results: a conversation without turns ends at the root; equal conversations share their nodes; no conversation, no row,
    not even a root; null and empty texts are alike (``ordered_turns``); columns of other names are not read; a text of any
    length is only hashed and measured.
    """
    work = work or Workspace(turns.sparkSession)
    name = f"trie-{uuid.uuid4().hex}"
    paths = work.table(_paths(turns, band), f"{name}-paths")
    nodes = work.table(paths.groupBy(*NODE).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
                                                F.min("bytes").alias("bytes")), f"{name}-nodes")
    families = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = work.table(nodes.join(families, NODE, "left").fillna(0, ["n_children"]), f"{name}-children")
    weights = nodes.select("conv_id", "depth", F.lit(True).alias("own"), F.expr("if(n_children = 0, 1L, 0L)").alias("leaves"),
                           ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    loaded = paths.drop("bytes").join(weights, ["conv_id", "depth"], "left").fillna(False, ["own"]).fillna(0, ["leaves", "saved"])
    totals = _subtrees(work.table(loaded, f"{name}-loaded"), band, work, queue)
    last = paths.groupBy("conv_id").agg(F.max(F.struct("depth", "k1", "k2")).alias("e")).select("conv_id", "e.*")
    none = F.lit(0).cast("long")
    ends = work.table(convs.join(last, "conv_id", "left").select("conv_id", *(F.coalesce(c, none).alias(c) for c in NODE)), f"{name}-ends")
    digests = work.table(ends_digest(ends), f"{name}-digests")
    root = ends.agg(F.count("*").alias("n"), F.min("conv_id").alias("c")).first()
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    below = nodes.where("depth > 1").join(parents, ["depth", "p1", "p2"])
    tops = nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(root["c"]).cast("long"))  # the widest family needs no join
    both = below.unionByName(tops).join(totals, NODE)
    first = totals.where("depth = 1").agg(F.count("*").alias("n_children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    top = first.select(none.alias("depth"), none.alias("k1"), none.alias("k2"), F.lit(root["c"]).cast("long").alias("conv_id"), none.alias("p"),
                       F.lit(root["n"]).cast("long").alias("n_convs"), "n_children", F.coalesce("leaves", F.lit(1)).alias("leaves"),
                       F.coalesce("saved", F.lit(0)).alias("saved")).where("n_convs > 0").withColumn("parent_conv_id", F.lit(None).cast("long")).drop("p")
    cols = [*NODE, "conv_id", "parent_conv_id", "n_convs", "n_children", "leaves", "saved"]
    out = both.select(cols).unionByName(top.select(cols)).join(digests, NODE, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), F.format_string("%d-%016x%016x", *NODE).alias("node"))
