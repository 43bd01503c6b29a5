"""Minimax contiguous sharding: the smallest shard capacity that ordered atomic groups allow, found by binary search.

Groups (equal texts) are ordered by the hash of their text.  The driver never sees the groups: it holds the sizes of
hash ranges ("cells"), 4,096 at first.  On those it searches two capacities: with cells uncut (feasible, hence an upper
bound) and with cells of several groups cut anywhere (a lower bound).  Only the cells in which a cut of the best
capacity can still lie are split 256-fold by a job over the compact size table, until both capacities agree or every
such cell is one group; the result is then the exact optimum over groups.  What reaches the driver depends on the
number of shards (at most about ``2 * shards**2 * 256`` sums a round), not on the data.
"""

from __future__ import annotations

import bisect

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerwise.llm.common import Workspace

FIRST_BITS, STEP_BITS = 12, 8
RUN = 5_000  # rows numbered together in one window


class _Cells:
    """Sizes of consecutive hash ranges, in order."""

    def __init__(self, rows):
        self.rows = sorted(rows)  # (first hash, bits, bytes, one group only)
        self.size = np.array([r[2] for r in self.rows], dtype=object) if self.rows else np.zeros(0, object)
        self.ends = [0]
        for s in self.size:
            self.ends.append(self.ends[-1] + int(s))
        self.total = self.ends[-1]

    def reach(self, p: int, capacity: int) -> int:
        """Farthest cell boundary from boundary p within the capacity."""
        return bisect.bisect_right(self.ends, self.ends[p] + capacity) - 1

    def whole(self, capacity: int, shards: int) -> list[int]:
        """Greedy cuts with uncut cells: boundaries after each shard; stuck where a cell is too large."""
        out, p = [], 0
        for _ in range(shards):
            p = self.reach(p, capacity)
            out.append(p)
        return out

    def fluid(self, capacity: int, shards: int) -> list[int]:
        """Greedy cuts in bytes if cells of several groups could be cut anywhere."""
        out, at = [], 0
        for _ in range(shards):
            to = min(at + capacity, self.total)
            p = bisect.bisect_right(self.ends, to) - 1
            if p < len(self.rows) and self.rows[p][3] and self.ends[p] < to:
                to = max(self.ends[p], at)  # a single group is not cut
            out.append(to)
            at = to
        return out


def _smallest(fits, low: int, high: int) -> int:
    while low < high:
        mid = (low + high) // 2
        if fits(mid):
            high = mid
        else:
            low = mid + 1
    return low


def capacity_and_cuts(table: DataFrame, shards: int) -> tuple[int, list[int]]:
    """(smallest capacity, first hash of shards 1..shards-1) for a table of (h long, size long)."""
    def sums(df, bits):
        key = F.shiftright("h", 64 - bits) if bits < 64 else F.col("h")
        rows = df.groupBy(key.alias("cell")).agg(F.sum("size").alias("s"), (F.min("h") == F.max("h")).alias("one")).collect()
        return [(r["cell"] << (64 - bits), bits, int(r["s"]), bool(r["one"]) or bits == 64) for r in rows]

    cells = _Cells(sums(table, FIRST_BITS))
    while True:
        n, total = len(cells.rows), cells.total
        if not n:
            return 0, []
        largest = max(r[2] for r in cells.rows)
        low = _smallest(lambda c: cells.fluid(c, shards)[-1] >= total, -(-total // shards), total)
        high = _smallest(lambda c: cells.whole(c, shards)[-1] == n, max(low, -(-total // shards)), max(total, largest))
        if low == high:
            break
        coarse = [i for i, r in enumerate(cells.rows) if not r[3] and r[2] * 16 > low]
        if not coarse:
            first, last = cells.whole(low, shards), cells.fluid(high, shards)
            coarse = sorted({i for a, b in zip(first, last) for i in range(a, min(n, bisect.bisect_left(cells.ends, b) + 1)) if not cells.rows[i][3]})
        if not coarse:
            break
        fresh = []
        by_bits: dict[int, list[int]] = {}
        for i in coarse:
            by_bits.setdefault(cells.rows[i][1], []).append(cells.rows[i][0] >> (64 - cells.rows[i][1]))
        for bits, inside in by_bits.items():
            fresh += sums(table.where(F.shiftright("h", 64 - bits).isin(inside)), min(64, bits + STEP_BITS))
        gone = set(coarse)
        cells = _Cells([r for i, r in enumerate(cells.rows) if i not in gone] + fresh)
    # cut: each shard as near to an equal part of the rest as the capacity leaves possible
    need = [0] * (n + 1)
    for p in range(n - 1, -1, -1):
        need[p] = 1 + need[cells.reach(p, high)]
    cuts, p = [], 0
    for left in range(shards, 1, -1):
        goal = cells.ends[p] + (total - cells.ends[p]) / left
        far = cells.reach(p, high)
        q = bisect.bisect_left(cells.ends, goal)
        q = min(far, q if q <= n and (q == p or abs(cells.ends[min(q, n)] - goal) <= abs(cells.ends[q - 1] - goal)) else q - 1)
        q = max(q, p)
        while q < far and need[q] > left - 1:
            q += 1
        cuts.append(cells.rows[q][0] if q < n else None)
        p = q
    return high, [c for c in cuts if c is not None]


def shard_by_bytes(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Deal documents to ``shards`` shards of near-equal bytes; equal texts stay together.

    Size of a row: UTF-8 bytes of its text plus 8; null text counts as empty.  Returns per input row doc_id, size,
    text_crc32, law ('bytes'), shard, slot (gapless from 0 in the shard) and grown_shard (null: this law keeps no key).
    The largest shard is as small as contiguous cuts over the groups (in hash order) allow; a group larger than an
    equal part makes its shard that large and the others share the rest evenly.  Null doc_ids and repeated rows are
    ordinary rows.  Empty table: empty result.
    """
    spark = docs.sparkSession
    work = Workspace(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    base = work.table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                                  F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("h"),
                                  F.monotonically_increasing_id().alias("row")), "sizes")
    _, cuts = capacity_and_cuts(base, shards)
    shard = sum([F.when(F.col("h") >= c, 1).otherwise(0) for c in cuts], F.lit(0)).cast("int")
    placed = base.withColumn("shard", shard)
    rows = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    # a shard's rows are numbered in runs, so that no task holds a whole shard
    runs = F.array(*[F.lit(max(1, -(-rows.get(s, 0) // RUN))) for s in range(shards)])
    placed = placed.withColumn("run", F.pmod(F.xxhash64("row"), runs[F.col("shard")]))
    count = placed.groupBy("shard", "run").agg(F.count("*").alias("n"))
    before = count.selectExpr("shard", "run", "sum(n) over (partition by shard order by run) - n as before")
    numbered = placed.selectExpr("*", "row_number() over (partition by shard, run order by row) - 1 as place")
    out = numbered.join(before, ["shard", "run"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      (F.col("before") + F.col("place")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
