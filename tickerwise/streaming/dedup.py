"""ST5: one row per (ticker, Date) out of a stream of arrivals, whatever order they come in.

``transformWithState`` keeps, per (ticker, Date), the ``seq`` of the row published so far.  Event time is the time of
arrival, not the bar's date: no row is ever too late, so file order, file count and the number of shuffle partitions
do not matter.  A key's state goes ``hold`` after its last arrival (an event-time timer, moved on by every arrival); the
published rows are ranked by ``seq`` again when they are read, so an arrival after that cannot replace a better row either.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tickerwise.schema import KEY, ORDER
from tickerwise.streaming.jobs import dir_stream, run_dir, stage_files, state_in_rocksdb, state_partitions
from tickerwise.streaming.table import EpochTable

LEAST = -(2**63)  # the rank of a row without a seq: before all others


class BestArrival(StatefulProcessor):
    """Per (ticker, Date): publish a row when its rank beats the best one so far (lowest or highest ``seq``)."""

    def __init__(self, columns: list[str], seq: str, keep: str, hold_ms: int):
        self.columns, self.seq, self.last, self.hold_ms = columns, seq, keep == "last", hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", "rank bigint, expires bigint")

    def rank(self, row: Row) -> int:
        seq = LEAST if row[self.seq] is None else row[self.seq]
        return seq if self.last else ~seq  # the complement turns the order round without leaving 64 bits

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        top, arrived = None, 0
        for r in rows:
            arrived = max(arrived, int(r["_arrived"].timestamp() * 1000))
            order = (self.rank(r), [(r[c] is not None, r[c]) for c in self.columns])
            if top is None or order > top[0]:
                top = (order, r)
        known = self.best.get()
        rank, expires = top[0][0], arrived + self.hold_ms
        if known is not None:
            self.handle.deleteTimer(known[1])
            better = rank >= known[0]  # of equal seq the larger row wins when the table is read
        self.best.update((rank if known is None or better else known[0], expires))
        self.handle.registerTimer(expires)
        if known is None or better:
            yield Row(**{c: top[1][c] for c in self.columns})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.best.clear()
        return iter(())

    def close(self) -> None:
        pass


def best_arrivals(rows: DataFrame, seq: str = "seq", keep: str = "last", hold_ms: int = 7 * 86_400_000) -> DataFrame:
    """Stream of the rows that are, when they arrive, the best of their (ticker, Date): ``keep`` = 'first' (lowest seq) or 'last' (highest)."""
    if keep not in ("first", "last"):
        raise ValueError(f"keep is 'first' or 'last', not {keep!r}")
    columns = rows.columns
    arrivals = rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", "0 seconds")
    return arrivals.groupBy(KEY, ORDER).transformWithState(
        statefulProcessor=BestArrival(columns, seq, keep, hold_ms), outputStructType=StructType(rows.schema.fields), outputMode="Update", timeMode="eventTime")


def run_dedup(spark: SparkSession, arrivals: DataFrame, path: str, seq: str = "seq", keep: str = "last", hold_ms: int = 7 * 86_400_000) -> DataFrame:
    """Run the stream over what is there and return the table it publishes (an :class:`EpochTable` that ranks the rows of a key by ``seq``)."""
    rank = F.coalesce(F.col(seq).cast("bigint"), F.lit(LEAST))
    table = EpochTable(spark, f"{path}/out", arrivals.schema, [KEY, ORDER], rank if keep == "last" else F.bitwise_not(rank))
    with state_in_rocksdb(spark):
        q = (best_arrivals(arrivals, seq, keep, hold_ms).writeStream.outputMode("update").foreachBatch(table.publish)
             .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
    return table.read()


def run_stream_dedup(spark: SparkSession, bars: DataFrame, keep: str, files: int | None = None, max_files: int | None = None) -> DataFrame:
    """Stage ``bars`` as files (in no particular order) and deduplicate them as they arrive, ``max_files`` a micro-batch (see :func:`stage_files`)."""
    path = run_dir(spark, f"dedup-{keep}")
    rows, max_files = stage_files(bars, f"{path}/in", files, max_files)
    with state_partitions(spark, rows):
        return run_dedup(spark, dir_stream(spark, f"{path}/in", max_files), path, keep=keep)
