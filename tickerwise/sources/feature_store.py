"""Feature rows materialised window by window into day partitions.

A window covers whole days.  Its days are written with dynamic partition overwrite, so running a window again, or windows that
overlap in any order, gives the same table, and no other partition is touched.  Days of the window without rows lose what an
earlier run left there.  A high-water mark tells the next incremental run where to go on.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerwise.schema import KEY

DAY = "day"


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _midnight(t: dt.datetime | dt.date) -> dt.datetime:
    return dt.datetime(t.year, t.month, t.day)


def high_water_mark(spark: SparkSession, path: str) -> dt.datetime | None:
    """The end of the latest day any run has covered; None before the first run."""
    at, fs = _fs(spark, f"{path}/_mark")
    if not fs.exists(at):
        return None
    marks = [s.getPath().getName() for s in fs.listStatus(at)]
    return max((dt.datetime.fromisoformat(m.replace(".", ":")) for m in marks), default=None)


def materialize_window(view: DataFrame, path: str, start: dt.datetime | dt.date, end: dt.datetime | dt.date, ts: str = "event_timestamp") -> None:
    """Write the rows of ``view`` of all days from that of ``start`` to that of ``end`` (inclusive); rows without a time belong to no day.

    The bounds reach the scan of ``view``.  The mark moves on last: a run lost half way is simply run again.
    """
    spark = view.sparkSession
    first, after = _midnight(start), _midnight(end) + dt.timedelta(days=1)
    if after <= first:
        raise ValueError("the window ends before it starts")
    rows = view.where((F.col(ts) >= F.lit(first)) & (F.col(ts) < F.lit(after))).withColumn(DAY, F.to_date(ts))
    rows.repartition(DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(f"{path}/rows")
    root, fs = _fs(spark, f"{path}/rows")
    days = {r[DAY] for r in rows.select(DAY).distinct().collect()}  # as many as the window has days
    for s in fs.listStatus(root):
        name = s.getPath().getName()
        if name.startswith(f"{DAY}="):
            day = dt.date.fromisoformat(name[len(DAY) + 1:])
            if first.date() <= day < after.date() and day not in days:
                fs.delete(s.getPath(), True)
    mark = max(after, high_water_mark(spark, path) or after)
    at, _ = _fs(spark, f"{path}/_mark/{mark.isoformat().replace(':', '.')}")
    fs.create(at, True).close()


def materialize_incremental(view: DataFrame, path: str, end: dt.datetime | dt.date, start: dt.datetime | dt.date, ts: str = "event_timestamp") -> None:
    """Go on from the high-water mark (from ``start`` in an empty store) to the day of ``end``; nothing to do where the mark is past it.

    The last day covered is written again: it may have been incomplete.
    """
    mark = high_water_mark(view.sparkSession, path)
    begin = _midnight(start) if mark is None else mark - dt.timedelta(days=1)
    if begin <= _midnight(end):
        materialize_window(view, path, begin, end, ts)


def stored_features(spark: SparkSession, path: str, view: DataFrame) -> DataFrame:
    """The materialised rows, in the columns of ``view``; empty before the first run."""
    at, fs = _fs(spark, f"{path}/rows")
    if not fs.exists(at):
        return spark.createDataFrame([], view.schema)
    return spark.read.schema(view.schema).parquet(f"{path}/rows").select(view.columns)


def latest_rows(rows: DataFrame, key: str = KEY, ts: str = "event_timestamp") -> DataFrame:
    """The latest stored row of every ticker."""
    fields = [c for c in rows.columns if c not in (key, ts)]
    return rows.groupBy(key).agg(F.max_by(F.struct(ts, *fields), ts).alias("_r")).select(key, "_r.*").select(rows.columns)
