"""File sources and sinks.

CSV bar files are read with every column as text and cast BY NAME, so a
file whose columns come in another order (``Date,Open,Close,High,Low,Volume``)
lands in the bar contract unchanged.  Casts are ``try_cast``: a bad cell
(a text ``NaN`` too) becomes NULL and the contract checks (V1, V6) report it instead of the read
failing half way through a large scan.  Many files are read in one scan; the
ticker comes from each file's name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerwise.schema import KEY, OHLCV, ORDER

# ---- fixed values: bar file names are <ticker>_raw.csv / <ticker>_processed.csv / <ticker>_snapshot.csv ----
FILE_TICKER_PATTERN = r"^(.+)_(raw|processed|snapshot)\.csv$"
# ---- end of fixed values ----


def read_bars_csv(spark: SparkSession, path: str, ticker: str | None = None) -> DataFrame:
    """CSV bars -> (ticker, Date, Open, High, Low, Close, Volume, extra columns...).

    ``path`` may be a file, a folder or a glob.  Without ``ticker`` the key is
    taken from the ticker column where there is one (``write_bars`` makes it a
    folder name), else from the file name (``BBCA.JK_raw.csv`` -> ``BBCA.JK``).
    Extra columns (processed features) are kept, cast to DOUBLE.
    """
    reader = spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE")
    raw = reader.csv(path)
    if dict(raw.dtypes).get(KEY, "string") != "string":  # folder names are typed by their looks: 0700 would come back as 700
        raw = reader.schema(", ".join(f"`{c}` string" for c in raw.columns)).csv(path)
    key = (F.lit(ticker) if ticker is not None else F.col(KEY) if KEY in raw.columns else
           F.regexp_extract(F.col("_metadata.file_name"), FILE_TICKER_PATTERN, 1))
    cols = [key.alias(KEY)]
    for c in raw.columns:
        if c == KEY:
            continue
        if c == ORDER:
            cols.append(F.try_to_date(F.col(c)).alias(ORDER))
        elif c == "Volume":
            cols.append(F.nanvl(F.col(c).try_cast("double"), F.lit(None).cast("double")).try_cast("bigint").alias(c))
        elif c == "target":
            cols.append(F.nanvl(F.col(c).try_cast("double"), F.lit(None).cast("double")).try_cast("int").alias(c))
        else:
            value = F.col(c).try_cast("double")
            cols.append(F.nanvl(value, F.lit(None).cast("double")).alias(c))  # a text NaN is a missing cell
    df = raw.select(*cols)
    lead = [KEY, ORDER] + [c for c in OHLCV if c in df.columns]
    return df.select(*lead, *[c for c in df.columns if c not in lead])


def write_bars(df: DataFrame, path: str, fmt: str = "parquet", key: str = KEY) -> None:
    """Bars or features partitioned by ticker, so a per-ticker read prunes partitions.

    No shuffle before the write: a hot ticker holding a third of the rows
    would otherwise land in one task.  Each task sorts its own rows by the
    partition column (the writer does this) and writes one file per ticker
    it holds; ``maxRecordsPerFile`` caps file size.
    """
    w = (df.write.mode("overwrite").partitionBy(key)
         .option("maxRecordsPerFile", 5_000_000))
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_json_report(report: DataFrame, path: str, column: str = "report") -> None:
    """One JSON document per row (e.g. ``drift_report_json``) as text files."""
    report.select(column).write.mode("overwrite").text(path)


def load_and_compare(spark: SparkSession, reference_path: str, current_path: str,
                     ticker: str | None = None) -> DataFrame:
    """Two bar/feature files as ONE frame with ``sample`` = 'ref' / 'cur' (the drift input).

    Columns present in only one file are kept (NULL on the other side).
    """
    ref = read_bars_csv(spark, reference_path, ticker).withColumn("sample", F.lit("ref"))
    cur = read_bars_csv(spark, current_path, ticker).withColumn("sample", F.lit("cur"))
    return ref.unionByName(cur, allowMissingColumns=True)
