"""DuckDB SQL building blocks (CTE bodies) mirroring the Spark sources.

These only exist to check the Spark results: each named query has an
equivalent SQL statement assembled from these blocks.
"""

BARS_DAILY = """
SELECT p.p_brand AS ticker, CAST(l.l_shipdate AS DATE) AS Date,
  arg_min(l.l_extendedprice, row(l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice)) AS Open,
  max(l.l_extendedprice) AS High,
  min(l.l_extendedprice) AS Low,
  arg_max(l.l_extendedprice, row(l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice)) AS Close,
  CAST(sum(l.l_quantity) AS BIGINT) AS Volume
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY 1, 2
"""

BARS_HOURLY = """
SELECT event_type AS ticker, date_trunc('hour', ts) AS Date,
  arg_min(value, row(ts, event_id)) AS Open, max(value) AS High, min(value) AS Low,
  arg_max(value, row(ts, event_id)) AS Close, CAST(count(*) AS BIGINT) AS Volume
FROM events GROUP BY 1, 2
"""

# fixed breakage pattern, same constants as tickerwise.sources.tables
DIRTY_TEMPLATE = """
numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY ticker ORDER BY Date) AS BIGINT) AS r FROM {bars}),
broken AS (
  SELECT ticker, Date,
    CASE WHEN r % {neg} = 0 THEN -Open ELSE Open END AS Open,
    CASE WHEN r % 97 = 0 THEN Low ELSE High END AS High,
    CASE WHEN r % 97 = 0 THEN High ELSE Low END AS Low,
    CASE WHEN r % 89 = 0 THEN CAST(NULL AS DOUBLE) ELSE Close END AS Close,
    CASE WHEN r % 83 = 0 THEN CAST(0 AS BIGINT) ELSE Volume END AS Volume,
    r * 2 AS seq, r
  FROM numbered),
{name} AS (
  SELECT ticker, Date, Open, High, Low, Close, Volume, seq FROM broken
  UNION ALL
  SELECT ticker, Date, Open, High, Low, Close + 1, Volume, seq + 1 FROM broken WHERE r % 73 = 0)
"""


def dirty(bars: str = "bars", name: str = "dirty", heavy: bool = False) -> str:
    return DIRTY_TEMPLATE.format(bars=bars, name=name, neg=5 if heavy else 79)


def features(src: str = "bars", windows=(5, 10, 20)) -> str:
    """CTE text producing ``feat_all`` (no dropna) from ``src``; needs the block name ``src``."""
    ma = ",\n".join(
        f"  CASE WHEN count(Close) OVER (PARTITION BY ticker ORDER BY Date ROWS BETWEEN {n-1} PRECEDING AND CURRENT ROW) = {n} "
        f"THEN avg(Close) OVER (PARTITION BY ticker ORDER BY Date ROWS BETWEEN {n-1} PRECEDING AND CURRENT ROW) END AS ma_{n}"
        for n in windows)
    vol = ",\n".join(
        f"  CASE WHEN count(returns) OVER (PARTITION BY ticker ORDER BY Date ROWS BETWEEN {n-1} PRECEDING AND CURRENT ROW) = {n} "
        f"THEN stddev_samp(returns) OVER (PARTITION BY ticker ORDER BY Date ROWS BETWEEN {n-1} PRECEDING AND CURRENT ROW) END AS volatility_{n}"
        for n in windows)
    return f"""
padded AS (
  SELECT *, last_value(Close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _pc
  FROM {src}),
ret AS (
  SELECT * EXCLUDE (_pc, _prev),
    CASE WHEN _prev <> 0 THEN _pc / _prev END - 1.0 AS returns
  FROM (SELECT *, lag(_pc) OVER (PARTITION BY ticker ORDER BY Date) AS _prev FROM padded)),
feat_all AS (
  SELECT *,
{ma},
{vol},
  CAST(CASE WHEN coalesce(lead(Close) OVER (PARTITION BY ticker ORDER BY Date) > Close, false) THEN 1 ELSE 0 END AS INTEGER) AS target
  FROM ret)
"""


def not_null(cols) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


FEATURE_COLS = ["Open", "High", "Low", "Close", "Volume", "returns", "ma_5", "ma_10", "ma_20",
                "volatility_5", "volatility_10", "volatility_20", "target"]


def r6(cols) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)
