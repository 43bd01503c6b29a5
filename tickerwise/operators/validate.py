"""Data-contract validation (V1-V10) as table operators.

The table forms compute every check for every ticker in one pass; the
``strict`` wrappers raise :class:`DataValidationError` in the reference's
order when a check fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerwise.functions.exprs import null_safe_bool
from tickerwise.operators.clean import nan_to_null
from tickerwise.schema import (
    EXAMPLES_SHOWN, FRESHNESS_MAX_DAYS, INTEGRITY_RULES, KEY, MAX_REMOVAL_PCT, OHLCV, ORDER,
    QUALITY_ACCEPTABLE_PCT, QUALITY_GRADES, REQUIRED_COLUMNS,
)


class DataValidationError(ValueError):
    """Raised by the strict wrappers when the data contract is broken."""


# ---------------------------------------------------------------- V1 schema
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def validate_schema(df: DataFrame, order: str = ORDER) -> DataFrame:
    """V1: required columns present, Date convertible, OHLCV numeric.

    Metadata-only except for string dates, which are parsed with
    ``try_to_date``; an unparsable non-null string raises.  Returns the frame
    with ``Date`` as DATE.  Extra columns are tolerated.
    """
    missing = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    if missing:
        raise DataValidationError(f"missing required columns: {missing}")
    types = {f.name: f.dataType for f in df.schema.fields}
    for c in OHLCV:
        if not isinstance(types[c], NUMERIC):
            raise DataValidationError(f"column {c} must be numeric, got {types[c].simpleString()}")
    dt = types[order]
    if isinstance(dt, T.StringType):
        parsed = F.try_to_date(F.col(order))
        bad = df.filter(F.col(order).isNotNull() & parsed.isNull()).limit(1).count()
        if bad:
            raise DataValidationError(f"column {order} holds values that are not dates")
        df = df.withColumn(order, parsed)
    elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        df = df.withColumn(order, F.to_date(order))
    elif not isinstance(dt, T.DateType):
        raise DataValidationError(f"column {order} must be a date, got {dt.simpleString()}")
    return df


# ------------------------------------------------------------- V2 time rules
ARRIVALS_PER_RUN = 100_000  # arrivals of a ticker compared with their predecessor by one task


def _out_of_order(df: DataFrame, seq: str, key: str, order: str) -> DataFrame:
    """Per ticker: arrivals with an earlier date than the arrival before them.

    Raw arrivals of a ticker have no bound, so they are cut into runs of consecutive ``seq``; a run is ordered by one
    task, and the step from run to run is taken between the runs' last and first dates.
    """
    runs = df.withColumn("_run", F.floor(F.col(seq) / ARRIVALS_PER_RUN))
    inside = Window.partitionBy(key, "_run").orderBy(seq)
    down = null_safe_bool(F.lag(order).over(inside) > F.col(order))
    per_run = (runs.withColumn("_down", down).groupBy(key, "_run")
               .agg(F.count_if("_down").alias("_n"), F.min_by(order, seq).alias("_first"), F.max_by(order, seq).alias("_last")))
    step = null_safe_bool(F.lag("_last").over(Window.partitionBy(key).orderBy("_run")) > F.col("_first"))
    return (per_run.withColumn("_step", step).groupBy(key)
            .agg((F.sum("_n") + F.count_if("_step")).cast("bigint").alias("n_out_of_order")))


def time_contract(df: DataFrame, seq: str | None = "seq", key: str = KEY, order: str = ORDER) -> DataFrame:
    """V2: per ticker duplicates (fail), arrival order not ascending (fail), weekend rows (flag).

    Duplicates are counted by (ticker, Date) with map-side combine; the dates of the first EXAMPLES_SHOWN repeated rows
    in arrival order are listed.  Without a ``seq`` column the arrival order is unknown and taken as ascending.
    """
    has_seq = bool(seq) and seq in df.columns
    rows = df.select(key, order, *([seq] if has_seq else []))
    per_date = rows.groupBy(key, order).agg(F.count(F.lit(1)).alias("_n"))
    repeats = F.when(F.col(order).isNotNull(), F.col("_n") - 1).otherwise(0)
    agg = per_date.groupBy(key).agg(F.sum("_n").cast("bigint").alias("n_rows"), F.sum(repeats).cast("bigint").alias("n_duplicates"),
                                    F.sum(F.when(F.weekday(order) >= 5, F.col("_n")).otherwise(0)).cast("bigint").alias("n_weekend"))
    arrival = seq if has_seq else order
    nth = F.row_number().over(Window.partitionBy(key, order).orderBy(arrival))
    again = rows.where(F.col(order).isNotNull()).withColumn("_nth", nth).where("_nth > 1")
    first = (again.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(arrival))).where(F.col("_rank") <= EXAMPLES_SHOWN)
             .groupBy(key).agg(F.array_sort(F.collect_list(order)).alias("duplicate_examples")).withColumnRenamed(key, "_k1"))
    out = agg.join(first, agg[key].eqNullSafe(first["_k1"]), "left")
    if has_seq:
        unsorted = _out_of_order(rows, seq, key, order).withColumnRenamed(key, "_k2")
        out = out.join(unsorted, agg[key].eqNullSafe(unsorted["_k2"]), "left")
    else:
        out = out.withColumn("n_out_of_order", F.lit(0).cast("bigint"))
    out = out.select(key, "n_rows", "n_duplicates", F.coalesce("duplicate_examples", F.expr("array()").cast(out.schema["duplicate_examples"].dataType)).alias("duplicate_examples"),
                     "n_out_of_order", "n_weekend")
    return out.withColumns({
        "is_sorted": F.col("n_out_of_order") == 0,
        "passed": (F.col("n_duplicates") == 0) & (F.col("n_out_of_order") == 0),
    })


# ------------------------------------------------------- V3-V5 integrity rules
def first_violation(prefix: str = "") -> Column:
    """V3: name of the first broken rule (rules applied in sequence), NULL if none.

    NULL operands never break a rule (pandas compares NaN as false).
    """
    o, h, l, c, v = (F.col(prefix + x) for x in OHLCV)
    conds = [
        (o <= 0) | (h <= 0) | (l <= 0) | (c <= 0),
        v < 0,
        h < l,
        h < o,
        h < c,
        l > o,
        l > c,
    ]
    expr = None
    for name, cond in zip(INTEGRITY_RULES, conds):
        cond = null_safe_bool(cond)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def integrity_flags(df: DataFrame) -> DataFrame:
    """Rows with the first rule they break; a NaN cell is a missing one and breaks none."""
    return nan_to_null(df).withColumn("first_violation", first_violation())


def integrity_filter(df: DataFrame) -> DataFrame:
    """V3: rows that pass every rule."""
    return integrity_flags(df).filter(F.col("first_violation").isNull()).drop("first_violation")


def integrity_breakdown(df: DataFrame, key: str = KEY) -> DataFrame:
    """V4: rows removed per (ticker, rule)."""
    return (integrity_flags(df).filter(F.col("first_violation").isNotNull())
            .groupBy(key, F.col("first_violation").alias("rule")).agg(F.count(F.lit(1)).alias("n_rows")))


def integrity_gate(df: DataFrame, key: str = KEY, max_pct: float = MAX_REMOVAL_PCT) -> DataFrame:
    """V5: per ticker rows before / removed, removal %, passed = removal % <= 10."""
    bad = F.col("first_violation").isNotNull()
    return (integrity_flags(df).groupBy(key)
            .agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(bad).alias("rows_removed"))
            .withColumn("removal_pct", F.col("rows_removed").cast("double") * 100.0 / F.col("rows_before"))
            .withColumn("passed", F.col("removal_pct") <= F.lit(max_pct)))


# ----------------------------------------------------------- V6 missing data
def missing_counts(df: DataFrame, key: str = KEY, cols=OHLCV) -> DataFrame:
    """V6: missing (NULL or NaN) cells per (ticker, column); passed when the column has none."""
    agg = nan_to_null(df).groupBy(key).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = ", ".join(f"'{c}', `{c}`" for c in cols)
    return (agg.selectExpr(key, f"stack({len(cols)}, {stacked}) AS (`column`, n_missing)")
            .withColumn("passed", F.col("n_missing") == 0))


# ------------------------------------------------------- V7 summary statistics
def bar_summary(df: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """V7: one row per ticker: rows, date range, Close and Volume statistics (of the cells present)."""
    return nan_to_null(df).groupBy(key).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min(order).alias("start_date"),
        F.max(order).alias("end_date"),
        F.min("Close").alias("close_min"),
        F.max("Close").alias("close_max"),
        F.avg("Close").alias("close_mean"),
        F.stddev_samp("Close").alias("close_std"),
        F.avg("Volume").alias("volume_mean"),
        F.min("Volume").alias("volume_min"),
        F.max("Volume").alias("volume_max"),
    )


# --------------------------------------------------------------- V8 validator
def validate_bars(df: DataFrame, seq: str | None = "seq", key: str = KEY, order: str = ORDER):
    """V8: schema -> time -> integrity -> missing -> stats.

    Returns ``(valid_rows, stats)``; ``stats`` has one row per ticker with the
    summary of the valid rows, rows before/removed, the rule breakdown as a
    MAP and a ``passed`` verdict over every check (all evaluated, not only up
    to the first failure).

    The row statistics are one aggregate over rows flagged once (first broken
    rule), with map-side combine; the time contract's per-ticker row is joined to it.
    """
    df = nan_to_null(validate_schema(df, order))
    valid = integrity_filter(df)
    fv = F.col("first_violation")
    ok = fv.isNull()
    flagged = df.withColumn("first_violation", first_violation())
    times = time_contract(df, seq, key, order).select(F.col(key).alias("_key"), "n_duplicates", "n_out_of_order", "n_weekend")

    def on_valid(c: str):
        return F.when(ok, F.col(c))

    missing_cells = sum((F.col(c).isNull().cast("bigint") for c in OHLCV), F.lit(0).cast("bigint"))
    rule_counts = [F.struct(F.lit(r).alias("rule"), F.count_if(fv == r).alias("n_rows")) for r in INTEGRITY_RULES]
    stats = (flagged.groupBy(key).agg(
        F.count_if(ok).alias("total_rows"),
        F.min(on_valid(order)).alias("start_date"),
        F.max(on_valid(order)).alias("end_date"),
        F.min(on_valid("Close")).alias("close_min"),
        F.max(on_valid("Close")).alias("close_max"),
        F.avg(on_valid("Close")).alias("close_mean"),
        F.stddev_samp(on_valid("Close")).alias("close_std"),
        F.avg(on_valid("Volume")).alias("volume_mean"),
        F.min(on_valid("Volume")).alias("volume_min"),
        F.max(on_valid("Volume")).alias("volume_max"),
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(~ok).alias("rows_removed"),
        F.map_from_entries(F.filter(F.array(*rule_counts), lambda e: e["n_rows"] > 0)).alias("invalid_row_breakdown"),
        F.sum(F.when(ok, missing_cells)).cast("bigint").alias("n_missing"))
        .withColumn("removal_pct", F.col("rows_removed").cast("double") * 100.0 / F.col("rows_before"))
        .withColumn("integrity_passed", F.col("removal_pct") <= F.lit(MAX_REMOVAL_PCT))
        .join(times, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
        .withColumn("time_passed", (F.col("n_duplicates") == 0) & (F.col("n_out_of_order") == 0))
        .withColumn("passed", F.col("time_passed") & F.col("integrity_passed")
                    & (F.coalesce("n_missing", F.lit(0)) == 0))
        .drop("n_out_of_order"))
    return valid, stats


def validate_bars_strict(df: DataFrame, seq: str | None = "seq", key: str = KEY, order: str = ORDER):
    """Raise on the first failing ticker/check, in the reference's check order."""
    valid, stats = validate_bars(df, seq, key, order)
    bad = (stats.filter(~F.col("passed"))
           .select(key, "time_passed", "integrity_passed", "n_missing", "removal_pct", "n_duplicates")
           .orderBy(key).limit(1).collect())
    if bad:
        r = bad[0]
        if not r["time_passed"]:
            raise DataValidationError(f"time validation failed for {r[key]}: {r['n_duplicates']} duplicates or unsorted")
        if not r["integrity_passed"]:
            raise DataValidationError(f"integrity validation failed for {r[key]}: removed {r['removal_pct']:.1f}%")
        raise DataValidationError(f"missing data validation failed for {r[key]}: {r['n_missing']} missing")
    return valid, stats


# ----------------------------------------------------------- V9, V10
def quality_grade(rows_removed: Column, rows_before: Column) -> Column:
    """V9: EXCELLENT (nothing removed) / ACCEPTABLE (< 5 % removed) / NEEDS REVIEW."""
    excellent, acceptable, review = QUALITY_GRADES
    return (F.when(rows_removed == 0, F.lit(excellent))
            .when(rows_removed < rows_before * F.lit(QUALITY_ACCEPTABLE_PCT / 100.0), F.lit(acceptable))
            .otherwise(F.lit(review)))


def freshness(df: DataFrame, as_of: Column, key: str = KEY, order: str = ORDER,
              max_days: int = FRESHNESS_MAX_DAYS) -> DataFrame:
    """Days since the last bar of each ticker; stale when > max_days."""
    return (df.groupBy(key).agg(F.max(order).alias("last_date"))
            .withColumn("age_days", F.datediff(as_of, F.col("last_date")))
            .withColumn("stale", F.col("age_days") > max_days))
