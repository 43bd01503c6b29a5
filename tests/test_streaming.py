"""Streaming twins equal their batch operators (availableNow runs, file sources)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickerwise.operators import features as feat
from tickerwise.sources import bars_daily, dirty_bars
from tickerwise.operators.serving import asof_features
from tickerwise.streaming import dedup, jobs, lookup
from tickerwise.streaming.table import EpochTable
from tests.conftest import SF_SMALL

COLS = ["ticker", "Date", "Close", "returns", "ma_5", "ma_10", "ma_20", "volatility_5", "volatility_10", "volatility_20"]


def rounded(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*COLS).collect())


def test_stream_features_equal_batch(spark):
    bars = bars_daily(spark, SF_SMALL)
    stream = jobs.run_stream_features(spark, bars)
    batch = feat.add_rolling_volatility(feat.add_rolling_means(bars))
    assert rounded(stream) == rounded(batch)


def test_stream_features_drops_late_bars(spark):
    rows = [("T", dt.date(2021, 1, d), float(d)) for d in (4, 5, 6, 7)]
    late = [("T", dt.date(2021, 1, 5), 99.0)]
    path = jobs.run_dir(spark, "late-test")
    spark.createDataFrame(rows, "ticker string, Date date, Close double").coalesce(1).write.parquet(f"{path}/in")
    spark.createDataFrame(late, "ticker string, Date date, Close double").coalesce(1).write.mode("append").parquet(
        f"{path}/in")
    from pyspark.sql.streaming.state import GroupStateTimeout
    s = jobs.dir_stream(spark, f"{path}/in", 1)
    out = s.groupBy("ticker").applyInPandasWithState(jobs._rolling_update, jobs.FEATURE_OUT, jobs.FEATURE_STATE,
                                                     "append", GroupStateTimeout.NoTimeout)
    res = jobs._sink_append(out, path)
    assert sorted(r["Close"] for r in res.collect()) == [4.0, 5.0, 6.0, 7.0]


def test_stream_bars_equal_batch_bars(spark):
    from tickerwise.sources import bars_hourly
    stream = jobs.run_stream_bars(spark, SF_SMALL)
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, bars_hourly(spark, SF_SMALL).collect()))


EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def event_files(spark, path, *files):
    for rows in files:
        spark.createDataFrame([(i, dt.datetime(2021, 1, 4, h, m), 1, "view", v) for i, h, m, v in rows], EVENTS).coalesce(1) \
            .write.mode("append").parquet(f"{path}/in")
    return jobs.dir_stream(spark, f"{path}/in", 1)


def test_windowed_streams_take_rows_within_the_watermark_and_drop_later_ones(spark):
    path = jobs.run_dir(spark, "late-events")
    # second file: one row 30 minutes late (taken), then time moves on to 15:00, which holds from the batch after next;
    # fourth: one row 4 hours late (dropped)
    ev = event_files(spark, path, [(1, 9, 50, 10.0), (2, 10, 20, 20.0)], [(3, 9, 55, 30.0), (4, 15, 0, 40.0)], [(6, 15, 10, 50.0)], [(5, 10, 30, 99.0), (7, 15, 20, 60.0)])
    got = {r["Date"].hour: tuple(r)[2:] for r in jobs._sink_upsert(jobs.hourly_bars_stream(ev), path + "/a", ["ticker", "Date"]).collect()}
    assert got == {9: (10.0, 30.0, 10.0, 30.0, 2), 10: (20.0, 20.0, 20.0, 20.0, 1), 15: (40.0, 60.0, 40.0, 60.0, 3)}
    ev = jobs.dir_stream(spark, f"{path}/in", 1)
    counts = {r["hour"].hour: r["requests"] for r in jobs._sink_upsert(jobs.request_counts_stream(ev), path + "/b", ["hour", "endpoint", "status"]).collect()}
    assert counts == {9: 2, 10: 1, 15: 3}
    hist = jobs._sink_upsert(jobs.latency_histogram_stream(jobs.dir_stream(spark, f"{path}/in", 1)), path + "/c", ["hour", "endpoint", "le"]).collect()
    assert {(r["hour"].hour, r["le"]): r["count"] for r in hist if r["le"] in ("0.1", "0.25", "+Inf")} == {
        (9, "0.1"): 1, (9, "0.25"): 1, (9, "+Inf"): 2, (10, "0.1"): 0, (10, "0.25"): 1, (10, "+Inf"): 1, (15, "0.1"): 0, (15, "0.25"): 0, (15, "+Inf"): 3}


def test_stream_dedup_last_holds_every_bar(spark):
    dirty = dirty_bars(spark, SF_SMALL)
    out = dedup.run_stream_dedup(spark, dirty, "last")
    want = dirty.groupBy("ticker", "Date").agg(F.max("seq").alias("seq"))
    assert sorted(map(tuple, out.select("ticker", "Date", "seq").collect())) == sorted(map(tuple, want.collect()))


def test_stream_dedup_keeps_first_arrival(spark):
    dirty = dirty_bars(spark, SF_SMALL)
    out = dedup.run_stream_dedup(spark, dirty, "first")
    assert out.count() == dirty.select("ticker", "Date").distinct().count()
    assert out.filter(F.col("seq") % 2 == 1).count() == 0


@pytest.mark.parametrize("n", [1])
def test_stream_online_snapshot_latest(spark, n):
    rows = [("A", dt.datetime(2021, 1, d), float(d)) for d in (1, 3, 2)] + [("B", dt.datetime(2021, 1, 1), 9.0)]
    v = spark.createDataFrame(rows, "ticker string, event_timestamp timestamp_ntz, f double")
    got = {r["ticker"]: r["f"] for r in jobs.run_stream_online_snapshot(spark, v, max_files=n).collect()}
    assert got == {"A": 3.0, "B": 9.0}


def test_stream_features_pad_and_zero_base_like_batch(spark):
    rows = [("T", dt.date(2021, 1, d), c) for d, c in [(4, 10.0), (5, None), (6, 12.0), (7, 0.0), (8, 5.0), (11, 6.0)]]
    bars = spark.createDataFrame(rows, "ticker string, Date date, Close double")
    stream = jobs.run_stream_features(spark, bars)
    batch = feat.add_rolling_volatility(feat.add_rolling_means(bars))
    assert rounded(stream) == rounded(batch)


def test_stream_features_pad_across_long_gap(spark):
    # 30 missing closes in a row, spread over several micro-batches: the pad value must survive the state buffer
    closes = [10.0, 11.0] + [None] * 30 + [12.0, 13.0]
    rows = [("T", dt.date(2021, 1, 1) + dt.timedelta(days=i), c) for i, c in enumerate(closes)]
    bars = spark.createDataFrame(rows, "ticker string, Date date, Close double")
    stream = jobs.run_stream_features(spark, bars, max_files=1)
    batch = feat.add_rolling_volatility(feat.add_rolling_means(bars))
    assert rounded(stream) == rounded(batch)


def test_stream_dedup_last_prefers_highest_seq_not_arrival(spark):
    schema = "ticker string, Date date, Close double, seq long"
    d1 = dt.date(2021, 1, 4)
    path = jobs.run_dir(spark, "dedup-last-test")
    # the correction (seq 3) arrives BEFORE the original (seq 2); a far later bar closes d1, then a row for d1 is too late
    d2 = d1 + dt.timedelta(days=20)
    for batch in ([("T", d1, 2.0, 3)], [("T", d1, 1.0, 2)], [("T", d2, 5.0, 9)], [("T", d2, 6.0, 10)], [("T", d1, 7.0, 11)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
    s = jobs.dedup_last_stream(jobs.dir_stream(spark, f"{path}/in", 1))
    out = jobs._sink_upsert(s, path, ["ticker", "Date"]).collect()
    assert sorted((r["Date"], r["Close"], r["seq"]) for r in out) == [(d1, 2.0, 3), (d2, 6.0, 10)]


BAR = "ticker string, Date date, Close double, seq long"


@pytest.mark.parametrize("keep", ["first", "last"])
def test_dedup_does_not_depend_on_partitions_or_arrival_order(spark, keep):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(60)]
    rows = [("A" if i % 3 else "B", d, float(i), 2 * i) for i, d in enumerate(days)]
    rows += [(t, d, c + 1, s + 1) for t, d, c, s in rows[::4]] + [(t, d, c + 2, s - 200) for t, d, c, s in rows[::5]]
    rows += rows[::7] + [("A", days[1], -1.0, None), ("A", None, 1.0, 5), (None, days[0], 2.0, 6), (None, days[0], 3.0, 6), ("C", days[0], None, None)]
    want = {}
    for t, d, c, s in rows:
        rank = (-(2**63) if s is None else s) * (1 if keep == "last" else -1)
        row = (rank, (c is not None, c or 0.0), (t, d, c, s))
        want[t, d] = max(want.get((t, d), row), row, key=lambda x: x[:2])
    want = sorted((x[2] for x in want.values()), key=str)
    df, saved = spark.createDataFrame(rows, BAR), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n, files in ((3, 1), (17, 5), (64, 9)):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            shuffled = df.orderBy(F.rand(seed=n))
            assert sorted(map(tuple, dedup.run_stream_dedup(spark, shuffled, keep, files=files, max_files=2).collect()), key=str) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)


def test_dedup_state_ends_and_the_table_still_holds_the_best_row(spark):
    d, path = dt.date(2021, 1, 4), jobs.run_dir(spark, "dedup-expiry")
    for batch in ([("T", d, 3.0, 3)], [("U", d, 1.0, 1)], [("V", d, 1.0, 1)], [("T", d, 2.0, 2)], [("T", d, 9.0, 9)]):
        spark.createDataFrame(batch, BAR).coalesce(1).write.mode("append").parquet(f"{path}/in")
    out = dedup.run_dedup(spark, jobs.dir_stream(spark, f"{path}/in", 1), path, keep="last", hold_ms=1)  # state goes with the next arrival
    assert sorted(map(tuple, out.collect())) == [("T", d, 9.0, 9), ("U", d, 1.0, 1), ("V", d, 1.0, 1)]
    with pytest.raises(ValueError):
        dedup.best_arrivals(jobs.dir_stream(spark, f"{path}/in"), keep="any")


REQUESTS, VIEW = "request_id long, ticker string, event_timestamp timestamp_ntz", "ticker string, event_timestamp timestamp_ntz, f double, g string"


def lookup_rows():
    """Requests at, before and after feature rows, at the TTL's edge, of unknown and missing tickers; one hot ticker."""
    t0, rows, asked = dt.datetime(2021, 1, 1), [], []
    for i in range(40):
        rows.append(("A", t0 + dt.timedelta(hours=7 * i), float(i), None if i % 3 else "x"))
        if i % 4 == 0:
            rows.append(("B", t0 + dt.timedelta(hours=9 * i), None, "y"))
    for i in range(120):
        asked.append((i, ("A", "A", "B", "Z", None)[i % 5], t0 + dt.timedelta(hours=2 * i, minutes=(i % 3) * 30)))
    asked += [(500, "A", t0 + dt.timedelta(days=1)), (501, "B", t0 + dt.timedelta(hours=36)), (502, "A", t0 - dt.timedelta(days=3)), (503, "A", t0 + dt.timedelta(days=90))]
    return asked, rows


@pytest.mark.parametrize("ttl,files,max_files", [(1, 2, (None, None)), (0.25, 1, (1, 5)), (2.5, 3, (12, 3))])
def test_stream_lookup_equals_the_batch_lookup(spark, ttl, files, max_files):
    asked, rows = lookup_rows()
    req, view = spark.createDataFrame(asked, REQUESTS), spark.createDataFrame(rows, VIEW)
    got = lookup.run_stream_lookup(spark, req, view, ttl_days=ttl, files=files, max_files=max_files)
    want = asof_features(req, view, ttl_days=ttl)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_stream_lookup_in_any_order_within_the_delay(spark):
    asked, rows = lookup_rows()
    req, view = spark.createDataFrame(asked, REQUESTS), spark.createDataFrame(rows, VIEW)
    path = jobs.run_dir(spark, "lookup-order")
    for name, table, seed in (("r", req, 1), ("v", view, 2)):
        for part in table.randomSplit([1.0] * 4, seed=seed):  # each file spans all times
            part.coalesce(1).write.mode("append").parquet(f"{path}/{name}")
        lookup.close_stream(f"{path}/{name}", table, "event_timestamp", dt.datetime(2022, 6, 1))
    streams = [jobs.dir_stream(spark, f"{path}/{n}", k) for n, k in (("r", 1), ("v", 2))]
    got = jobs._sink_append(lookup.lookup_stream(*streams, ttl_days=1, delay="150 days"), path)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, asof_features(req, view, ttl_days=1).collect()), key=str)


def epoch_batches(n):
    return [[(k, float(e), None if k % 3 else f"e{e}") for k in range(7) if (e + k) % 4 == 0 or e == 0] for e in range(n)]


def newest(batches):
    want = {}
    for b in batches:
        want.update({r[0]: r for r in b})
    return sorted(want.values())


def test_table_of_many_epochs_stays_in_few_folders(spark):
    schema = spark.createDataFrame([], "k long, v double, s string").schema
    path = jobs.run_dir(spark, "epochs")
    table, batches = EpochTable(spark, path, schema, ["k"], fanout=4), epoch_batches(50)
    assert table.read().count() == 0
    for e, rows in enumerate(batches):
        table.publish(spark.createDataFrame(rows, schema).coalesce(1), e)
        assert len(table.parts()) <= 3 * 3
    assert sorted(map(tuple, table.read().collect())) == newest(batches)
    assert [(p.first, p.last) for p in table.parts()][0] == (0, 15) and table.parts()[-1].last == 49
    names = {s.getPath().getName() for s in table._fs.listStatus(table._path(path))}
    assert len(names) <= 20 and len(table._manifests()) == 3


def test_table_survives_a_retry_and_a_crash_between_the_steps(spark, monkeypatch):
    schema = spark.createDataFrame([], "k long, v double, s string").schema
    path = jobs.run_dir(spark, "epochs-crash")
    table, batches = EpochTable(spark, path, schema, ["k"], fanout=2), epoch_batches(12)
    frames = [spark.createDataFrame(b, schema).coalesce(1) for b in batches]
    for e, f in enumerate(frames):
        reader = table.read()
        for step in ("_publish_manifest", "_merged", "_clean"):  # the epoch fails at each step before it goes through
            def fail(*a, **k):
                raise RuntimeError("lost")
            with monkeypatch.context() as m:
                m.setattr(table, step, fail)
                try:
                    table.publish(f, e)
                except RuntimeError:
                    pass
            if step == "_publish_manifest":  # nothing published yet: the old table, for old and new readers
                assert sorted(map(tuple, reader.collect())) == sorted(map(tuple, table.read().collect())) == newest(batches[:e])
        table.publish(f, e)
        table.publish(f, e)
        assert sorted(map(tuple, table.read().collect())) == newest(batches[:e + 1])


def test_ranked_table_keeps_the_best_row_whatever_the_epoch(spark):
    schema = spark.createDataFrame([], "k long, v double").schema
    table = EpochTable(spark, jobs.run_dir(spark, "ranked"), schema, ["k"], rank=F.col("v"), fanout=2)
    for e, v in enumerate([3.0, 9.0, 1.0, None, 5.0]):
        table.publish(spark.createDataFrame([(1, v), (2, -(v or 0.0))], schema), e)
    assert sorted(map(tuple, table.read().collect())) == [(1, 9.0), (2, 0.0)]
    with pytest.raises(ValueError):
        EpochTable(spark, "x", schema, ["k"], fanout=1)


REPLAYS = {
    "stream_dedup": (dedup, lambda spark, bars: dedup.run_stream_dedup(spark, bars, "first")),
    "stream_dedup_last": (dedup, lambda spark, bars: dedup.run_stream_dedup(spark, bars, "last")),
    "stream_online_snapshot": (jobs, lambda spark, bars: jobs.run_stream_online_snapshot(spark, bars, ts="Date")),
    "stream_features": (jobs, lambda spark, bars: jobs.run_stream_features(spark, bars)),
}


@pytest.mark.parametrize("name", REPLAYS)
def test_replay_cost_does_not_follow_the_shuffle_partitions(spark, monkeypatch, tmp_path, name):
    module, run = REPLAYS[name]
    monkeypatch.setattr(module, "run_dir", lambda spark, name: f"file://{tmp_path}/{name}")
    rows = [("T%d" % (i % 9), dt.date(2021, 1, 1) + dt.timedelta(days=i // 9), float(i), i) for i in range(270)]
    bars, saved = spark.createDataFrame(rows, BAR).repartition(3), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "20")
        out = run(spark, bars).collect()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "20"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)
    assert len(out) == (9 if name == "stream_online_snapshot" else len(rows))
    checkpoint = next(tmp_path.glob("*/checkpoint"))
    assert 1 < len([p for p in (checkpoint / "commits").iterdir() if p.name.isdigit()]) <= jobs.REPLAY_BATCHES + 1
    assert len([p for p in (checkpoint / "state" / "0").iterdir() if p.name.isdigit()]) <= spark.sparkContext.defaultParallelism
