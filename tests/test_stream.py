"""Streaming monitor: stream = batch, restart from the checkpoint without
duplicates, baseline rules, burst fold (X1-X8)."""

import datetime as dt

from pyspark.sql import functions as F

from filingflow.session import new_run_dir
from filingflow.streaming.cycles import baseline_key, burst_log, fold_cycles, next_look_ahead, poll, stored_last_key, watch
from filingflow.streaming.monitor import MonitorPaths, daily_counts, run_daily_counts, run_monitor, sink_rows, time_slices, write_drop

SCHEMA = "event_id long, ts timestamp_ntz, kind string"


def events(spark, ids, start=dt.datetime(2026, 3, 1)):
    return spark.createDataFrame([(i, start + dt.timedelta(hours=i), "x") for i in ids], SCHEMA)


def paths(spark):
    run = new_run_dir(spark, "test-monitor")
    return MonitorPaths(f"{run}/landing", f"{run}/sink", f"{run}/state", f"{run}/ckpt")


def test_next_look_ahead():
    assert next_look_ahead(5, 3) == (10, "burst")
    assert next_look_ahead(5, 2) == (5, "normal")
    assert next_look_ahead(5, 0) == (5, "idle")
    assert next_look_ahead(160, 158) == (200, "burst")
    assert next_look_ahead(200, 199) == (200, "burst")


def test_stream_equals_batch_and_restart(spark):
    p = paths(spark)
    e = events(spark, range(1, 41))
    for drop in (*time_slices(e, 2, "ts"), e.filter(F.col("event_id") % 4 == 0)):  # the last: duplicates
        write_drop(drop, p.landing)
    schema = e.schema
    run_monitor(spark, p, schema, baseline=10, key_col="event_id", max_files=1)
    got = sorted(r.key for r in spark.read.parquet(p.sink).collect())
    assert got == list(range(11, 41))
    assert stored_last_key(spark, p.state) == 40
    # new files arrive; restarting from the checkpoint adds only the new keys
    write_drop(events(spark, range(38, 46)), p.landing)
    run_monitor(spark, p, schema, baseline=10, key_col="event_id", max_files=1)
    got2 = sorted(r.key for r in spark.read.parquet(p.sink).collect())
    assert got2 == list(range(11, 46))
    assert stored_last_key(spark, p.state) == 45
    fold_cycles(spark, p.state)
    b = burst_log(spark, p.state).orderBy("batch_id").collect()
    assert sum(r.new_count for r in b) == 35
    assert any(r.mode == "burst" for r in b)


def test_baseline(spark):
    p = paths(spark)
    cached = spark.createDataFrame([(7,), (3,)], "key long")
    assert baseline_key(spark, p.state, None) == 0
    assert baseline_key(spark, p.state, cached) == 7
    assert baseline_key(spark, p.state, cached, start_key=5) == 7
    assert baseline_key(spark, p.state, cached, start_key=50) == 50


def test_daily_counts(spark):
    run = new_run_dir(spark, "test-daily")
    e = events(spark, range(0, 100))
    a, b, c = time_slices(e, 3, "ts")
    for drop in (a, c, b):  # the middle days come last and still count
        write_drop(drop, f"{run}/landing")
        out = run_daily_counts(spark, f"{run}/landing", f"{run}/out", f"{run}/ckpt", e.schema)
    expect = {r.day: r.n for r in e.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"))
                                   .agg(F.count("*").alias("n")).collect()}
    assert {r.day: r.n_events for r in out.collect()} == expect


def test_late_new_key_is_kept(spark):
    """A new key whose event time is days behind is stored like any other."""
    p = paths(spark)
    schema = "event_id long, ts timestamp_ntz"
    day = dt.datetime(2026, 3, 1)
    for rows in ([(10, day), (11, day)], [(12, day + dt.timedelta(days=30))],
                 [(13, day - dt.timedelta(days=60)), (14, day + dt.timedelta(days=31)), (14, day)]):
        df = spark.createDataFrame(rows, schema)
        write_drop(df, p.landing)
        run_monitor(spark, p, df.schema, baseline=0, key_col="event_id")
    assert sorted(r.key for r in spark.read.parquet(p.sink).collect()) == [10, 11, 12, 13, 14]


def test_replay_counts_alike_and_fold_is_per_source(spark):
    """Two sources; batch 1 comes again after batch 2, as after a lost
    checkpoint: counts and folds stay what they were."""
    p = paths(spark)

    def batch(a, b):
        rows = [("a", k) for k in a] + [("b", k) for k in b]
        return spark.createDataFrame(rows, "source string, key long")

    batches = [batch(range(1, 6), range(1, 3)), batch(range(6, 20), []), batch(range(1, 25), range(3, 5))]
    for i in (0, 1, 1, 2, 1):
        sink_rows(batches[i], i, p, by_source=True)
        fold_cycles(spark, p.state)
    got = {(r.source, r.batch_id): (r.new_count, r.last_key, r.look_ahead, r["mode"]) for r in burst_log(spark, p.state).collect()}
    assert got == {("a", 0): (5, 5, 10, "burst"), ("a", 1): (14, 19, 20, "burst"), ("a", 2): (5, 24, 5, "normal"),
                   ("b", 0): (2, 2, 5, "normal"), ("b", 2): (2, 4, 5, "normal")}
    assert burst_log(spark, p.state).count() == 5
    assert (stored_last_key(spark, p.state), stored_last_key(spark, p.state, "b")) == (24, 4)
    rows = spark.read.parquet(p.sink)
    assert rows.filter("source = 'a'").count() == 24 and rows.filter("source = 'b'").count() == 4


def test_poll_and_watch(spark):
    """After a burst the next poll follows at once; an idle poll ends a burst."""
    p = paths(spark)
    schema = events(spark, [1]).schema
    drops = [range(1, 11), range(11, 21), range(21, 23), []]
    slept, modes = [], []

    def once():
        ids = drops[len(modes)]
        if len(ids):
            write_drop(events(spark, ids), p.landing)
        modes.append(poll(spark, p.state, lambda: run_monitor(spark, p, schema, 0, key_col="event_id")))
        return modes[-1]

    assert watch(once, interval=300, sleep=slept.append, polls=4) == 4
    assert modes == ["burst", "burst", "normal", "idle"] and slept == [300]
    look = [(r.batch_id, r.look_ahead, r["mode"]) for r in burst_log(spark, p.state).collect()]
    assert sorted(look) == [(0, 10, "burst"), (1, 20, "burst"), (2, 5, "idle"), (2, 5, "normal")]


def test_watch_ends_on_interrupt():
    def once():
        raise KeyboardInterrupt

    assert watch(once) == 0


def test_late_rows_are_corrections(spark):
    run = new_run_dir(spark, "test-late")
    e = events(spark, range(0, 240))  # ten days, hourly
    a, late, c = time_slices(e, 3, "ts")
    state = []
    for drop in (a, c, late):
        write_drop(drop, f"{run}/landing")
        run_daily_counts(spark, f"{run}/landing", f"{run}/out", f"{run}/ckpt", e.schema)
        state.append({r.day: (r.n_events, r.n_late, r.closed) for r in daily_counts(spark, f"{run}/out").collect()})
    before, after = state[1], state[2]
    assert sum(n for n, _, _ in before.values()) == 160 and sum(n for n, _, _ in after.values()) == 240
    assert sum(late for _, late, _ in after.values()) == 80 and all(late == 0 for _, late, _ in before.values())
    assert before["2026-03-01"] == after["2026-03-01"] == (24, 0, True) and not after["2026-03-10"][2]
    assert spark.read.parquet(f"{run}/out/closed").groupBy("day").count().filter("count > 1").isEmpty()
