"""Alarms while the log is still coming in."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.operators import observe
from ordertide.session import work_dir
from ordertide.sinks.tables import ensure_dir
from ordertide.sources.topic import read_message_files
from ordertide.streaming.alarms import alarm_schema, alarms_writer, closed_ratios, moved_on, read_alarms
from ordertide.streaming.runner import catch_up

START = datetime(2026, 1, 1, 23, 50)
KEY = [T.StructField("series", T.StringType())]


def at(minute: int) -> datetime:
    return START + timedelta(minutes=minute)


def minute_of(t: datetime) -> int:
    return int((t - START).total_seconds() // 60)


def windows(spark, rows):
    return spark.createDataFrame([(k, at(m), b) for k, m, b in rows], "series string, window_start timestamp, breach int")


def told(df):
    return {(r.series, minute_of(r.run_start), minute_of(r.run_end), r.buckets, r.state) for r in df.collect()}


def test_states_over_batches(spark):
    """Pending, firing, resolved per series, over midnight; a null series is one; a gap ends a run; short runs stay quiet."""
    path = f"{work_dir(spark, 'alarm-states')}/alarms"
    write = alarms_writer(path, buckets=3, key_fields=KEY, merge_every=2)
    batches = [
        ([("a", 0, 1), ("b", 0, 1), (None, 0, 0)], {("a", 0, 0, 1, "pending"), ("b", 0, 0, 1, "pending")}),
        ([("a", 1, 1), ("a", 2, 1), ("b", 1, 0), ("b", 2, 0), (None, 2, 1)],
         {("a", 0, 2, 3, "firing"), ("b", 0, 0, 1, "quiet"), (None, 2, 2, 1, "pending")}),
        ([], set()),
        ([(k, m, 1) for k in ("a", None) for m in range(3, 12)], {("a", 0, 11, 12, "firing"), (None, 2, 11, 10, "firing")}),
        ([("b", 12, 0)], {("a", 0, 11, 12, "resolved"), (None, 2, 11, 10, "resolved")}),
        ([("a", 13, 1)], {("a", 13, 13, 1, "pending")}),
        ([("a", 15, 1), ("b", 14, 1), ("b", 16, 0)], {("a", 13, 13, 1, "quiet")}),
    ]
    state: dict = {}
    for n, (rows, expected) in enumerate(batches):
        still = read_alarms(spark, path, KEY, before=n).where(F.col("state").isin("pending", "firing"))
        horizon = max((at(m) for _, m, _ in rows), default=None)
        changed = moved_on(still, windows(spark, rows), F.col("breach") == 1, 3, horizon, ["series"])
        assert told(changed) == expected, n
        write(windows(spark, rows), n)
        state |= {(k, first): (last, size, what) for k, first, last, size, what in expected}
        assert told(read_alarms(spark, path, KEY)) == {(*k, *v) for k, v in state.items()}
    write(windows(spark, batches[-1][0]), len(batches) - 1)
    assert told(read_alarms(spark, path, KEY)) == {(*k, *v) for k, v in state.items()}
    assert read_alarms(spark, path, KEY).schema.names == alarm_schema(KEY).names


def test_firing_is_seen_before_the_run_ends_and_equals_the_report(spark):
    root = work_dir(spark, "alarm-stream")
    source, path = ensure_dir(spark, f"{root}/log"), f"{root}/alarms"
    outcome = lambda m: "failed" if 10 <= m < 30 or 60 <= m < 62 else "persisted"
    log = [(at(m), outcome(m)) for m in range(90) if m not in (20, 21, 22, 23, 24, 25, 26)]
    seen = []
    for lo, hi in ((0, 20), (20, 40), (40, 90)):
        part = [r for r in log if at(lo) <= r[0] < at(hi)]
        rows = spark.createDataFrame(part, "arrival_ts timestamp, outcome string")
        rows.write.mode("append").parquet(source)
        stream = closed_ratios(read_message_files(spark, source, rows.schema))
        catch_up(stream, alarms_writer(path), f"{root}/check", tables=())
        seen.append({(minute_of(r.run_start), minute_of(r.run_end), r.buckets, r.state) for r in read_alarms(spark, path).collect()})
    whole = spark.read.parquet(source)
    report = observe.sustained(observe.failure_ratio(whole), F.col("breach") == 1, 5).collect()
    last = {(a, b, n) for a, b, n, state in seen[-1] if state in ("firing", "resolved")}
    assert last == {(minute_of(r.run_start), minute_of(r.run_end), r.buckets) for r in report} != set()
    assert any(state == "firing" for *_, state in seen[0]) and all(state == "resolved" for *_, state in seen[-1])
