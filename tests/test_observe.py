"""Ingest health from the log."""

import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordertide import schemas as S
from ordertide.operators import observe

T0 = datetime(2026, 5, 9, 2, 0, 0, tzinfo=timezone.utc)


def log(spark, rows):
    """rows: (seconds after T0, outcome, proc_ms)."""
    return spark.createDataFrame([(T0 + timedelta(seconds=s), str(i), o, 0.0, p) for i, (s, o, p) in enumerate(rows)], S.INGEST_LOG)


def minute_of(ts):
    return int((ts.astimezone(timezone.utc) - T0).total_seconds() // 60)


def test_throughput_and_parse_errors(spark):
    rows = [(0, "persisted", 1.0), (59, "duplicate", 1.0), (30, "parse_error", 1.0), (60, "persisted", 1.0), (61, "failed", 1.0)]
    got = {minute_of(r.minute): tuple(r)[1:] for r in observe.throughput(log(spark, rows)).collect()}
    assert got == {0: (3, 1, 1, 1, 3 / 60), 1: (2, 1, 0, 0, 2 / 60)}


@pytest.mark.parametrize("q", [0.0, 0.5, 0.95, 1.0])
def test_quantile_is_exact_also_in_a_hot_minute(spark, q):
    rng = random.Random(5)
    rows = [(rng.uniform(0, 59), "persisted", round(rng.lognormvariate(3, 2), 3)) for _ in range(4000)]
    rows += [(60 + rng.uniform(0, 59), "persisted", float(rng.randint(-3, 3))) for _ in range(50)]
    rows += [(120, "persisted", 7.5), (180, "persisted", None)]
    got = {minute_of(r.minute): r.quantile for r in observe.latency_quantile(log(spark, rows), q).collect()}
    expect = {}
    for m in (0, 1, 2):
        values = [p for s, _, p in rows if p is not None and int(s // 60) == m]
        expect[m] = float(np.quantile(values, q))
    assert got.keys() == expect.keys()
    for m, value in expect.items():
        assert got[m] == pytest.approx(value, abs=1e-9)


def test_failure_ratio_over_sliding_minutes(spark):
    rows = [(0, "persisted", 1.0)] * 99 + [(0, "failed", 1.0)] + [(300, "failed", 1.0)]
    got = {minute_of(r.window_start): (r.received, r.failed, r.ratio, r.breach)
           for r in observe.failure_ratio(log(spark, rows)).collect()}
    assert got[-4] == got[0] == (100, 1, 0.01, 0)
    assert got[1] == got[5] == (1, 1, 1.0, 1)
    assert len(got) == 10


def test_no_messages_give_a_null_ratio(spark):
    steps = spark.createDataFrame([(T0, 0, 0)], "step timestamp, received long, failed long")
    assert all(r.ratio is None and r.breach == 0 for r in observe.slide_ratio(steps, "5 minutes", "1 minute", 0.01).collect())


def series(spark, minutes):
    return spark.createDataFrame([(T0 + timedelta(minutes=m), b) for m, b in minutes], "window_start timestamp, breach int")


def runs(spark, minutes, buckets=5):
    out = observe.sustained(series(spark, minutes), F.col("breach") == 1, buckets)
    return sorted((minute_of(r.run_start), minute_of(r.run_end), r.buckets) for r in out.collect())


def test_four_buckets_are_no_alarm_and_five_are(spark):
    assert runs(spark, [(m, 1) for m in range(4)]) == []
    assert runs(spark, [(m, 1) for m in range(5)]) == [(0, 4, 5)]


def test_calm_or_empty_bucket_breaks_a_run(spark):
    assert runs(spark, [(m, 0 if m == 3 else 1) for m in range(7)]) == []
    assert runs(spark, [(m, 1) for m in range(7) if m != 3]) == []


def test_runs_go_on_over_midnight_and_over_whole_days(spark):
    midnight = 22 * 60
    assert runs(spark, [(m, 1) for m in range(midnight - 3, midnight + 3)]) == [(midnight - 3, midnight + 2, 6)]
    long = range(midnight - 10, midnight + 2 * 1440 + 10)
    assert runs(spark, [(m, 1) for m in long]) == [(midnight - 10, midnight + 2 * 1440 + 9, len(long))]
    apart = [(midnight - 1, 1), (midnight + 1, 1)]
    assert runs(spark, apart, buckets=1) == [(midnight - 1, midnight - 1, 1), (midnight + 1, midnight + 1, 1)]


def test_runs_follow_the_step_of_their_series(spark):
    steps = [(T0 + timedelta(seconds=10 * k), 1) for k in range(6)] + [(T0 + timedelta(seconds=80 + 10 * k), 1) for k in range(4)]
    df = spark.createDataFrame(steps, "window_start timestamp, breach int")
    found = observe.sustained(df, F.col("breach") == 1, 5, step_seconds=10).collect()
    assert [(r.buckets, (r.run_end - r.run_start).total_seconds()) for r in found] == [(6, 50.0)]
    with pytest.raises(ValueError, match="divide"):
        observe.sustained(df, F.col("breach") == 1, 5, step_seconds=7)


def test_balance(spark):
    rows = [(0, o, 1.0) for o in ("persisted", "duplicate", "failed", "parse_error", "persisted")]
    assert tuple(observe.balance(log(spark, rows)).first()) == (5, 1, 1, 2, 1, 0)
    assert observe.balance(log(spark, [(0, "unknown", 1.0)])).first().difference == 1
