"""The two jobs end to end, and plans that must prune or stay narrow."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from ordertide import schemas as S
from ordertide.operators import aggregate as A
from ordertide.operators import observe
from ordertide.plans import catalog
from ordertide.plans import views as V
from ordertide.sinks import tables as tab
from ordertide.sources.dimension import PartialDimProvider
from ordertide.streaming import jobs
from ordertide.streaming.aggregate import lookup_writer
from ordertide.streaming.alarms import closed_count_ratios, read_alarms
from ordertide.streaming.ingest import IngestTables

SF = "/root/testdata/sf0.001"
T0 = datetime(2026, 5, 9, 2, 0, 0, tzinfo=timezone.utc)


def message(n, event_id, time="2026-05-09 10:00:00"):
    value = {"eventId": event_id, "bizType": "ORDER", "bizKey": f"order-{n}", "customerId": 1, "amount": "1.0000", "eventTime": time}
    return json.dumps(value), 0, n, T0 + timedelta(seconds=n)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_raw_messages_become_minutes_and_days(spark, tmp_path):
    root, files = str(tmp_path / "root"), str(tmp_path / "raw")
    rows = [message(1, "a"), message(2, "a"), message(3, "b"), message(4, "z", "2030-01-01 00:00:00")]
    spark.createDataFrame(rows, S.MESSAGE).write.parquet(files)
    jobs.ingest(["--root", root, "--files", files, "--every", "0"], spark)
    for _ in range(2):  # a second run finds nothing new
        jobs.aggregate(["--root", root, "--every", "0"], spark)
    assert [r.order_cnt for r in tab.read_latest(spark, f"{root}/agg").collect()] == [2]
    daily = tab.read_latest(spark, f"{root}/daily", S.AGG_DAILY, S.DAILY_KEY).collect()
    assert [(str(r.stat_date), r.order_cnt) for r in daily] == [("2026-05-09", 2)]
    assert tab.read_batches(spark, f"{root}/aside", S.SET_ASIDE).count() == 0


def test_ingest_needs_a_source(spark, tmp_path):
    with pytest.raises(SystemExit):
        jobs.ingest(["--root", str(tmp_path)], spark)


def test_stages_are_cut_by_the_stored_column(spark):
    middle = plan(V.chunks_of(spark, SF)[1])
    assert "GreaterThanOrEqual(ts" in middle and "LessThan(ts" in middle
    assert sum(c.count() for c in V.chunks_of(spark, SF, chunks=7)) == V.table(spark, SF, "events").count()


@pytest.mark.parametrize("name", ["parse_raw_events", "parse_mid_events", "mid_wire_json", "order_projection", "agg_null_policy"])
def test_decoding_shuffles_no_input(spark, name):
    assert "RoundRobin" not in plan(catalog.registered()[name](spark, SF))


def test_recent_minutes_read_only_their_days(spark):
    recent = plan(A.recent_minutes(catalog._stored_agg(spark, SF), catalog.REPORT_NOW, minutes=1440, n=20))
    filters = recent.split("PartitionFilters:")[1]
    assert "stat_date" in filters.split("]")[0] and "GreaterThanOrEqual(window_start" in recent


def test_claims_are_one_answer_for_any_number_of_stages(spark):
    from ordertide.plans import staged

    told = [{tuple(r) for r in staged.restart_no_dup(spark, SF, chunks=n).collect()} for n in (1, 3, 7)]
    assert told[0] == told[1] == told[2] and len(told[0]) > 500


def late_message(minute, event_id, key="order-1", customer=1):
    n = 60 * minute
    value = {"eventId": event_id, "bizType": "ORDER", "bizKey": key, "customerId": customer, "amount": "1.0000", "eventTime": "2026-05-09 10:00:00"}
    return json.dumps(value), 0, n, T0 + timedelta(seconds=n)


def test_ingest_keeps_alarms_while_it_goes_on(spark, tmp_path):
    """Messages with an unusable key fail for ten minutes; the run is firing, then resolved, as the report over the whole log says."""
    root, files = str(tmp_path / "root"), str(tmp_path / "raw")
    tables, states = IngestTables(root), []
    failing = [late_message(m, f"bad-{m}", key="none") for m in range(10)]
    for minutes, more in ((range(8), failing[:8]), (range(8, 30), failing[8:]), (range(30, 60), [])):
        rows = [late_message(m, f"ok-{m}") for m in minutes] + more
        spark.createDataFrame(rows, S.MESSAGE).write.mode("append").parquet(files)
        jobs.ingest(["--root", root, "--files", files, "--every", "0"], spark)
        states.append({r.state for r in read_alarms(spark, f"{root}/alarms").collect()})
    log = tab.read_batches(spark, tables.log, S.INGEST_LOG)
    counts = tab.read_batches(spark, tables.log_minutes, S.LOG_MINUTE)
    assert tuple(counts.agg(F.sum("received"), F.sum("failed")).first()) == (log.count(), 10)
    report = observe.sustained(observe.failure_ratio(log), F.col("breach") == 1, 5)
    told = read_alarms(spark, f"{root}/alarms").select("run_start", "run_end", "buckets")
    assert [tuple(r) for r in told.collect()] == [tuple(r) for r in report.collect()] != []
    assert states == [{"firing"}, {"resolved"}, {"resolved"}]


def test_minute_counts_in_several_rows_are_one_series(spark):
    log = spark.createDataFrame([(T0 + timedelta(seconds=20 * n), "failed" if n % 3 else "persisted") for n in range(60)], "arrival_ts timestamp, outcome string")
    halves = [observe.minute_counts(log.filter(F.second("arrival_ts") == s)) for s in (0, 20, 40)]
    parts = halves[0].unionAll(halves[1]).unionAll(halves[2])
    ratios = lambda df: sorted(tuple(r) for r in df.collect())
    assert ratios(closed_count_ratios(parts)) == ratios(observe.failure_ratio(log)) != []
    assert observe.minute_counts(log.limit(0)).count() == 0


def test_aggregate_keeps_enriched_events(spark, tmp_path):
    root, files, dim = str(tmp_path / "root"), str(tmp_path / "raw"), str(tmp_path / "dim")
    customer = lambda n, level: (n, "n", level, "CN-EAST", None, None)
    spark.createDataFrame([customer(1, "VIP")], S.CUSTOMER).write.parquet(dim)
    for stage, sent in enumerate(([("a", 1), ("b", 2), ("c", None)], [("d", 1), ("e", 3)])):
        rows = [late_message(stage * 10 + n, event, f"order-{n}", who) for n, (event, who) in enumerate(sent)]
        spark.createDataFrame(rows, S.MESSAGE).write.mode("append").parquet(files)
        if stage:
            spark.createDataFrame([customer(3, "SVIP")], S.CUSTOMER).write.mode("append").parquet(dim)
        jobs.ingest(["--root", root, "--files", files, "--every", "0"], spark)
        for _ in range(2):  # a second run finds nothing new
            jobs.aggregate(["--root", root, "--every", "0", "--dimension", dim], spark)
    rows = tab.read_batches(spark, f"{root}/enriched", S.ENRICHED).collect()
    assert {r.event_id: (r.customer_id, r.customer_level) for r in rows} == {"a": (1, "VIP"), "b": (2, None), "d": (1, "VIP"), "e": (3, "SVIP")}
    assert len(rows) == 4  # "c" has no customer: set aside by ingest


def test_lookup_writer_repeats_nothing_and_merges(spark, tmp_path):
    path = str(tmp_path / "enriched")
    asked = []

    def loader(keys):
        asked.append(sorted(r[0] for r in keys.collect()))
        return spark.createDataFrame([(1, "VIP", "x")], "customer_id long, level string, region string")

    write = lookup_writer(path, PartialDimProvider(loader), merge_every=2)
    events = lambda *rows: spark.createDataFrame([(e, "ORDER", "order-1", who, None, None) for e, who in rows], S.EVENT)
    for n, rows in enumerate(([("a", 1), ("a", 1)], [], [("b", None), ("c", 9)], [("d", 1)])):
        write(events(*rows), n)
        write(events(*rows), n)
    got = sorted((r.event_id, r.customer_level) for r in tab.read_batches(spark, path, S.ENRICHED).collect())
    assert got == [("a", "VIP"), ("a", "VIP"), ("b", None), ("c", None), ("d", "VIP")]
    assert asked == [[1], [9]]
