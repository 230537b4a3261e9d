"""The two long-running queries: parity with batch, late rows, restarts, replays."""

import json
import os
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ordertide import schemas as S
from ordertide.operators import aggregate as A
from ordertide.operators import observe
from ordertide.operators.aggregate import agg_windowed
from ordertide.operators.dedup import dedup_stream, near_claims
from ordertide.sinks import tables as tab
from ordertide.sources import synth
from ordertide.sources.decode import decode_mid
from ordertide.sources.dimension import DimProvider
from ordertide.sources.topic import read_message_files
from ordertide.streaming.aggregate import (
    MID_TOPIC, aggregate_stream, aggregate_writer, enriched_writer, refresh_daily, set_aside_stream, single_deliveries,
)
from ordertide.streaming.ingest import IngestTables, ingest_stream, ingest_writer
from ordertide.streaming.runner import catch_up

UTC = timezone.utc
T0 = datetime(2026, 5, 9, 2, 0, 0, tzinfo=UTC)
FAR = 10**8


def mid_json(event_id, seconds, customer=1, amount="1.0000", biz_type="ORDER"):
    time = (T0 + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%S.") + "%03dZ" % round(seconds % 1 * 1000)
    return json.dumps({
        "event_id": event_id, "biz_type": biz_type, "biz_key": "o-1", "customer_id": customer, "amount": amount, "event_time": time,
    })


class Folder:
    """A folder of messages growing batch by batch, one file each, with rising file times."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.n = spark, str(path), schema, 0
        os.makedirs(self.path)

    def add(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)
        for name in os.listdir(self.path):
            full = os.path.join(self.path, name)
            if name.endswith(".parquet") and os.path.getmtime(full) > 10**9 + 10**6:
                os.utime(full, (10**9 + self.n, 10**9 + self.n))
        self.n += 1

    def stream(self, one_by_one=True):
        return read_message_files(self.spark, self.path, self.schema, 1 if one_by_one else None)


def wire(*values):
    return [("o-1", v) for v in values]


def agg_rows(spark, path):
    rows = tab.read_latest(spark, path).withColumn("w", F.col("window_start").cast("string")).collect()
    return {(r.w[11:16], r.customer_id): r.order_cnt for r in rows if r.w < "2028"}


def test_late_row_counts_until_its_minute_is_closed(spark, tmp_path):
    src = Folder(spark, tmp_path / "mid", S.WIRE)
    src.add(wire(mid_json("a", 10), mid_json("b", 58)))          # watermark 02:00:53
    src.add(wire(mid_json("c", 20)))                             # behind the watermark, minute open
    src.add(wire(mid_json("d", 66)))                             # watermark 02:01:01
    src.add(wire(mid_json("f", 60)))                             # the batch that closes 10:00
    src.add(wire(mid_json("e", 59.999)))                         # too late
    src.add(wire(mid_json("z", FAR)))
    out, check = str(tmp_path / "agg"), str(tmp_path / "check")
    catch_up(aggregate_stream(src.stream()), aggregate_writer(out), check)
    assert agg_rows(spark, out) == {("10:00", 1): 3, ("10:01", 1): 2}


def test_stream_agrees_with_batch_over_restarts(spark, tmp_path):
    ev = synth.synthetic_events(synth.sequence(spark, 3000), datetime(2026, 5, 1, tzinfo=UTC), rate=5)
    msgs = ev.select(
        F.to_json(F.struct(
            "event_id", "biz_type", "biz_key", "customer_id", F.col("amount").cast("string").alias("amount"),
            F.date_format(F.col("event_time") - F.expr("interval 8 hours"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_time"),
        )).alias("value"), "event_id",
    ).orderBy("event_id").select("value").collect()
    src = Folder(spark, tmp_path / "mid", S.WIRE)
    out, check = str(tmp_path / "agg"), str(tmp_path / "check")
    for at in range(0, 3000, 1000):
        src.add(wire(*[m.value for m in msgs[at:at + 1000]]))
        catch_up(aggregate_stream(src.stream(False)), aggregate_writer(out), check, tables=[out])
    src.add(wire(mid_json("z", FAR)))
    catch_up(aggregate_stream(src.stream(False)), aggregate_writer(out), check, tables=[out])
    streamed = tab.read_latest(spark, out).drop("update_time").filter("window_start < '2028-01-01'")
    batch = agg_windowed(decode_mid(spark.read.parquet(src.path))).filter("window_start < '2028-01-01'")
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0


def test_update_mode_upserts_to_the_same_state(spark, tmp_path):
    src = Folder(spark, tmp_path / "mid", S.WIRE)
    src.add(wire(mid_json("a", 10), mid_json("b", 20)))
    src.add(wire(mid_json("c", 30), mid_json("d", 70)))
    out = str(tmp_path / "agg")
    catch_up(aggregate_stream(src.stream()), aggregate_writer(out), str(tmp_path / "check"), mode="update")
    assert agg_rows(spark, out) == {("10:00", 1): 3, ("10:01", 1): 1}
    assert tab.read_batches(spark, out, S.AGG_1MIN).count() == 3


def test_incomplete_mid_events_go_to_their_own_query(spark, tmp_path):
    src = Folder(spark, tmp_path / "mid", S.WIRE)
    src.add(wire(mid_json("a", 10), mid_json("b", 10, customer=None), "{bad"))
    out = str(tmp_path / "aside")
    catch_up(set_aside_stream(src.stream()), lambda df, n: tab.write_batch(df, out, n), str(tmp_path / "check"))
    assert [(r.event_id, r.missing) for r in tab.read_batches(spark, out, S.SET_ASIDE).collect()] == [("b", "customer_id")]


def test_dimension_change_is_seen_between_batches(spark, tmp_path):
    src = Folder(spark, tmp_path / "mid", S.WIRE)
    src.add(wire(mid_json("a", 10)))
    src.add(wire(mid_json("b", 10)))
    level = iter(["NORMAL", "VIP"])
    clock = iter([T0, T0 + timedelta(minutes=10)])
    dims = DimProvider(lambda: spark.createDataFrame([(1, next(level), "r")], "customer_id long, level string, region string"))
    out = str(tmp_path / "enriched")
    catch_up(decode_mid(src.stream()), enriched_writer(out, dims, lambda: next(clock)), str(tmp_path / "check"))
    got = {r.event_id: r.customer_level for r in spark.read.parquet(out).collect()}
    assert got == {"a": "NORMAL", "b": "VIP"}


def raw(event_id, offset, days=0, key="order-1", amount="1.0000", partition=0, **more):
    text = json.dumps({
        "eventId": event_id, "bizType": "ORDER", "bizKey": key, "customerId": 1, "amount": amount,
        "eventTime": "2026-05-09 10:00:00", **more,
    })
    return text, partition, offset, T0 + timedelta(days=days, seconds=offset)


class Ingest:
    def __init__(self, spark, tmp_path):
        self.spark = spark
        self.src = Folder(spark, tmp_path / "raw", S.MESSAGE)
        self.tables = IngestTables(str(tmp_path / "tables"))
        self.check = str(tmp_path / "check")

    def run(self, **kw):
        catch_up(ingest_stream(self.src.stream()), ingest_writer(self.tables, clock=lambda: T0, **kw), self.check, tables=self.tables.all())

    def mid(self):
        rows = decode_mid(tab.read_batches(self.spark, self.tables.mid, S.WIRE)).collect()
        return sorted((r.event_id, r.amount) for r in rows)

    def orders(self):
        rows = tab.read_batches(self.spark, self.tables.orders, S.ORDER).collect()
        return sorted((r.order_id, r.amount) for r in rows)


@pytest.fixture
def ingest(spark, tmp_path):
    return Ingest(spark, tmp_path)


ONE, TWO, THREE = Decimal("1.0000"), Decimal("2.0000"), Decimal("3.0000")


def test_copies_in_one_batch_later_batches_and_after_seven_days(ingest):
    ingest.src.add([raw("a", 5), raw("a", 9, amount="2.0000"), raw("a", 1, partition=1, amount="3.0000")])
    ingest.src.add([raw("a", 20), raw("b", 21, amount="2.0000")])
    ingest.run()
    assert ingest.mid() == [("a", THREE), ("b", TWO)]  # the earliest arrival claims, wherever it came from
    ingest.src.add([raw("a", 30, days=6)])
    ingest.run()
    assert ingest.mid() == [("a", THREE), ("b", TWO)]
    ingest.src.add([raw("a", 40, days=8)])
    ingest.run()
    assert ingest.mid() == [("a", ONE), ("a", THREE), ("b", TWO)]
    assert ingest.orders() == [(1, THREE)]


@pytest.mark.parametrize("cuts", [(), (1,), (1, 2), (1, 2, 3, 4, 5)])
def test_claims_do_not_depend_on_how_batches_are_cut(ingest, cuts):
    sent = [raw("a", 1), raw("b", 2), raw("a", 3, days=6.9), raw("a", 4, days=8), raw("b", 5, days=8.5), raw("a", 6, days=14.5)]
    for lo, hi in zip((0, *cuts), (*cuts, len(sent))):
        ingest.src.add(sent[lo:hi])
    ingest.run()
    claimed = tab.read_batches(ingest.spark, ingest.tables.ledger, S.LEDGER).collect()
    assert sorted((r.event_id, (r.created_at.replace(tzinfo=UTC) - T0).days) for r in claimed) == [("a", 0), ("a", 8), ("b", 0), ("b", 8)]


def test_old_row_in_a_late_batch_does_not_widen_the_horizon(ingest):
    ingest.src.add([raw("a", 1)])
    ingest.src.add([raw("x", 2, days=6), raw("a", 3, days=8)])
    ingest.run()
    assert [e for e, _ in ingest.mid()] == ["a", "a", "x"]


def test_history_is_merged_and_pruned_by_day(ingest):
    for n in range(7):
        ingest.src.add([raw(f"e{n}", n, days=n * 2, key=f"order-{n}"), raw("again", n, days=n / 24, key="order-50")])
    ingest.run(merge_every=3)
    ledger = tab.read_batches(ingest.spark, ingest.tables.ledger, S.LEDGER_BY_DAY)
    assert tab.committed_batches(ingest.spark, ingest.tables.ledger) == {2, 5, 6}
    assert ingest.orders() == [(n, ONE) for n in range(7)] + [(50, ONE)]
    assert [e for e, _ in ingest.mid()] == ["again"] + [f"e{n}" for n in range(7)]
    near = near_claims(ledger, T0 + timedelta(days=12), T0 + timedelta(days=12))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day#" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert {r.event_id for r in near.collect()} == {"e3", "e4", "e5", "e6"}


def test_broken_off_merge_is_finished(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [spark.createDataFrame([(f"e{n}", T0)], S.LEDGER) for n in range(3)]
    for n, df in enumerate(rows):
        tab.write_batch(df, path, n)
    tab.read_batches(spark, path, S.LEDGER).select(*S.LEDGER.names).write.parquet(f"{path}/_merged")
    tab._create_text(spark, f"{path}/_merge_upto", "2")
    tab.finish_merge(spark, path)
    assert tab.committed_batches(spark, path) == {2}
    assert sorted(r.event_id for r in tab.read_batches(spark, path, S.LEDGER).collect()) == ["e0", "e1", "e2"]
    tab.finish_merge(spark, path)


def test_outcomes_balance_and_rejects_are_kept(ingest):
    ingest.src.add([
        raw("a", 1), raw("a", 2), ("{bad", 0, 3, T0), raw("", 4), raw("c", 5, key="order-x"), raw("d", 6, bizType=None),
        raw("e", 7, key="order-2", eventTime=None), (None, 0, 8, T0),
    ])
    ingest.run()
    log = tab.read_batches(ingest.spark, ingest.tables.log, S.INGEST_LOG)
    assert tuple(observe.balance(log).first()) == (8, 3, 1, 2, 2, 0)
    reasons = {r.offset: r.reject_reason for r in tab.read_batches(ingest.spark, ingest.tables.rejects, S.REJECT).collect()}
    assert reasons == {3: "malformed", 4: "missing_event_id", 5: "bad_biz_key", 6: "null_required", 8: "malformed"}
    ledger = {r.event_id for r in tab.read_batches(ingest.spark, ingest.tables.ledger, S.LEDGER).collect()}
    assert ledger == {"a", "e"}


def test_batches_broken_off_anywhere_are_neither_lost_nor_repeated(ingest):
    ingest.src.add([raw("a", 1), raw("b", 2, key="order-2")])
    ingest.src.add([raw("b", 3, key="order-2"), raw("c", 4, key="order-3"), raw("d", 5, key="order-1")])
    ingest.src.add([raw("c", 6, key="order-3"), raw("e", 7, key="order-5")])
    ingest.src.add([raw("f", 8, key="order-6"), raw("f", 9, key="order-6")])
    for n, step in enumerate(("ledger", "orders", "mid", "log")):
        def crash(done, batch_id):
            if (done, batch_id) == (step, n):
                raise RuntimeError("broken off")

        with pytest.raises(StreamingQueryException):
            ingest.run(after=crash)
    ingest.run()
    assert [e for e, _ in ingest.mid()] == ["a", "b", "c", "d", "e", "f"]
    assert ingest.orders() == [(n, ONE) for n in (1, 2, 3, 5, 6)]
    log = tab.read_batches(ingest.spark, ingest.tables.log, S.INGEST_LOG)
    assert tuple(observe.balance(log).first()) == (9, 0, 3, 6, 0, 0)


def test_batch_is_visible_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3).withColumn("event_id", F.col("id").cast("string")).select("event_id", F.lit(T0).alias("created_at"))
    tab.write_batch(df, path, 0)
    os.remove(tab.commit_path(path, 0))                # a move that broke off leaves a folder and no entry
    assert tab.read_batches(spark, path, S.LEDGER).count() == 0
    tab.write_batch(df.limit(2), path, 1)
    assert tab.read_batches(spark, path, S.LEDGER).count() == 2
    tab.write_batch(df, path, 1)                       # committed: kept
    assert tab.read_batches(spark, path, S.LEDGER).count() == 2
    tab.write_batch(df, path, 1, replace=True)
    tab.write_batch(df.limit(1), path, 0)
    assert tab.read_batches(spark, path, S.LEDGER).count() == 4


def test_aggregate_broken_off_after_its_write_needs_one_restart(spark, tmp_path):
    src = Folder(spark, tmp_path / "mid", S.WIRE)
    out, check, broken = str(tmp_path / "agg"), str(tmp_path / "check"), []
    src.add(wire(mid_json("a", 10), mid_json("b", 70)))
    src.add(wire(mid_json("c", 15), mid_json("z", FAR)))

    def crash(step, batch_id):
        if not broken:
            broken.append(batch_id)
            raise RuntimeError("broken off")

    with pytest.raises(StreamingQueryException):
        catch_up(aggregate_stream(src.stream(False)), aggregate_writer(out, after=crash), check)
    catch_up(aggregate_stream(src.stream(False)), aggregate_writer(out), check)
    assert agg_rows(spark, out) == {("10:00", 1): 2, ("10:01", 1): 1}


def test_compacted_table_takes_its_own_query_and_no_other(spark, tmp_path):
    src = Folder(spark, tmp_path / "mid", S.WIRE)
    out, packed, check = (str(tmp_path / n) for n in ("agg", "packed", "check"))
    src.add(wire(mid_json("a", 10), mid_json("b", 70)))
    catch_up(aggregate_stream(src.stream()), aggregate_writer(out), check)
    last = max(tab.committed_batches(spark, out))
    tab.compact(spark, out, packed, upto=last)
    src.add(wire(mid_json("z", FAR)))
    with pytest.raises(StreamingQueryException, match="another checkpoint"):
        catch_up(aggregate_stream(src.stream()), aggregate_writer(packed), str(tmp_path / "other"))
    catch_up(aggregate_stream(src.stream()), aggregate_writer(packed), check)
    assert agg_rows(spark, packed) == {("10:00", 1): 1, ("10:01", 1): 1}


def test_second_daily_run_of_one_number_sees_late_minutes(spark, tmp_path):
    agg, daily = str(tmp_path / "agg"), str(tmp_path / "daily")
    schema = "window_start timestamp_ntz, biz_type string, customer_id long, order_cnt long, amount_sum decimal(18,4)"
    for n, minute in enumerate((0, 1)):
        tab.upsert_batch(spark.createDataFrame([(datetime(2026, 5, 9, 10, minute), "ORDER", 1, 1, ONE)], schema), n, agg, T0)
        refresh_daily(spark, agg, daily, 7, T0)
    assert [r.order_cnt for r in tab.read_latest(spark, daily, S.AGG_DAILY, S.DAILY_KEY).collect()] == [2]


def test_repeated_deliveries_are_counted_once(spark, tmp_path):
    src = Folder(spark, tmp_path / "topic", MID_TOPIC)
    once, out = str(tmp_path / "once"), str(tmp_path / "agg")
    a, b, z = mid_json("a", 10), mid_json("b", 20), mid_json("z", FAR)
    src.add([("k", a, T0), ("k", a, T0 + timedelta(seconds=5)), ("k", "{bad", T0)])
    src.add([("k", a, T0 + timedelta(seconds=9)), ("k", b, T0), ("k", z, T0)])
    catch_up(single_deliveries(src.stream()), lambda df, n: tab.write_batch(df, once, n), str(tmp_path / "c1"))
    catch_up(aggregate_stream(tab.stream_batches(spark, once, S.WIRE)), aggregate_writer(out), str(tmp_path / "c2"))
    assert agg_rows(spark, out) == {("10:00", 1): 2}
    assert tab.read_batches(spark, once, S.WIRE).count() == 4


def test_new_checkpoint_over_old_tables_is_refused(ingest, tmp_path):
    ingest.src.add([raw("a", 1)])
    ingest.run()
    ingest.check = str(tmp_path / "other")
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest.run()


def test_publish_replaces_the_mid_table(ingest):
    sent = []
    ingest.src.add([raw("a", 1)])
    ingest.run(publish=lambda df, n: sent.extend((n, r.key) for r in df.collect()))
    assert sent == [(0, "order-1")]
    assert not tab.path_exists(ingest.spark, ingest.tables.mid)


def test_ingest_feeds_aggregate(ingest, spark, tmp_path):
    ingest.src.add([raw("a", 1), raw("a", 2), raw("b", 3, key="order-2")])
    ingest.src.add([raw("b", 4), raw("c", 5, key="order-3", eventTime="2030-01-01 00:00:00")])
    ingest.run()
    out = str(tmp_path / "agg")
    mid = tab.stream_batches(spark, ingest.tables.mid, S.WIRE)
    catch_up(aggregate_stream(mid), aggregate_writer(out), str(tmp_path / "agg-check"))
    assert agg_rows(spark, out) == {("10:00", 1): 2}


def test_upsert_keeps_latest_and_compaction_keeps_state(spark, tmp_path):
    path, packed = str(tmp_path / "agg"), str(tmp_path / "packed")
    schema = "window_start timestamp_ntz, biz_type string, customer_id long, order_cnt long, amount_sum decimal(18,4)"
    w = datetime(2026, 5, 9, 10, 0)
    for n, rows in enumerate([[(w, "ORDER", 1, 1, ONE)], [(w, "ORDER", 1, 5, TWO), (w, "ORDER", 2, 1, ONE)], [(w, "ORDER", 3, 1, ONE)]]):
        tab.upsert_batch(spark.createDataFrame(rows, schema), n, path, T0 + timedelta(minutes=n))
    state = tab.read_latest(spark, path)
    assert {(r.customer_id, r.order_cnt) for r in state.collect()} == {(1, 5), (2, 1), (3, 1)}
    plan = state.filter("customer_id = 1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(customer_id,1)" in plan
    tab.compact(spark, path, packed, upto=1)
    tab.upsert_batch(spark.createDataFrame([(w, "ORDER", 3, 1, ONE)], schema), 2, packed, T0 + timedelta(minutes=2))
    assert tab.read_latest(spark, packed).exceptAll(state).count() == 0
    assert tab.read_batches(spark, packed, S.AGG_1MIN).count() == 3


def test_daily_table_and_ad_hoc_sql(spark, tmp_path):
    agg, daily = str(tmp_path / "agg"), str(tmp_path / "daily")
    schema = "window_start timestamp_ntz, biz_type string, customer_id long, order_cnt long, amount_sum decimal(18,4)"
    first = [(datetime(2026, 5, 8, 23, 59), "ORDER", 1, 1, ONE), (datetime(2026, 5, 9, 0, 0), "ORDER", 1, 1, ONE)]
    late = [(datetime(2026, 5, 9, 0, 0), "ORDER", 1, 2, TWO), (datetime(2026, 5, 9, 10, 0), "REFUND", 2, 1, -ONE)]
    for n, rows in enumerate([first, late]):
        tab.upsert_batch(spark.createDataFrame(rows, schema), n, agg, T0)
        refresh_daily(spark, agg, daily, n, T0, since=datetime(2026, 5, 9) if n else None)
    state = tab.read_latest(spark, daily, S.AGG_DAILY, S.DAILY_KEY)
    assert {(str(r.stat_date), r.biz_type): (r.order_cnt, r.amount_sum) for r in state.collect()} == {
        ("2026-05-08", "ORDER"): (1, ONE), ("2026-05-09", "ORDER"): (2, TWO), ("2026-05-09", "REFUND"): (1, -ONE),
    }
    tab.register_views(spark, {"agg_order_1min": tab.read_latest(spark, agg), "agg_order_daily": state})
    told = spark.sql("""
        WITH busiest AS (SELECT customer_id, max(window_start) AS last_minute, count(*) AS minutes FROM agg_order_1min GROUP BY customer_id)
        SELECT b.customer_id, b.minutes, d.biz_type FROM busiest b
        JOIN agg_order_daily d ON d.stat_date = to_date(b.last_minute) AND d.biz_type = 'REFUND'""").collect()
    assert sorted((r.customer_id, r.minutes, r.biz_type) for r in told) == [(1, 2, "REFUND"), (2, 1, "REFUND")]


def test_expired_ledger_batches_are_dropped_whole(spark, tmp_path):
    path = str(tmp_path / "ledger")
    for n, days in enumerate([10, 8, 1]):
        tab.write_batch(spark.createDataFrame([(f"e{n}", T0 - timedelta(days=days)), (f"f{n}", T0 - timedelta(days=7))][: 2 if n == 1 else 1], S.LEDGER), path, n)
    assert tab.drop_expired_batches(spark, path, T0) == [0]
    assert {r.event_id for r in tab.read_batches(spark, path, S.LEDGER).collect()} == {"e1", "f1", "e2"}


@pytest.mark.parametrize("salt", [0, 4])
def test_stateful_dedup_on_arrival_time(spark, tmp_path, salt):
    src = Folder(spark, tmp_path / "in", "event_id string, arrival_ts timestamp")
    out = str(tmp_path / "out")
    src.add([("a", T0), ("a", T0 + timedelta(seconds=1)), ("b", T0 - timedelta(hours=1))])
    src.add([("b", T0 + timedelta(hours=2)), ("c", T0 - timedelta(hours=3))])
    src.add([("a", T0 + timedelta(days=1))] * 50)
    catch_up(dedup_stream(src.stream(), salt=salt), lambda df, n: tab.write_batch(df, out, n), str(tmp_path / "check"))
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_thousand_events_reach_facts_and_aggregate(spark, tmp_path):
    """V1: the happy path, with fresh ids."""
    ingest = Ingest(spark, tmp_path)
    ev = synth.synthetic_events(synth.sequence(spark, 1000, start_seq=500_000), T0, seed=7, dup_percent=5)
    values = ev.select(synth.to_raw_json(ev).alias("value")).collect()
    ingest.src.add([(r.value, i % 3, i, T0) for i, r in enumerate(values)])
    ingest.run()
    assert len(ingest.orders()) == 1000 and len(ingest.mid()) == 1000
    total = A.agg_windowed(decode_mid(tab.read_batches(spark, ingest.tables.mid, S.WIRE))).agg(F.sum("order_cnt")).first()[0]
    assert total == 1000
