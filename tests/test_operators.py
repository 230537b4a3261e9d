"""Claims, facts, expiry, lookups, aggregates, versions."""

from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ordertide import schemas as S
from ordertide.operators import aggregate as A
from ordertide.operators import checks, dedup, enrich, facts, upsert
from ordertide.sinks.tables import fan_out
from ordertide.sources import synth
from ordertide.sources.dimension import DimProvider

UTC = timezone.utc
T0 = datetime(2026, 5, 9, 2, 0, 0, tzinfo=UTC)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def events(spark, rows):
    """rows: (event_id, biz_type, biz_key, customer_id, amount, seconds after T0)."""
    data = [
        (e, t, k, c, None if a is None else Decimal(a), None if s is None else T0 + timedelta(seconds=s))
        for e, t, k, c, a, s in rows
    ]
    return spark.createDataFrame(data, S.EVENT)


def test_claim_takes_first_by_position_whatever_the_content(spark):
    new = spark.createDataFrame(
        [("a", 1, 5, "late"), ("a", 0, 9, "first"), ("a", 0, 10, "second"), ("b", 0, 1, "known"), ("c", 2, 2, "only")],
        "event_id string, partition int, offset long, note string",
    )
    ledger = spark.createDataFrame([("b",)], "event_id string")
    assert {(r.event_id, r.note) for r in dedup.claim(new, ledger).collect()} == {("a", "first"), ("c", "only")}


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"),
    )
    firsts = dedup.first_per_key(df, "event_id", dedup.ARRIVAL_ORDER)
    text = plan(firsts)
    assert "WindowGroupLimit" in text and "Partial" in text
    assert firsts.filter("event_id = 'hot'").collect()[0].offset == 0
    assert firsts.count() == 20001


@pytest.mark.parametrize("limit", [0, 10, 500_000])
def test_narrow_anti_join_is_exact_with_and_without_broadcast(spark, limit):
    new = spark.range(100, 200).withColumnRenamed("id", "order_id").persist()
    stored = spark.range(0, 1000, 7).withColumnRenamed("id", "order_id")
    got = dedup.anti_existing_narrow(new, stored, "order_id", max_broadcast=limit)
    assert sorted(r.order_id for r in got.collect()) == [i for i in range(100, 200) if i % 7]
    new.unpersist()


def test_narrow_anti_join_of_nothing(spark):
    none = spark.range(0).withColumnRenamed("id", "order_id")
    assert dedup.anti_existing_narrow(none, none, "order_id").count() == 0


def test_expiry_is_strict(spark):
    week = timedelta(days=7)
    ages = {"young": week - timedelta(seconds=1), "edge": week, "old": week + timedelta(seconds=1), "older": week * 2}
    ledger = spark.createDataFrame([(k, T0 - v) for k, v in ages.items()], S.LEDGER)
    assert {r.event_id for r in dedup.expire(ledger, T0).collect()} == {"young", "edge"}


def test_order_row_defaults_and_times(spark):
    df = events(spark, [("a", "ORDER", "order-0000000012", 1, None, 0), ("b", "REFUND", "x-13", 1, "-1.5", None)])
    rows = facts.to_order_row(df, T0).select(
        "order_id", "amount", "status", F.col("created_at").cast("string"), F.col("updated_at").cast("string")
    ).collect()
    assert [tuple(r) for r in rows] == [
        (12, Decimal("0.0000"), "NEW", "2026-05-09 10:00:00", "2026-05-09 10:00:00"),
        (13, Decimal("-1.5000"), "NEW", "2026-05-09 10:00:00", "2026-05-09 10:00:00"),
    ]


def test_first_fact_stands_while_both_events_count(spark):
    df = events(spark, [("a", "ORDER", "o-1", 1, "5", 0), ("b", "REFUND", "o-1", 1, "-5", 1)])
    placed = df.withColumns({"partition": F.lit(0), "offset": F.when(F.col("event_id") == "a", 0).otherwise(1)})
    orders = facts.to_order_row(placed, T0, keep=dedup.ARRIVAL_ORDER)
    kept = facts.first_write_wins(orders, orders.limit(0)).collect()
    assert [(r.order_id, r.biz_type) for r in kept] == [(1, "ORDER")]
    assert A.agg_windowed(df).count() == 2
    assert facts.first_write_wins(orders, orders).count() == 0


def test_seed_insert_ignore_twice_adds_nothing(spark):
    seed = synth.seed_customers(spark)
    empty = seed.limit(0)
    first = facts.seed_insert_ignore(seed, empty, "customer_id", S.CUSTOMER_DEFAULTS, ["name"])
    assert first.count() == 50
    assert facts.seed_insert_ignore(seed, first, "customer_id", S.CUSTOMER_DEFAULTS, ["name"]).count() == 0
    bare = spark.createDataFrame([(51, None, None, None)], seed.schema)
    row = facts.seed_insert_ignore(bare, empty, "customer_id", S.CUSTOMER_DEFAULTS, ["name"]).first()
    assert (row.name, row.level, row.region) == ("", "NORMAL", "CN-UNKNOWN")
    levels = {r.level: r.row_cnt for r in A.profile(seed, "level").collect()}
    assert sum(levels.values()) == 50 and set(levels) == set(S.CUSTOMER_LEVELS)


DIM = "customer_id long, name string, level string, region string"


@pytest.mark.parametrize("salt", [0, 5])
def test_lookup_keeps_misses(spark, salt):
    df = events(spark, [("a", "ORDER", "o-1", 1, "1", 0), ("b", "ORDER", "o-2", 9, "1", 0), ("c", "ORDER", "o-3", None, "1", 0)])
    dim = spark.createDataFrame([(1, "n", "VIP", "CN-EAST")], DIM)
    got = {r.event_id: (r.customer_level, r.customer_region) for r in enrich.enrich(df, dim, salt=salt).collect()}
    assert got == {"a": ("VIP", "CN-EAST"), "b": (None, None), "c": (None, None)}


def test_no_join_without_dimension_columns(spark):
    df = events(spark, [("a", "ORDER", "o-1", 1, "1", 0)])
    dim = spark.createDataFrame([(1, "n", "VIP", "CN-EAST")], DIM)
    assert "Join" not in plan(enrich.enrich(df, dim, cols=()))


def test_dimension_is_read_again_after_its_time_limit(spark):
    loads = []

    def load():
        loads.append(1)
        return spark.createDataFrame([(1, "n", f"v{len(loads)}", "r")], DIM)

    dims = DimProvider(load, ttl_seconds=600)
    assert dims.get(T0).first().level == "v1"
    assert dims.get(T0 + timedelta(seconds=599)).first().level == "v1"
    assert dims.get(T0 + timedelta(seconds=600)).first().level == "v2"
    assert len(loads) == 2


def test_dimension_source_is_read_once_within_its_time_limit(spark):
    reads = spark.sparkContext.accumulator(0)

    def rows(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    dims = DimProvider(lambda: spark.range(4).coalesce(1).withColumnRenamed("id", "customer_id").mapInPandas(rows, "customer_id long"))
    for second in (0, 200, 599):
        assert dims.get(T0 + timedelta(seconds=second)).count() == 4
    assert reads.value == 4


def test_dimension_is_broadcast_only_up_to_its_bytes(spark):
    wide = lambda: spark.range(3).select(F.col("id").alias("customer_id"), F.lit("x" * 100).alias("name"))
    for limit, broadcast in ((400, True), (200, False)):
        dims = DimProvider(wide, max_broadcast_bytes=limit)
        dims.get(T0)
        assert dims.is_broadcast == broadcast


def test_dimension_is_broadcast_only_up_to_its_bound(spark):
    dims = DimProvider(lambda: spark.range(50).withColumnRenamed("id", "customer_id"), max_broadcast_rows=50)
    dims.get(T0)
    assert dims.is_broadcast
    dims = DimProvider(lambda: spark.range(51).withColumnRenamed("id", "customer_id"), max_broadcast_rows=50)
    dims.get(T0)
    assert not dims.is_broadcast


def test_window_edges_and_null_amounts(spark):
    df = events(spark, [
        ("a", "ORDER", "o-1", 1, "1", 60), ("b", "ORDER", "o-2", 1, None, 59.999), ("c", "ORDER", "o-3", 1, "2.5", 119.999),
        ("d", "REFUND", "o-4", 1, "-2.5", 61), ("e", "ORDER", "o-5", 2, None, 61),
    ])
    got = {
        (r.w, r.biz_type, r.customer_id): (r.order_cnt, r.amount_sum)
        for r in A.agg_windowed(df).withColumn("w", F.col("window_start").cast("string")).collect()
    }
    assert got == {
        ("2026-05-09 10:00:00", "ORDER", 1): (1, Decimal("0.0000")),
        ("2026-05-09 10:01:00", "ORDER", 1): (2, Decimal("3.5000")),
        ("2026-05-09 10:01:00", "REFUND", 1): (1, Decimal("-2.5000")),
        ("2026-05-09 10:01:00", "ORDER", 2): (1, Decimal("0.0000")),
    }


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sum_overflow_fails(spark, ansi):
    df = events(spark, [(str(i), "ORDER", "o-1", 1, "99999999999999.9999", 0) for i in range(2)])
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="does not fit"):
            A.agg_windowed(df).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_incomplete_events_are_set_aside_not_lost(spark):
    df = events(spark, [
        ("a", "ORDER", "o-1", 1, "1", 0), ("b", None, "o-1", 1, "1", 0), ("c", "ORDER", "o-1", None, "1", 0),
        ("d", "ORDER", "o-1", 1, "1", None),
    ])
    assert {r.event_id for r in A.complete_events(df).collect()} == {"a"}
    assert {r.event_id for r in A.incomplete_events(df).collect()} == {"b", "c", "d"}


def test_aggregate_combines_before_the_shuffle_and_reads_no_dimension(spark):
    text = plan(A.agg_windowed(events(spark, [("a", "ORDER", "o-1", 1, "1", 0)])))
    assert text.count("Exchange") == 1 and "partial_count" in text and "Join" not in text


def test_daily_rollup_uses_the_shanghai_day(spark):
    df = events(spark, [("a", "ORDER", "o-1", 1, "1", 14 * 3600 - 1), ("b", "ORDER", "o-2", 1, "2", 14 * 3600)])
    got = {str(r.stat_date): r.order_cnt for r in A.rollup_daily(A.agg_windowed(df)).collect()}
    assert got == {"2026-05-09": 1, "2026-05-10": 1}


def test_recent_minutes_range_order_and_limit(spark):
    df = events(spark, [(str(i), "ORDER", "o-1", i, "1", 60 * i) for i in range(30)])
    got = A.recent_minutes(A.agg_windowed(df), T0 + timedelta(minutes=29), minutes=10, n=5).collect()
    assert [r.window_start.minute for r in got] == [29, 28, 27, 26, 25]
    whole = A.recent_minutes(A.agg_windowed(df), T0 + timedelta(minutes=29), minutes=10).collect()
    assert len(whole) == 11


def test_latest_version_wins_and_first_creation_time_stays(spark):
    versions = spark.createDataFrame(
        [(1, 10, "x", 1), (1, 20, None, 3), (1, 15, "y", 2), (2, 5, "z", 1)], "k int, n long, note string, batch_id long"
    )
    got = {r.k: (r.n, r.note) for r in upsert.latest_wins(versions, ["k"]).collect()}
    assert got == {1: (20, None), 2: (5, "z")}
    first = {r.k: r.n for r in upsert.latest_wins(versions, ["k"], keep_first=["n"]).collect()}
    assert first == {1: 10, 2: 5}


def test_fan_out_computes_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for row in rows:
            seen.add(1)
            yield row

    df = spark.range(0, 100, 1, 2).mapInArrow(lambda it: count(it), "id long")
    sizes = {}
    fan_out(df, 7, {
        "a": lambda d, n: sizes.update(a=(d.count(), n)), "b": lambda d, n: sizes.update(b=(d.filter("id < 10").count(), n)),
    })
    assert sizes == {"a": (100, 7), "b": (10, 7)}
    assert seen.value == 2


def test_key_uniqueness_counts_null_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert tuple(A.key_uniqueness(df, ["a", "b"]).first()) == (3, 2)


def test_reconcile_reports_only_differences(spark):
    df = events(spark, [("a", "ORDER", "o-1", 1, "1", 0), ("b", "ORDER", "o-2", 2, "1", 0), ("c", "ORDER", "o-3", 3, None, 0)])
    full = A.agg_windowed(df)
    assert checks.reconcile(full, full).count() == 0
    part = A.agg_windowed(df.filter("event_id <> 'c'"))
    row, = checks.reconcile(full, part).collect()
    assert (row.customer_id, row.expected_cnt, row.actual_cnt) == (3, 1, 0)


def test_generated_events_keep_their_distribution_and_replay(spark):
    base = datetime(2026, 5, 1, tzinfo=UTC)
    df = synth.synthetic_events(synth.sequence(spark, 20_000, start_seq=11), base, seed=7, dup_percent=10).persist()
    first = df.filter("copy_no = 1")
    assert first.count() == 20_000 and first.select("event_id").distinct().count() == 20_000
    stats = first.agg(
        F.avg((F.col("biz_type") == "REFUND").cast("double")).alias("refunds"),
        F.min(F.abs("amount")).alias("lo"), F.max(F.abs("amount")).alias("hi"),
        F.min("customer_id").alias("c_lo"), F.max("customer_id").alias("c_hi"),
        F.count_if((F.col("biz_type") == "REFUND") != (F.col("amount") < 0)).alias("wrong_sign"),
    ).first()
    assert 0.04 < stats.refunds < 0.06
    assert Decimal("1.0000") <= stats.lo and stats.hi <= Decimal("999.9900")
    assert (stats.c_lo, stats.c_hi, stats.wrong_sign) == (1, 50, 0)
    assert 1800 < df.filter("copy_no = 2").count() < 2200
    again = synth.synthetic_events(synth.sequence(spark, 20_000, 11, partitions=3), base, seed=7, dup_percent=10)
    assert df.exceptAll(again).count() == 0
    other = synth.synthetic_events(synth.sequence(spark, 20_000, 11), base, seed=8, dup_percent=10)
    assert df.exceptAll(other).count() > 0
    df.unpersist()
