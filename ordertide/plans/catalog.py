"""Registered queries over the given tables.

Result columns leave here in types that any client prints alike: amounts as double,
times without zone, dates as text. The operators themselves keep decimal(18,4).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide import schemas as S
from ordertide.functions.text import order_id
from ordertide.operators import aggregate as A
from ordertide.operators import checks, dedup, enrich, facts, observe, upsert
from ordertide.operators.wire import to_wire
from ordertide.plans import staged
from ordertide.plans import views as V
from ordertide.session import configure, work_dir
from ordertide.sinks.tables import fan_out, read_batches, read_latest, write_batch
from ordertide.sources.decode import accepted, decode_mid, decode_raw
from ordertide.sources.dimension import DimProvider
from ordertide.sources.synth import synthetic_events as generate
from ordertide.streaming.aggregate import aggregate_writer

Query = Callable[[SparkSession, str], DataFrame]

LEDGER_NOW = datetime(2024, 1, 20, 12, 0, 0)
REPORT_NOW = datetime(2024, 1, 31, 0, 0, 0)
SYNTH_BASE = datetime(2024, 1, 1, 0, 0, 0)


def edge(df: DataFrame) -> DataFrame:
    """Decimals to double, instants to UTC wall time, dates to text."""
    casts = {"timestamp": "timestamp_ntz", "date": "string"}
    out = []
    for name, dtype in df.dtypes:
        target = "double" if dtype.startswith("decimal") else casts.get(dtype)
        out.append(F.col(name).cast(target).alias(name) if target else F.col(name))
    return df.select(*out)


def _decoded(spark: SparkSession, sf: str) -> DataFrame:
    return decode_raw(V.raw_messages(V.src_events(spark, sf)), F.col("arrival_ts"))


def _decoded_mid(spark: SparkSession, sf: str) -> DataFrame:
    return decode_mid(V.mid_messages_with_faults(V.src_events(spark, sf)))


def _agg(spark: SparkSession, sf: str) -> DataFrame:
    return A.agg_windowed(V.src_events(spark, sf))


def _stored_agg(spark: SparkSession, sf: str) -> DataFrame:
    """The one-minute table as the aggregate job's writer keeps it."""
    path = work_dir(spark, "agg-by-day")
    aggregate_writer(path)(_agg(spark, sf), 0)
    return read_latest(spark, path, S.AGG_BY_DAY)


# --- sources ---------------------------------------------------------------

def dim_scan(spark: SparkSession, sf: str) -> DataFrame:
    return V.dim_customer(spark, sf)


def parse_raw_events(spark: SparkSession, sf: str) -> DataFrame:
    return accepted(_decoded(spark, sf)).select(
        "partition", "offset", "event_id", "biz_type", "biz_key", "customer_id", "amount", "event_time"
    )


def parse_mid_events(spark: SparkSession, sf: str) -> DataFrame:
    return _decoded_mid(spark, sf).withColumn("customer_id", F.col("customer_id").cast("string"))


def synthetic_events(spark: SparkSession, sf: str) -> DataFrame:
    seqs = V.table(spark, sf, "events").select(F.col("event_id").alias("seq"))
    return generate(seqs, SYNTH_BASE, seed=42, dup_percent=5)


# --- sinks and write modes -------------------------------------------------

def order_fact_first_write(spark: SparkSession, sf: str) -> DataFrame:
    stored = V.table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    return facts.first_write_wins(
        V.order_writes(spark, sf),
        stored.select(F.col("o_orderkey").alias("order_id")),
        "order_id",
        ["written_at", "line_no", "amount"],
    )


def dedup_claim(spark: SparkSession, sf: str) -> DataFrame:
    ledger = V.src_events(spark, sf).filter(F.col("biz_type") == "signup").select("event_id")
    return dedup.claim(V.dup_events(spark, sf), ledger).select(
        "event_id", "biz_type", "customer_id", "amount", "copy_no"
    )


def mid_wire_json(spark: SparkSession, sf: str) -> DataFrame:
    return to_wire(accepted(_decoded(spark, sf)), F.col("arrival_ts"))


def upsert_latest_wins(spark: SparkSession, sf: str) -> DataFrame:
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    versions = (
        V.table(spark, sf, "orders")
        .groupBy(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("biz_type"),
            month.cast("long").alias("batch_id"),
        )
        .agg(
            F.count(F.lit(1)).alias("order_cnt"),
            F.sum(F.col("o_totalprice").cast(S.AMOUNT)).cast(S.AMOUNT).alias("amount_sum"),
        )
    )
    return upsert.latest_wins(versions, ("customer_id", "biz_type"))


def fan_out_counts(spark: SparkSession, sf: str) -> DataFrame:
    root = work_dir(spark, "fan-out")
    fan_out(_decoded(spark, sf), 0, {
        "events": lambda df, n: write_batch(accepted(df).select(*S.EVENT.names), f"{root}/events", n),
        "mid": lambda df, n: write_batch(to_wire(accepted(df), F.col("arrival_ts")), f"{root}/mid", n),
        "rejects": lambda df, n: write_batch(upsert.rejects(df), f"{root}/rejects", n),
    })
    return A.table_counts({
        "events": read_batches(spark, f"{root}/events", S.EVENT),
        "mid": read_batches(spark, f"{root}/mid", S.WIRE),
        "rejects": read_batches(spark, f"{root}/rejects", S.REJECT),
    })


def dim_seed_defaults(spark: SparkSession, sf: str) -> DataFrame:
    new = V.dim_customer(spark, sf).withColumns({
        "level": F.nullif(F.col("level"), F.lit("MACHINERY")),
        "region": F.nullif(F.col("region"), F.lit("ASIA")),
    })
    stored = V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("customer_id"))
    return facts.seed_insert_ignore(new, stored, "customer_id", S.CUSTOMER_DEFAULTS, ["name"])


def ledger_expire(spark: SparkSession, sf: str) -> DataFrame:
    ledger = V.src_events(spark, sf).select("event_id", F.col("arrival_ts").alias("created_at"))
    return dedup.expire(ledger, LEDGER_NOW)


def rejects_by_reason(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.rejects(_decoded(spark, sf)).groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("row_cnt"), F.sum("offset").alias("offset_sum")
    )


def reject_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Long broken messages are kept whole, with their start for reading."""
    long = decode_raw(V.long_messages(V.src_events(spark, sf)), F.col("arrival_ts"))
    return upsert.rejects(long).select(
        "offset", "reject_reason", "value_head", F.col("value_length").cast("long").alias("value_length"), F.sha2("value", 256).alias("value_sha256")
    )


def mid_balance(spark: SparkSession, sf: str) -> DataFrame:
    """P10: every readable mid event is in a minute or set aside with what it lacks."""
    events = _decoded_mid(spark, sf)
    read = events.agg(F.count(F.lit(1)).alias("read_cnt"))
    stored = A.agg_windowed(A.complete_events(events)).agg(F.coalesce(F.sum("order_cnt"), F.lit(0)).alias("stored_cnt"))
    aside = A.incomplete_events(events).groupBy("missing").agg(F.count(F.lit(1)).alias("n"))
    per = aside.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("aside_cnt"), F.coalesce(F.sum(F.when(F.col("missing") == "event_time", F.col("n"))), F.lit(0)).alias("no_time_cnt")
    )
    # One row each.
    rows = [df.withColumn("_one", F.lit(1)) for df in (read, stored, per)]
    joined = rows[0].join(rows[1], "_one").join(rows[2], "_one").drop("_one")
    return joined.withColumn("difference", F.col("read_cnt") - F.col("stored_cnt") - F.col("aside_cnt"))


# --- projections -----------------------------------------------------------

def order_projection(spark: SparkSession, sf: str) -> DataFrame:
    return facts.to_order_row(accepted(_decoded(spark, sf)), F.col("arrival_ts"))


def order_id_from_biz_key(spark: SparkSession, sf: str) -> DataFrame:
    keyed = _decoded(spark, sf).filter(
        F.col("reject_reason").isNull() | (F.col("reject_reason") == "bad_biz_key")
    )
    return keyed.select("offset", "biz_key", order_id(F.col("biz_key")).cast("string").alias("order_id"))


def agg_null_policy(spark: SparkSession, sf: str) -> DataFrame:
    return A.agg_windowed(A.complete_events(_decoded_mid(spark, sf)))


# --- joins -----------------------------------------------------------------

def enriched_events(spark: SparkSession, sf: str) -> DataFrame:
    events = V.src_events(spark, sf).select("event_id", "biz_type", "customer_id", "amount", "event_time")
    dims = DimProvider(lambda: V.dim_customer(spark, sf))
    return enrich.enrich(events, dims.get(REPORT_NOW))


def lookup_miss_count(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.miss_count(V.src_events(spark, sf), V.dim_customer(spark, sf))


def orphan_customers(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.orphans(V.src_events(spark, sf), V.dim_customer(spark, sf))


# --- aggregations ----------------------------------------------------------

def agg_order_1min(spark: SparkSession, sf: str) -> DataFrame:
    return _agg(spark, sf)


def agg_order_daily(spark: SparkSession, sf: str) -> DataFrame:
    return A.rollup_daily(_agg(spark, sf))


def recent_minutes_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return A.recent_minutes(_stored_agg(spark, sf), REPORT_NOW, minutes=1440, n=20)


def customers_by_level(spark: SparkSession, sf: str) -> DataFrame:
    return A.profile(V.dim_customer(spark, sf), "level")


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    names = ("customer", "events", "lineitem", "orders")
    return A.table_counts({name: V.table(spark, sf, name) for name in names})


def agg_key_uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    minutes = V.src_events(spark, sf).withColumn("window_start", F.date_trunc("minute", "event_time"))
    return A.key_uniqueness(minutes, S.AGG_KEY)


def agg_by_level_region(spark: SparkSession, sf: str) -> DataFrame:
    return A.agg_by_dimension(_agg(spark, sf), V.dim_customer(spark, sf))


def latest_agg_rows(spark: SparkSession, sf: str) -> DataFrame:
    return A.latest_rows(_stored_agg(spark, sf), 10).drop("stat_date", "update_time")


# --- observability and checks ----------------------------------------------

def ingest_throughput(spark: SparkSession, sf: str) -> DataFrame:
    return observe.throughput(V.ingest_log(spark, sf))


def latency_p95(spark: SparkSession, sf: str) -> DataFrame:
    quantiles = observe.latency_quantile(V.ingest_log(spark, sf), 0.95)
    return quantiles.select("minute", "samples", F.round("quantile", 6).alias("p95_ms"))


def step_p95(spark: SparkSession, sf: str) -> DataFrame:
    """M3: the log's outcomes stand for steps of the work."""
    steps = V.ingest_log(spark, sf).select(F.col("outcome").alias("step"), F.col("proc_ms").alias("ms"))
    return observe.step_quantile(steps, 0.95).select("step", "samples", F.round("quantile", 6).alias("p95_ms"))


def failure_ratio_5m(spark: SparkSession, sf: str) -> DataFrame:
    ratios = observe.failure_ratio(V.ingest_log(spark, sf))
    return ratios.withColumn("ratio", F.round("ratio", 9))


def sustained_threshold(spark: SparkSession, sf: str) -> DataFrame:
    ratios = observe.failure_ratio(V.ingest_log(spark, sf))
    return observe.sustained(ratios, F.col("breach") == 1, buckets=5)


def outcome_balance(spark: SparkSession, sf: str) -> DataFrame:
    return observe.balance(V.ingest_log(spark, sf))


def reconcile_detail_vs_agg(spark: SparkSession, sf: str) -> DataFrame:
    events = V.src_events(spark, sf)
    stored = A.agg_windowed(events.filter(F.col("amount") > -100))
    return checks.reconcile(A.agg_windowed(events), stored)


def reconcile_digests(spark: SparkSession, sf: str) -> DataFrame:
    """V4: the same two sides as above, compared row by row only where a minute's digests differ."""
    events = V.src_events(spark, sf)
    stored = A.agg_windowed(events.filter(F.col("amount") > -100))
    return checks.reconcile_by_digest(A.agg_windowed(events), stored)


def order_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Over a mid topic in many files, in stretches of few offsets."""
    path = work_dir(spark, "mid-topic")
    V.mid_positions(V.src_events(spark, sf)).repartition(8, "offset").write.parquet(path)
    topic = spark.read.parquet(path)
    return checks.order_violations(decode_mid(topic, keep=("key", "partition", "offset")), stretch=500)


QUERIES: dict[str, Query] = {
    fn.__name__: fn
    for fn in (
        dim_scan, parse_raw_events, parse_mid_events, synthetic_events,
        order_fact_first_write, dedup_claim, mid_wire_json, upsert_latest_wins, fan_out_counts,
        dim_seed_defaults, ledger_expire, rejects_by_reason, reject_texts, mid_balance,
        order_projection, order_id_from_biz_key, agg_null_policy,
        enriched_events, lookup_miss_count, orphan_customers,
        agg_order_1min, agg_order_daily, recent_minutes_rollup, customers_by_level, table_counts,
        agg_key_uniqueness, agg_by_level_region, latest_agg_rows,
        ingest_throughput, latency_p95, failure_ratio_5m, sustained_threshold, outcome_balance,
        reconcile_detail_vs_agg,
        staged.stream_agg_1min, staged.restart_agg_no_dup, staged.stream_agg_mid_twice, staged.stream_dedup, staged.restart_no_dup, staged.replay_no_growth,
        staged.restart_mid_follow, staged.stream_order_facts, staged.stream_dedup_late_partition, staged.stream_daily,
        staged.stream_alarms, staged.stream_enriched, staged.stream_late_rows, staged.job_minutes,
        step_p95, order_violations, reconcile_digests,
    )
}


def registered() -> dict[str, Query]:
    """The queries by name, each run under the library's session settings."""
    def bind(fn: Query) -> Query:
        return lambda spark, sf_dir: edge(fn(configure(spark), sf_dir))

    return {name: bind(fn) for name, fn in QUERIES.items()}
