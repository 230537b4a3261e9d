"""Streams over the given tables: messages are staged in time order and taken in by
the long-running queries, which stop and start again between the stages."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide import schemas as S
from ordertide.operators.aggregate import agg_windowed, complete_events, rollup_daily, table_counts
from ordertide.operators.checks import growth
from ordertide.operators.dedup import dedup_stream
from ordertide.operators.wire import to_wire
from ordertide.plans import views as V
from ordertide.session import work_dir
from ordertide.sinks.tables import ensure_dir, read_batches, read_latest, stream_batches, write_batch
from ordertide.sources.decode import decode_mid
from ordertide.sources.batches import follow_batches
from ordertide.sources.dimension import PartialDimProvider, keyed_loader
from ordertide.sources.topic import read_message_files
from ordertide.streaming import jobs
from ordertide.streaming.aggregate import MID_TOPIC, aggregate_stream, aggregate_writer, decoded_time, lookup_writer, single_deliveries
from ordertide.streaming.alarms import FIRING, RESOLVED, alarms_writer, closed_ratios, read_alarms
from ordertide.streaming.claims import claims_writer
from ordertide.streaming.ingest import IngestTables, first_orders, ingest_stream, ingest_writer, orders_writer
from ordertide.streaming.runner import catch_up

# An event this late closes every real minute; it is filtered out of the result.
SENTINEL = "2100-01-01 00:00:00"
# How long minutes stay open in the query about late rows: longer than one stage, shorter than two.
LATENESS = "15 days"


def _stage(messages: DataFrame, path: str) -> None:
    messages.write.mode("append").parquet(path)


def _sentinel(spark: SparkSession) -> DataFrame:
    event = spark.range(1).select(
        F.lit("evt-sentinel").alias("event_id"), F.lit("NONE").alias("biz_type"), F.lit("none-0").alias("biz_key"),
        F.lit(0).cast("bigint").alias("customer_id"), F.lit(0).cast(S.AMOUNT).alias("amount"),
        F.lit(SENTINEL).cast("timestamp").alias("event_time"),
    )
    return to_wire(event, F.col("event_time"))


def stream_agg_1min(spark: SparkSession, sf: str) -> DataFrame:
    """Mid messages in three stages through the aggregate query."""
    root = work_dir(spark, "stream-agg")
    source, result, checkpoint = ensure_dir(spark, f"{root}/mid"), f"{root}/agg", f"{root}/checkpoint"
    for messages in _mid_stages(spark, sf):
        _stage(messages, source)
        stream = aggregate_stream(read_message_files(spark, source, S.WIRE))
        catch_up(stream, aggregate_writer(result), checkpoint, tables=[result])
    return _minutes(spark, result)


def _mid_stages(spark: SparkSession, sf: str) -> list[DataFrame]:
    return [to_wire(chunk, F.col("arrival_ts")) for chunk in V.chunks_of(spark, sf)] + [_sentinel(spark)]


def _minutes(spark: SparkSession, result: str) -> DataFrame:
    rows = read_latest(spark, result).drop("update_time")
    return rows.filter(F.col("window_start") < F.lit(SENTINEL).cast("timestamp_ntz"))


def _until_done(start, crash) -> None:
    """Run a query that breaks off once, and start it again once."""
    try:
        start()
    except StreamingQueryException:
        if not crash.failed:
            raise
        start()


def restart_agg_no_dup(spark: SparkSession, sf: str) -> DataFrame:
    """The aggregate query breaks off in every stage after its write, and is started again once."""
    root = work_dir(spark, "restart-agg")
    source, result, checkpoint = ensure_dir(spark, f"{root}/mid"), f"{root}/agg", f"{root}/checkpoint"
    for messages in _mid_stages(spark, sf):
        _stage(messages, source)
        crash = _FailOnce("agg", None)
        stream = lambda: aggregate_stream(read_message_files(spark, source, S.WIRE))
        _until_done(lambda: catch_up(stream(), aggregate_writer(result, after=crash), checkpoint), crash)  # noqa: B023
    return _minutes(spark, result)


def stream_agg_mid_twice(spark: SparkSession, sf: str) -> DataFrame:
    """A mid topic that delivers every tenth message twice; a query of its own takes each event
    once by arrival time, and the aggregate query follows its table."""
    root = work_dir(spark, "mid-twice")
    source, once = ensure_dir(spark, f"{root}/topic"), f"{root}/once"
    result = f"{root}/agg"
    for wire in _mid_stages(spark, sf):
        sent = wire.withColumn("arrival_ts", F.coalesce(decoded_time(F.col("value")), F.lit(SENTINEL).cast("timestamp")))
        again = sent.filter(F.pmod(F.crc32("value"), F.lit(10)) == 0)
        _stage(sent.unionAll(again.withColumn("arrival_ts", F.col("arrival_ts") + F.expr("interval 1 second"))), source)
        topic = read_message_files(spark, source, MID_TOPIC)
        catch_up(single_deliveries(topic), lambda df, n: write_batch(df, once, n), f"{root}/check-once")
        catch_up(aggregate_stream(stream_batches(spark, once, S.WIRE)), aggregate_writer(result), f"{root}/check-agg")
    return _minutes(spark, result)


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Doubled events in three stages through the stateful dedup."""
    root = work_dir(spark, "stream-dedup")
    source, result, checkpoint = ensure_dir(spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint"
    doubled = lambda events: V.dup_events_of(events).select("event_id", "biz_type", "partition", "offset", "arrival_ts")
    for chunk in V.chunks_of(spark, sf, doubled):
        _stage(chunk, source)
        kept = dedup_stream(read_message_files(spark, source, chunk.schema), salt=4)
        catch_up(kept, lambda df, batch: write_batch(df, result, batch), checkpoint, tables=[result])
    rows = read_batches(spark, result, chunk.schema)
    return rows.groupBy("biz_type").agg(F.count(F.lit(1)).alias("kept_cnt"))


def restart_mid_follow(spark: SparkSession, sf: str) -> DataFrame:
    """The mid table's writer breaks off inside each write, after its draft, its entry or its move; the aggregate
    query reads the table before the writer is back and after."""
    root = work_dir(spark, "mid-follow")
    source, mid, result = ensure_dir(spark, f"{root}/messages"), f"{root}/mid", f"{root}/agg"
    follow = lambda: catch_up(
        aggregate_stream(follow_batches(spark, mid, S.WIRE, "agg")), aggregate_writer(result), f"{root}/check-agg"
    )
    for n, messages in enumerate(_mid_stages(spark, sf)):
        _stage(messages, source)
        crash = _FailOnce(("draft", "entry", "move")[n % 3], None)
        write = lambda df, k: write_batch(df, mid, k, after=lambda step: crash(step, k))  # noqa: B023, E731
        publish = lambda: catch_up(read_message_files(spark, source, S.WIRE), write, f"{root}/check-mid")  # noqa: B023, E731

        def again() -> None:
            if crash.failed:  # noqa: B023
                follow()
            publish()  # noqa: B023

        _until_done(again, crash)
        follow()
    return _minutes(spark, result)


def stream_order_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Raw messages in stages; the orders query keeps order numbers as state and breaks off once per stage."""
    root = work_dir(spark, "order-facts")
    source, tables = ensure_dir(spark, f"{root}/raw"), IngestTables(f"{root}/tables")
    for chunk in V.chunks_of(spark, sf):
        _stage(V.raw_messages(chunk), source)
        catch_up(ingest_stream(read_message_files(spark, source)), ingest_writer(tables, orders_here=False), f"{root}/check-ingest")
        crash = _FailOnce("orders", None)

        def store() -> None:
            writes = follow_batches(spark, tables.order_writes, S.ORDER_WRITE, "orders", with_number=True)
            catch_up(first_orders(writes), orders_writer(tables.orders, after=crash), f"{root}/check-orders", mode="update")  # noqa: B023

        _until_done(store, crash)
    return read_batches(spark, tables.orders, S.ORDER).select(*[c for c in S.ORDER.names if c != "updated_at"])


def stream_daily(spark: SparkSession, sf: str) -> DataFrame:
    """A2: days kept up to date while minutes come in, the middle stage's last; the job breaks off between the two writes."""
    root = work_dir(spark, "stream-daily")
    source, result, daily = ensure_dir(spark, f"{root}/mid"), f"{root}/agg", f"{root}/daily"
    first, middle, last, _ = _mid_stages(spark, sf)
    for messages in (first, last, middle):
        _stage(messages, source)
        crash = _FailOnce("agg", None)
        minutes = agg_windowed(complete_events(decode_mid(read_message_files(spark, source, S.WIRE))), delay="400 days")
        write = aggregate_writer(result, after=crash, daily=daily)
        _until_done(lambda: catch_up(minutes, write, f"{root}/check", mode="update"), crash)  # noqa: B023
    return read_latest(spark, daily, S.AGG_DAILY, S.DAILY_KEY).drop("update_time")


def stream_dedup_late_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Two partitions in stages of time, then all of the third, whose oldest messages are by then weeks behind."""
    root = work_dir(spark, "late-partition")
    source, result, checkpoint = ensure_dir(spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint"
    columns = ("event_id", "biz_type", "partition", "offset", "arrival_ts")
    sent = lambda events: V.sent_again_of(events).select(*columns)
    chunks = V.chunks_of(spark, sf, sent)
    late = F.col("partition") == 2
    whole = chunks[0]
    for chunk in chunks[1:]:
        whole = whole.unionAll(chunk)
    for stage in [*(chunk.filter(~late) for chunk in chunks), whole.filter(late)]:
        _stage(stage, source)
        crash = _FailOnce("claims", None)
        write = claims_writer(result, stage.schema, after=crash)
        _until_done(lambda: catch_up(read_message_files(spark, source, stage.schema), write, checkpoint), crash)  # noqa: B023
    rows = read_batches(spark, result, stage.schema)
    return rows.groupBy("biz_type", "partition").agg(F.count(F.lit(1)).alias("kept_cnt"), F.sum("offset").alias("offset_sum"))


def stream_alarms(spark: SparkSession, sf: str) -> DataFrame:
    """M5: the ingest log in stages through the alarms query, which breaks off once per stage after its write."""
    root = work_dir(spark, "alarms")
    source, result = ensure_dir(spark, f"{root}/log"), f"{root}/alarms"
    chunks = V.chunks_of(spark, sf, V.ingest_log_of)
    schema = chunks[0].schema
    last = spark.range(1).select(
        F.lit(SENTINEL).cast("timestamp").alias("arrival_ts"), F.lit("evt-sentinel").alias("event_id"),
        F.lit("persisted").alias("outcome"), F.lit(0).cast(schema["proc_ms"].dataType).alias("proc_ms"),
    )
    for log in [*chunks, last]:
        _stage(log, source)
        crash = _FailOnce("alarms", None)
        stream = lambda: closed_ratios(read_message_files(spark, source, schema))
        _until_done(lambda: catch_up(stream(), alarms_writer(result, after=crash), f"{root}/checkpoint"), crash)  # noqa: B023
    return read_alarms(spark, result).where(F.col("state").isin(FIRING, RESOLVED)).drop("state")


def stream_enriched(spark: SparkSession, sf: str) -> DataFrame:
    """Mid messages in stages; a batch loads only customers that aren't held, and breaks off once per stage after its write."""
    root = work_dir(spark, "enriched")
    source, result = ensure_dir(spark, f"{root}/mid"), f"{root}/enriched"
    dims = PartialDimProvider(keyed_loader(lambda: V.dim_customer(spark, sf)))
    for messages in _mid_stages(spark, sf)[:-1]:
        _stage(messages, source)
        crash = _FailOnce("enriched", None)
        events = lambda: decode_mid(read_message_files(spark, source, S.WIRE))
        _until_done(lambda: catch_up(events(), lookup_writer(result, dims, after=crash), f"{root}/checkpoint"), crash)  # noqa: B023
    return read_batches(spark, result, S.ENRICHED).select(*[c for c in S.ENRICHED.names if c != "biz_key"])


def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The first and the last stage, then the middle one: of its events only those of minutes that are
    still open count. Per kind and day, what was counted."""
    root = work_dir(spark, "late-rows")
    source, result = ensure_dir(spark, f"{root}/mid"), f"{root}/agg"
    first, middle, last, end = _mid_stages(spark, sf)
    for messages in (first, last, middle, end):
        _stage(messages, source)
        minutes = agg_windowed(complete_events(decode_mid(read_message_files(spark, source, S.WIRE))), delay=LATENESS)
        catch_up(minutes, aggregate_writer(result), f"{root}/checkpoint", tables=[result])
    return rollup_daily(_minutes(spark, result))


def job_minutes(spark: SparkSession, sf: str) -> DataFrame:
    """V1: raw messages through both jobs, started again when the last message has come, to stored minutes."""
    root = work_dir(spark, "jobs")
    source = ensure_dir(spark, f"{root}/raw")
    value = ('{"eventId":"evt-sentinel","bizType":"NONE","bizKey":"none-0","customerId":0,"amount":"0",'
             f'"eventTime":"{SENTINEL}"}}')
    events = V.src_events(spark, sf)
    sentinel = events.agg(F.max("arrival_ts").alias("arrival_ts")).select(
        F.lit(value).alias("value"), F.lit(0).alias("partition"), F.lit(-1).cast("bigint").alias("offset"), "arrival_ts"
    )
    for messages in (V.raw_messages(events), sentinel):
        _stage(messages, source)
        jobs.ingest(["--root", root, "--files", source, "--every", "0"], spark)
        jobs.aggregate(["--root", root, "--every", "0"], spark)
    return _minutes(spark, f"{root}/agg")


class _FailOnce:
    """Breaks off a batch after a given step, the first time only; no number means whichever comes."""

    def __init__(self, step: str, batch_id: int | None):
        self._at = (step, batch_id)
        self.failed = False

    def __call__(self, step: str, batch_id: int) -> None:
        if not self.failed and step == self._at[0] and self._at[1] in (None, batch_id):
            self.failed = True
            raise RuntimeError(f"broken off after {step}")


def restart_no_dup(spark: SparkSession, sf: str, chunks: int = V.CHUNKS) -> DataFrame:
    """Raw messages in stages; each batch breaks off once, after another step."""
    root = work_dir(spark, "restart")
    source, checkpoint = ensure_dir(spark, f"{root}/raw"), f"{root}/checkpoint"
    tables = IngestTables(f"{root}/tables")
    steps = ("ledger", "orders", "mid")
    for n, chunk in enumerate(V.chunks_of(spark, sf, chunks=chunks)):
        _stage(V.raw_messages(chunk), source)
        crash = _FailOnce(steps[n % len(steps)], n)
        stream = lambda: ingest_stream(read_message_files(spark, source))
        _until_done(lambda: catch_up(stream(), ingest_writer(tables, after=crash), checkpoint), crash)  # noqa: B023
    mid = decode_mid(read_batches(spark, tables.mid, S.WIRE))
    return mid.select("event_id", "biz_type", "biz_key", "customer_id", "amount")


def replay_no_growth(spark: SparkSession, sf: str) -> DataFrame:
    """V2: the same messages sent a second time add nothing to ledger, orders and mid."""
    root = work_dir(spark, "replay")
    source, checkpoint = ensure_dir(spark, f"{root}/raw"), f"{root}/checkpoint"
    tables = IngestTables(f"{root}/tables")
    messages = V.raw_messages(V.src_events(spark, sf))
    again = messages.withColumns({
        "offset": F.col("offset") + F.lit(1_000_000_000_000),
        "arrival_ts": F.col("arrival_ts") + F.expr("interval 1 hour"),
    })
    counts = []
    for n, sent in enumerate((messages, again)):
        _stage(sent, source)
        catch_up(
            ingest_stream(read_message_files(spark, source)), ingest_writer(tables), checkpoint,
            tables=tables.all(),
        )
        counts.append(table_counts({
            "ledger": read_batches(spark, tables.ledger, S.LEDGER, before=n + 1),
            "mid": read_batches(spark, tables.mid, S.WIRE, before=n + 1),
            "orders": read_batches(spark, tables.orders, S.ORDER, before=n + 1),
        }))
    return growth(*counts)
