"""Query 2: mid messages -> one-minute aggregate, upserted by key."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide import schemas as S
from ordertide.operators.aggregate import agg_windowed, complete_events, incomplete_events, rollup_daily
from ordertide.operators.dedup import dedup_stream
from ordertide.operators.enrich import enrich
from ordertide.operators.upsert import latest_wins
from ordertide.sinks.tables import merge_tiers, read_latest, upsert_batch, write_batch
from ordertide.sources.decode import decode_mid
from ordertide.sources.dimension import DimProvider, PartialDimProvider
from ordertide.streaming.ingest import MERGE_EVERY
from ordertide.streaming.runner import BatchWriter


def aggregate_stream(messages: DataFrame) -> DataFrame:
    """The streaming aggregate over messages with a ``value`` column.

    In append mode a minute is emitted once, after the watermark has passed its end; a
    late row counts as long as its minute is open. No customer column is part of
    the result, so the lookup join is left out.
    """
    return agg_windowed(complete_events(decode_mid(messages)))


def aggregate_writer(
    path: str,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    after: Callable[[str, int], None] = lambda step, batch_id: None,
    daily: str | None = None,
    merge_every: int = MERGE_EVERY,
) -> BatchWriter:
    """Upsert each micro-batch's finished minutes into a table with a folder per Shanghai day.

    With ``daily`` the days that the batch's minutes belong to are brought up to date in the same
    batch. ``after`` is called when a step is done. Both tables are merged by size while the query runs.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, now = batch.sparkSession, clock()
        newest = lambda key: lambda rows: latest_wins(rows, key)
        merge_tiers(spark, path, batch_id, S.AGG_BY_DAY, merge_every, ("stat_date",), newest((*S.AGG_KEY, "stat_date")))
        minutes = batch.withColumn("stat_date", F.to_date("window_start")).persist()
        try:
            upsert_batch(minutes, batch_id, path, now, partition_by=("stat_date",))
            after("agg", batch_id)
            if daily:
                merge_tiers(spark, daily, batch_id, S.AGG_DAILY, merge_every, (), newest(S.DAILY_KEY))
                upsert_batch(touched_days(spark, minutes, path), batch_id, daily, now)
                after("daily", batch_id)
        finally:
            minutes.unpersist()

    return write


def touched_days(spark: SparkSession, minutes: DataFrame, path: str) -> DataFrame:
    """A2: the daily rows of the days that ``minutes`` belong to, from the stored one-minute table.

    Only days reach the driver; they pick the folders that are read. Days are summed whole, so a late or a
    repeated minute counts once.
    """
    days = [r["stat_date"] for r in minutes.select("stat_date").distinct().collect()]
    stored = read_latest(spark, path, S.AGG_BY_DAY)
    return rollup_daily(stored.filter(F.col("stat_date").isin(*days) if days else F.lit(False)))


def refresh_daily(
    spark: SparkSession,
    agg_path: str,
    daily_path: str,
    run_id: int,
    now: datetime,
    since: datetime | None = None,
) -> None:
    """A2 K4: scheduled job that brings the daily table up to date from the one-minute table.

    ``since`` (Shanghai midnight) limits the scan to days that may have changed; days are
    recomputed whole, so late minutes are picked up, also by a second run of the same number.
    """
    minutes = read_latest(spark, agg_path)
    if since is not None:
        minutes = minutes.filter(F.col("window_start") >= F.lit(since).cast("timestamp_ntz"))
    upsert_batch(rollup_daily(minutes), run_id, daily_path, now, replace=True)


#: A mid message as a topic delivers it.
MID_TOPIC = T.StructType([*S.WIRE.fields, T.StructField("arrival_ts", T.TimestampType())])


def decoded_time(value: Column) -> Column:
    """The event time in a mid message's text."""
    return F.try_to_timestamp(F.get_json_object(value, "$.event_time"))


def single_deliveries(messages: DataFrame) -> DataFrame:
    """Mid messages of a topic, each event once.

    A publisher that repeats a batch sends its messages again; they arrive within the horizon
    and are dropped by event id. Messages without a readable id are passed on, each by its text.
    """
    event_id = F.coalesce(F.get_json_object("value", "$.event_id"), F.col("value"))
    return dedup_stream(messages.withColumn("event_id", event_id)).select(*S.WIRE.names)


def set_aside_stream(messages: DataFrame) -> DataFrame:
    """P10: mid events the result key cannot hold, for a query of their own on the same source."""
    return incomplete_events(decode_mid(messages)).select(*S.SET_ASIDE.names)


def enriched_writer(
    path: str,
    dims: DimProvider,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    salt: int = 0,
) -> BatchWriter:
    """Write enriched events; the dimension is at most ``dims``' time limit old.

    ``salt`` applies while the dimension is too large to be broadcast.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        dim = dims.get(clock())
        write_batch(enrich(batch, dim, salt=0 if dims.is_broadcast else salt), path, batch_id)

    return write


def lookup_writer(
    path: str,
    dims: PartialDimProvider,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    after: Callable[[str, int], None] = lambda step, batch_id: None,
    merge_every: int = MERGE_EVERY,
) -> BatchWriter:
    """Write enriched events; only customers that a batch names, and that aren't held or are too old, are loaded.

    An event whose customer is null or unknown keeps null columns. A batch that is run again looks its
    customers up again, but its committed files stay as they are. ``after`` is called when the write is done.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_tiers(batch.sparkSession, path, batch_id, S.ENRICHED, merge_every)
        events = batch.persist()
        try:
            write_batch(enrich(events, dims.get(events, clock())).select(*S.ENRICHED.names), path, batch_id)
            after("enriched", batch_id)
        finally:
            events.unpersist()

    return write
