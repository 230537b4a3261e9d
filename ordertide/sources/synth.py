"""Generated order events, and the seed customers they refer to."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide import schemas as S
from ordertide.functions.clock import as_instant, utc_to_shanghai
from ordertide.functions.text import padded_id

# 95 of 100 events are orders; amounts lie between 1.0000 and
# 999.9900; customers are numbered 1 to 50.
ORDER_SHARE = 95
MIN_UNITS = 10_000
MAX_UNITS = 9_999_900
CUSTOMERS = 50

# Seed customers as (customer_id, level, region).
SEED_CUSTOMERS = (
    (1, "NORMAL", "CN-EAST"), (2, "VIP", "CN-EAST"), (3, "SVIP", "CN-EAST"),
    (4, "NORMAL", "CN-NORTH"), (5, "VIP", "CN-NORTH"), (6, "SVIP", "CN-NORTH"),
    (7, "NORMAL", "CN-SOUTH"), (8, "VIP", "CN-SOUTH"), (9, "SVIP", "CN-SOUTH"),
    (10, "NORMAL", "CN-EAST"), (11, "VIP", "CN-EAST"), (12, "NORMAL", "CN-NORTH"),
    (13, "VIP", "CN-NORTH"), (14, "NORMAL", "CN-SOUTH"), (15, "VIP", "CN-SOUTH"),
    (16, "NORMAL", "CN-EAST"), (17, "NORMAL", "CN-NORTH"), (18, "NORMAL", "CN-SOUTH"),
    (19, "VIP", "CN-EAST"), (20, "VIP", "CN-NORTH"), (21, "VIP", "CN-SOUTH"),
    (22, "SVIP", "CN-EAST"), (23, "SVIP", "CN-NORTH"), (24, "SVIP", "CN-SOUTH"),
    (25, "NORMAL", "CN-EAST"), (26, "NORMAL", "CN-NORTH"), (27, "NORMAL", "CN-SOUTH"),
    (28, "VIP", "CN-EAST"), (29, "VIP", "CN-NORTH"), (30, "VIP", "CN-SOUTH"),
    (31, "NORMAL", "CN-EAST"), (32, "NORMAL", "CN-NORTH"), (33, "NORMAL", "CN-SOUTH"),
    (34, "VIP", "CN-EAST"), (35, "VIP", "CN-NORTH"), (36, "VIP", "CN-SOUTH"),
    (37, "SVIP", "CN-EAST"), (38, "SVIP", "CN-NORTH"), (39, "SVIP", "CN-SOUTH"),
    (40, "NORMAL", "CN-EAST"), (41, "NORMAL", "CN-NORTH"), (42, "NORMAL", "CN-SOUTH"),
    (43, "VIP", "CN-EAST"), (44, "VIP", "CN-NORTH"), (45, "VIP", "CN-SOUTH"),
    (46, "NORMAL", "CN-EAST"), (47, "NORMAL", "CN-NORTH"), (48, "NORMAL", "CN-SOUTH"),
    (49, "VIP", "CN-EAST"), (50, "SVIP", "CN-NORTH"),
)


def seed_customers(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(list(SEED_CUSTOMERS), "customer_id bigint, level string, region string")
    name = F.concat(F.lit("customer-"), F.lpad(F.col("customer_id").cast("string"), 4, "0"))
    return rows.select("customer_id", name.alias("name"), "level", "region")


def sequence(spark: SparkSession, n: int, start_seq: int = 1, partitions: int | None = None) -> DataFrame:
    """Event numbers ``start_seq .. start_seq + n - 1``."""
    return spark.range(start_seq, start_seq + n, 1, partitions).withColumnRenamed("id", "seq")


def _draw(digest: Column, at: int, bound: int) -> Column:
    """Whole number in ``[0, bound)`` from eight hex digits of the digest."""
    word = F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint")
    return F.shiftright(word * F.lit(bound), 32)


def synthetic_events(
    seqs: DataFrame,
    base_ts: datetime | Column,
    seed: int = 42,
    dup_percent: int = 0,
    rate: int = 200,
) -> DataFrame:
    """One event per ``seq``, with ``dup_percent`` of them sent a second time.

    Every draw hangs on (seed, seq) alone, so a task that is run again yields the same
    rows and no state crosses partitions. ``rate`` events share one second of event time.
    """
    digest = F.sha2(F.concat_ws("/", F.lit(str(seed)), F.col("seq").cast("string")), 256)
    drawn = seqs.select("seq", digest.alias("_h"))
    h, seq = F.col("_h"), F.col("seq")
    refund = _draw(h, 1, 100) >= ORDER_SHARE
    units = _draw(h, 9, MAX_UNITS - MIN_UNITS + 1) + F.lit(MIN_UNITS)
    amount = (units / F.lit(10_000).cast("decimal(5,0)")).cast(S.AMOUNT)
    instant = as_instant(base_ts) + F.make_dt_interval(secs=F.floor(seq / F.lit(rate)).cast("decimal(18,6)"))
    events = drawn.select(
        padded_id("evt-", seq).alias("event_id"),
        F.when(refund, S.BIZ_TYPES[1]).otherwise(S.BIZ_TYPES[0]).alias("biz_type"),
        padded_id("order-", seq).alias("biz_key"),
        (_draw(h, 17, CUSTOMERS) + F.lit(1)).alias("customer_id"),
        F.when(refund, -amount).otherwise(amount).cast(S.AMOUNT).alias("amount"),
        utc_to_shanghai(instant).alias("event_time"),
        F.concat(F.lit("trace-"), F.substring(h, 33, 16)).alias("trace_id"),
        F.when(_draw(h, 25, 100) < dup_percent, 2).otherwise(1).alias("_copies"),
    )
    copy_no = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return events.select(*[c for c in events.columns if c != "_copies"], copy_no.alias("copy_no"))


def to_raw_json(events: DataFrame) -> Column:
    """The raw message text of generated events, amount quoted."""
    wall = F.date_format(events.event_time, "yyyy-MM-dd HH:mm:ss")
    return F.to_json(F.struct(
        events.event_id.alias("eventId"), events.biz_type.alias("bizType"), events.biz_key.alias("bizKey"),
        events.customer_id.alias("customerId"), events.amount.cast("string").alias("amount"),
        wall.alias("eventTime"), events.trace_id.alias("traceId"),
    ))
