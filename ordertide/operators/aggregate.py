"""Windowed sums and the roll-ups read from them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide import schemas as S
from ordertide.functions.clock import as_instant, utc_to_shanghai

WINDOW_WIDTH = "1 minute"
OUT_OF_ORDER = "5 seconds"
NOT_NULL = ("event_time", "biz_type", "customer_id")


def order_cnt() -> Column:
    return F.count(F.lit(1)).alias("order_cnt")


def amount_sum(col: str = "amount") -> Column:
    """Sum as decimal(18,4), 0 where every amount is null. A sum that does not fit fails
    the query instead of turning null, whatever the session's ANSI setting is."""
    total = F.coalesce(F.sum(col), F.lit(0).cast("decimal(28,4)"))
    narrow = total.try_cast(S.AMOUNT)
    overflow = F.raise_error(F.lit("amount_sum does not fit decimal(18,4)")).cast(S.AMOUNT)
    return F.coalesce(narrow, overflow).alias("amount_sum")


def complete_events(events: DataFrame) -> DataFrame:
    """P10: events that can be stored under the result key."""
    return events.dropna(subset=list(NOT_NULL))


def incomplete_events(events: DataFrame) -> DataFrame:
    """P10: the rest, to be set aside rather than lost, with the names of what is ``missing``."""
    missing = F.concat_ws(",", *[F.when(F.col(name).isNull(), F.lit(name)) for name in NOT_NULL])
    return events.withColumn("missing", missing).filter(F.col("missing") != "")


def agg_windowed(
    events: DataFrame,
    keys: Sequence[str] = ("biz_type", "customer_id"),
    width: str = WINDOW_WIDTH,
    delay: str = OUT_OF_ORDER,
) -> DataFrame:
    """Tumbling COUNT and SUM per key; the same plan for batch and stream.

    Partial sums are formed before the shuffle, so a hot key costs one row per task.
    ``window_start`` is Shanghai wall time.
    """
    windowed = (
        events.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", width).alias("_w"), *keys)
        .agg(order_cnt(), amount_sum())
    )
    return windowed.select(
        utc_to_shanghai(F.col("_w.start")).alias("window_start"), *keys, "order_cnt", "amount_sum"
    )


def agg_by_dimension(
    agg_1min: DataFrame, dim: DataFrame, cols: Sequence[str] = ("level", "region")
) -> DataFrame:
    """The one-minute result by customer attributes.

    The lookup runs on aggregated rows, not on events; customers without a
    dimension row form the null group.
    """
    looked_up = dim.select("customer_id", *[F.col(c).alias(f"customer_{c}") for c in cols])
    joined = agg_1min.join(looked_up, "customer_id", "left")
    return _roll(joined, ["window_start", "biz_type", *[f"customer_{c}" for c in cols]])


def _roll(agg: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return agg.groupBy(*keys).agg(F.sum("order_cnt").alias("order_cnt"), amount_sum("amount_sum"))


def rollup_daily(agg_1min: DataFrame) -> DataFrame:
    """A2: per Shanghai calendar day and biz type, from the one-minute result."""
    return _roll(agg_1min, [F.to_date("window_start").alias("stat_date"), "biz_type"])


def recent_minutes(agg_1min: DataFrame, now: datetime | Column, minutes: int = 10, n: int = 20) -> DataFrame:
    """Latest minutes per biz type. The range reaches the scan of the result table, and
    of a table kept by ``stat_date`` only the days it touches are read."""
    since = utc_to_shanghai(as_instant(now)) - F.expr(f"interval {minutes} minutes")
    recent = agg_1min.filter(F.col("window_start") >= since)
    if "stat_date" in agg_1min.columns:
        recent = recent.filter(F.col("stat_date") >= F.to_date(since))
    return _roll(recent, ["window_start", "biz_type"]).orderBy(F.desc("window_start"), "biz_type").limit(n)


def latest_rows(agg_1min: DataFrame, n: int = 10) -> DataFrame:
    """Latest result rows; ties are broken on the rest of the key."""
    return agg_1min.orderBy(F.desc("window_start"), "biz_type", "customer_id").limit(n)


def profile(df: DataFrame, col: str) -> DataFrame:
    """A4: rows per value of a column."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("row_cnt"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A5: row count of each table, one row per table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_cnt")).select(F.lit(name).alias("table_name"), "row_cnt")
        for name, df in tables.items()
    ]
    out = counted[0]
    for part in counted[1:]:
        out = out.unionAll(part)
    return out


def key_uniqueness(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows against distinct keys; equal numbers mean the key holds."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_cnt"), F.count(F.lit(1)).alias("key_cnt")
    )
