"""P5, K3: accepted events as keyed messages for the mid topic."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.functions.clock import as_instant, iso_millis
from ordertide.functions.text import plain_amount


def to_wire(events: DataFrame, now: datetime | Column) -> DataFrame:
    """P5: ``key`` is the business key, so one order stays in one partition; ``value`` is
    snake_case JSON with the amount as text, the time in UTC, and nulls left out."""
    body = F.struct(
        "event_id",
        "biz_type",
        "biz_key",
        "customer_id",
        plain_amount(F.col("amount")).alias("amount"),
        iso_millis(F.coalesce(F.col("event_time"), as_instant(now))).alias("event_time"),
    )
    return events.select(F.col("biz_key").alias("key"), F.to_json(body).alias("value"))
