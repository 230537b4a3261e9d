"""Order rows and keyed inserts that never overwrite."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide import schemas as S
from ordertide.functions.clock import as_instant, utc_to_shanghai
from ordertide.functions.text import order_id
from ordertide.operators.dedup import ARRIVAL_ORDER, anti_existing, first_per_key


def with_defaults(df: DataFrame, defaults: dict[str, Any]) -> DataFrame:
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(value).cast(df.schema[name].dataType))
        for name, value in defaults.items()
    })


def to_order_row(events: DataFrame, now: datetime | Column, keep: Sequence[str] = ()) -> DataFrame:
    """Accepted event -> fact row. Times are Shanghai wall time; an event without
    a time is stamped ``now``."""
    stamp = as_instant(now)
    rows = events.select(
        order_id(F.col("biz_key")).alias("order_id"),
        "customer_id",
        "biz_type",
        F.col("amount").cast(S.AMOUNT).alias("amount"),
        F.lit(None).cast("string").alias("status"),
        utc_to_shanghai(F.coalesce(F.col("event_time"), stamp)).alias("created_at"),
        utc_to_shanghai(stamp).alias("updated_at"),
        *keep,
    )
    return with_defaults(rows, S.ORDER_DEFAULTS)


def first_write_wins(
    new: DataFrame,
    existing: DataFrame,
    key: str = "order_id",
    order_cols: Sequence[str | Column] = ARRIVAL_ORDER,
) -> DataFrame:
    """K1: rows to append so that the first write of each key stands."""
    return anti_existing(first_per_key(new, key, order_cols), existing, key)


def seed_insert_ignore(
    new: DataFrame, existing: DataFrame, key: str, defaults: dict[str, Any], order_cols: Sequence[str | Column]
) -> DataFrame:
    """K7: rows to append to a keyed table, with column defaults in place of nulls."""
    return first_write_wins(with_defaults(new, defaults), existing, key, order_cols)
