"""Message text -> events, strict per row for raw input and lenient per field for mid input."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide import schemas as S
from ordertide.functions import json_fields as J
from ordertide.functions.clock import as_instant, parse_mid_time, parse_wall, shanghai_to_utc
from ordertide.functions.text import order_id


def _once(df: DataFrame, name: str, col: Column) -> DataFrame:
    """Add a column that is computed once per row. A one-element explode keeps later filters
    and projections from being folded into repeated parses of the same text."""
    return df.select("*", F.explode(F.array(col)).alias(name))


def decode_raw(df: DataFrame, now: datetime | Column) -> DataFrame:
    """Parse camelCase messages and tell why a row is set aside.

    One field of the wrong kind spoils the whole row. A missing event time becomes
    ``now``. Input columns are kept; ``reject_reason`` is null for accepted rows.
    """
    value, m = F.col("value"), F.col("_m")
    text = {col: m[raw] for raw, col in S.RAW_FIELDS.items()}
    read = _once(df, "_m", J.parse(value, list(S.RAW_FIELDS)))
    odd = ~J.is_object(m)
    for raw in ("eventId", "bizType", "bizKey", "traceId"):
        odd = odd | J.is_nested(value, raw, text[S.RAW_FIELDS[raw]])
    typed = _once(read, "_t", F.struct(
        J.integer(value, "customerId", text["customer_id"]).alias("customer_id"),
        J.decimal(value, "amount", text["amount"]).alias("amount"),
        parse_wall(text["event_time"]).alias("wall"),
        odd.alias("odd"),
    ))
    t = F.col("_t")

    def misfit(name: str, read_as: Column) -> Column:
        return J.given(text[name]) & read_as.isNull()

    malformed = (
        t["odd"]
        | misfit("customer_id", t["customer_id"])
        | misfit("amount", t["amount"])
        | misfit("event_time", t["wall"])
    )
    event_id, key = text["event_id"], text["biz_key"]
    reason = (
        F.when(malformed, "malformed")
        .when(event_id.isNull() | (event_id == ""), "missing_event_id")
        .when(order_id(key).isNull(), "bad_biz_key")
        .when(text["biz_type"].isNull() | t["customer_id"].isNull(), "null_required")
    )
    return typed.select(
        *df.columns,
        event_id.alias("event_id"),
        text["biz_type"].alias("biz_type"),
        key.alias("biz_key"),
        t["customer_id"].alias("customer_id"),
        t["amount"].alias("amount"),
        F.coalesce(shanghai_to_utc(t["wall"]), as_instant(now)).alias("event_time"),
        text["trace_id"].alias("trace_id"),
        reason.alias("reject_reason"),
    )


def accepted(decoded: DataFrame) -> DataFrame:
    """Rows of :func:`decode_raw` that may be claimed."""
    return decoded.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def decode_mid(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse snake_case messages. A bad field becomes null and the rest is kept;
    a row without any usable field is skipped. ``keep`` names input columns to carry along."""
    value, m = F.col("value"), F.col("_m")
    read = _once(df.select(*keep, "value"), "_m", J.parse(value, S.EVENT.names))
    typed = _once(read, "_t", F.struct(
        J.integer(value, "customer_id", m["customer_id"]).alias("customer_id"),
        J.decimal(value, "amount", m["amount"]).alias("amount"),
        parse_mid_time(m["event_time"]).alias("event_time"),
    ))
    events = typed.filter(J.is_object(m)).select(
        *keep,
        *[m[f].alias(f) for f in ("event_id", "biz_type", "biz_key")],
        *[F.col("_t")[f].alias(f) for f in ("customer_id", "amount", "event_time")],
    )
    return events.filter(F.coalesce(*[F.col(c).cast("string") for c in S.EVENT.names]).isNotNull())


def with_proc_time(events: DataFrame) -> DataFrame:
    """The processing time; one value per micro-batch."""
    return events.withColumn("proc_time", F.current_timestamp())
