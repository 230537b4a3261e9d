"""Declared schemas, keys and column defaults: the one place they are written down."""

from __future__ import annotations

from pyspark.sql import types as T

AMOUNT = T.DecimalType(18, 4)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


# A message as read from a topic or from files of messages.
MESSAGE = _struct(
    ("value", T.StringType()),
    ("partition", T.IntegerType()),
    ("offset", T.LongType()),
    ("arrival_ts", T.TimestampType()),
)

# Raw JSON field name -> column name, in wire order.
RAW_FIELDS = {
    "eventId": "event_id",
    "bizType": "biz_type",
    "bizKey": "biz_key",
    "customerId": "customer_id",
    "amount": "amount",
    "eventTime": "event_time",
    "traceId": "trace_id",
}

# Normalised event; on the wire these are the JSON field names, in this order.
EVENT = _struct(
    ("event_id", T.StringType()),
    ("biz_type", T.StringType()),
    ("biz_key", T.StringType()),
    ("customer_id", T.LongType()),
    ("amount", AMOUNT),
    ("event_time", T.TimestampType()),
)

# A mid event with what the dimension says of its customer.
ENRICHED = T.StructType([
    *EVENT.fields, T.StructField("customer_level", T.StringType()), T.StructField("customer_region", T.StringType()),
])

# Mid events that the result key cannot hold, with the names of what they lack.
SET_ASIDE = T.StructType([*EVENT.fields, T.StructField("missing", T.StringType())])

CUSTOMER = _struct(
    ("customer_id", T.LongType()),
    ("name", T.StringType()),
    ("level", T.StringType()),
    ("region", T.StringType()),
    ("created_at", T.TimestampNTZType()),
    ("updated_at", T.TimestampNTZType()),
)

ORDER = _struct(
    ("order_id", T.LongType()),
    ("customer_id", T.LongType()),
    ("biz_type", T.StringType()),
    ("amount", AMOUNT),
    ("status", T.StringType()),
    ("created_at", T.TimestampNTZType()),
    ("updated_at", T.TimestampNTZType()),
)

# An order row on its way to the orders query, with what tells which came first.
ORDER_WRITE = T.StructType([
    *ORDER.fields, T.StructField("arrival_ts", T.TimestampType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
])

LEDGER = _struct(
    ("event_id", T.StringType()),
    ("created_at", T.TimestampType()),
)

# The ledger as stored: a folder per UTC day of arrival within each batch.
LEDGER_BY_DAY = _struct(
    ("event_id", T.StringType()),
    ("created_at", T.TimestampType()),
    ("day", T.DateType()),
)

AGG_1MIN = _struct(
    ("window_start", T.TimestampNTZType()),
    ("biz_type", T.StringType()),
    ("customer_id", T.LongType()),
    ("order_cnt", T.LongType()),
    ("amount_sum", AMOUNT),
    ("update_time", T.TimestampType()),
)

# The one-minute table as stored: a folder per Shanghai day within each batch.
AGG_BY_DAY = T.StructType([*AGG_1MIN.fields, T.StructField("stat_date", T.DateType())])

AGG_DAILY = _struct(
    ("stat_date", T.DateType()),
    ("biz_type", T.StringType()),
    ("order_cnt", T.LongType()),
    ("amount_sum", AMOUNT),
    ("update_time", T.TimestampType()),
)

REJECT = _struct(
    ("partition", T.IntegerType()),
    ("offset", T.LongType()),
    ("arrival_ts", T.TimestampType()),
    ("reject_reason", T.StringType()),
    ("value", T.StringType()),
    ("value_head", T.StringType()),
    ("value_length", T.IntegerType()),
)

INGEST_LOG = _struct(
    ("arrival_ts", T.TimestampType()),
    ("event_id", T.StringType()),
    ("outcome", T.StringType()),
    ("wait_ms", T.DoubleType()),
    ("proc_ms", T.DoubleType()),
)

# What a batch logged per minute of arrival, for the alarms query to follow.
LOG_MINUTE = _struct(
    ("arrival_ts", T.TimestampType()),
    ("received", T.LongType()),
    ("failed", T.LongType()),
)

# One step of the work on a batch, or one phase of it as Spark reports it.
STEP_LOG = _struct(
    ("query", T.StringType()),
    ("step", T.StringType()),
    ("began_at", T.TimestampType()),
    ("row_cnt", T.LongType()),
    ("ms", T.DoubleType()),
)

WIRE = _struct(
    ("key", T.StringType()),
    ("value", T.StringType()),
)

AGG_KEY = ("window_start", "biz_type", "customer_id")
DAILY_KEY = ("stat_date", "biz_type")

# Column defaults of the keyed tables.
CUSTOMER_DEFAULTS = {"name": "", "level": "NORMAL", "region": "CN-UNKNOWN"}
ORDER_DEFAULTS = {"amount": 0, "status": "NEW"}

# Enumerations used on the wire and in the dimension.
BIZ_TYPES = ("ORDER", "REFUND")
CUSTOMER_LEVELS = ("NORMAL", "VIP", "SVIP")
