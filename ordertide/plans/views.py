"""Input views over the given tables, each in Spark and as a SQL common table expression.

The views turn generic tables into order events, including the faults a real topic
carries. Which fault a message gets depends on a number its row already holds
(``k`` in ``props``), so faults grow with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide import schemas as S
from ordertide.functions.text import padded_id


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Customers who have just signed up are not in the dimension yet, so their lookups miss.
NEW_CUSTOMER_BASE = 1_000_000_000

SRC_EVENTS_SQL = f"""src_events AS (
  SELECT event_id AS event_no,
         printf('evt-%010d', event_id) AS event_id,
         event_type AS biz_type,
         printf('order-%010d', event_id) AS biz_key,
         CASE WHEN event_type = 'signup' THEN user_id + {NEW_CUSTOMER_BASE} ELSE user_id END AS customer_id,
         CAST(CASE WHEN event_type = 'error' THEN -value ELSE value END AS DECIMAL(18,4)) AS amount,
         ts AS event_time,
         CAST(user_id % 3 AS INTEGER) AS "partition",
         event_id AS "offset",
         ts + INTERVAL 1 SECOND AS arrival_ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""


def src_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the given table in the engine's own schema, with their topic position."""
    return src_events_of(table(spark, sf_dir, "events"))


def src_events_of(events: DataFrame) -> DataFrame:
    no, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    ts = F.col("ts").cast("timestamp")
    return events.select(
        no.alias("event_no"),
        padded_id("evt-", no).alias("event_id"),
        kind.alias("biz_type"),
        padded_id("order-", no).alias("biz_key"),
        F.when(kind == "signup", user + F.lit(NEW_CUSTOMER_BASE)).otherwise(user).alias("customer_id"),
        F.when(kind == "error", -F.col("value")).otherwise(F.col("value")).cast(S.AMOUNT).alias("amount"),
        ts.alias("event_time"),
        (user % 3).cast("int").alias("partition"),
        no.alias("offset"),
        (ts + F.expr("interval 1 second")).alias("arrival_ts"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


DIM_CUSTOMER_SQL = """dim_customer AS (
  SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS level, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer dimension; Spark broadcasts nation and region by their file size."""
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("level"),
        F.col("r_name").alias("region"),
    )


# Message faults by k. Left is the number, right the text or fragment used.
WHOLE_TEXT_FAULTS = {0: "'{bad'", 1: "'null'", 2: "'[]'", 3: "'3'", 4: "''", 37: "NULL"}
FRAGMENT_FAULTS = {
    "eventId": {
        5: "NULL",
        6: """'"eventId":""'""",
        7: """'"eventId":" "'""",
        8: """concat('"eventId":', event_no)""",
        35: """'"eventId":{"x":1}'""",
        40: """concat('"eventId":"', prev_id, '"')""",
    },
    "bizType": {9: """'"bizType":null'"""},
    "bizKey": {
        10: """concat('"bizKey":"o-', event_no, '"')""",
        11: """concat('"bizKey":"', event_no, '"')""",
        12: """concat('"bizKey":"a-b-', event_no, '"')""",
        13: """'"bizKey":"order-x"'""",
        14: """'"bizKey":null'""",
        15: """'"bizKey":"order-"'""",
        38: """'"bizKey":"order-99999999999999999999"'""",
        39: """concat('"bizKey":"', prev_key, '"')""",
    },
    "customerId": {
        16: """concat('"customerId":"', customer_id, '"')""",
        17: """concat('"customerId":', customer_id, '.7')""",
        18: """'"customerId":null'""",
        19: """'"customerId":"x"'""",
        20: """'"customerId":true'""",
        21: """concat('"customerId":"', customer_id, '.7"')""",
    },
    "amount": {
        22: """concat('"amount":', amount)""",
        23: """'"amount":""'""",
        24: """'"amount":"abc"'""",
        25: """'"amount":"1.23456"'""",
        26: """'"amount":null'""",
        27: "NULL",
        28: """'"amount":"NaN"'""",
        29: """'"amount":100000000000000'""",
    },
    "eventTime": {
        30: """'"eventTime":null'""",
        31: """concat('"eventTime":"', replace(wall, ' ', 'T'), '"')""",
        32: """concat('"eventTime":"', left(wall, 16), '"')""",
        33: """concat('"eventTime":"2024-13', substr(wall, 8), '"')""",
    },
    "traceId": {36: """'"traceId":null'"""},
    "extra": {34: """'"extra":{"eventId":[1]}'"""},
}
REGULAR_FRAGMENTS = {
    "eventId": """concat('"eventId":"', event_id, '"')""",
    "bizType": """concat('"bizType":"', biz_type, '"')""",
    "bizKey": """concat('"bizKey":"', biz_key, '"')""",
    "customerId": """concat('"customerId":', customer_id)""",
    "amount": """concat('"amount":"', amount, '"')""",
    "eventTime": """concat('"eventTime":"', wall, '"')""",
    "traceId": """concat('"traceId":"trace-', event_no, '"')""",
    "extra": "NULL",
}


def _case(faults: dict[int, str], regular: str) -> str:
    arms = " ".join(f"WHEN {k} THEN {text}" for k, text in faults.items())
    return f"CASE k {arms} ELSE {regular} END"


def raw_messages(events: DataFrame) -> DataFrame:
    """Raw topic messages of :func:`src_events` rows: value, partition, offset, arrival_ts."""
    previous = F.greatest(F.col("event_no") - 1, F.lit(0))
    wall = F.date_format(F.col("event_time") + F.expr("interval 8 hours"), "yyyy-MM-dd HH:mm:ss")
    rows = events.withColumns({
        "prev_id": padded_id("evt-", previous), "prev_key": padded_id("order-", previous), "wall": wall,
    })
    fragments = ", ".join(_case(FRAGMENT_FAULTS[f], REGULAR_FRAGMENTS[f]) for f in REGULAR_FRAGMENTS)
    text = f"concat('{{', concat_ws(',', {fragments}), '}}')"
    return rows.selectExpr(
        f"{_case(WHOLE_TEXT_FAULTS, text)} AS value", "partition", "offset", "arrival_ts"
    )


# Broken messages grown beyond what is shown of them.
LONG_TEXT = "concat(value, repeat('x', cast(300 + offset % 100 as int)))"


def long_messages(events: DataFrame) -> DataFrame:
    """Messages that start like the first fault and go on for hundreds of characters."""
    return raw_messages(events.filter(F.col("k") == 0)).withColumn("value", F.expr(LONG_TEXT))


# What a reader must make of those messages, stated on the source rows and not on the text.
EXPECTED_SQL = SRC_EVENTS_SQL + """,
expected AS (
  SELECT event_no, "partition", "offset", arrival_ts,
         CASE WHEN k IN (0, 1, 2, 3, 4, 19, 20, 21, 24, 28, 29, 31, 32, 33, 35, 37) THEN 'malformed'
              WHEN k IN (5, 6) THEN 'missing_event_id'
              WHEN k IN (13, 14, 15, 38) THEN 'bad_biz_key'
              WHEN k IN (9, 18) THEN 'null_required' END AS reject_reason,
         CASE k WHEN 7 THEN ' ' WHEN 8 THEN CAST(event_no AS VARCHAR)
                WHEN 40 THEN printf('evt-%010d', greatest(event_no - 1, 0)) ELSE event_id END AS event_id,
         biz_type,
         CASE k WHEN 10 THEN 'o-' || event_no WHEN 11 THEN CAST(event_no AS VARCHAR)
                WHEN 12 THEN 'a-b-' || event_no
                WHEN 39 THEN printf('order-%010d', greatest(event_no - 1, 0)) ELSE biz_key END AS biz_key,
         CASE k WHEN 39 THEN greatest(event_no - 1, 0) ELSE event_no END AS order_id,
         customer_id,
         CASE WHEN k IN (23, 26, 27) THEN NULL WHEN k = 25 THEN CAST(1.2346 AS DECIMAL(18,4))
              ELSE amount END AS amount,
         CASE WHEN k = 30 THEN arrival_ts ELSE date_trunc('second', event_time) END AS event_time
  FROM src_events),
good AS (SELECT * FROM expected WHERE reject_reason IS NULL)"""


# Batches of a staged stream: equal spans of time, in order.
CHUNKS = 3


def chunks_of(spark: SparkSession, sf_dir: str, view=src_events_of, chunks: int = CHUNKS) -> list[DataFrame]:
    """The staged batches of ``view`` over ``events``, oldest first. Every event is in exactly one; the bounds
    are set on the stored column, so they reach the scan."""
    rows = table(spark, sf_dir, "events")
    ends = rows.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    cuts = [ends["lo"] + (ends["hi"] - ends["lo"]) * n / chunks for n in range(1, chunks)]
    bounds = [None, *(F.expr(f"TIMESTAMP_NTZ '{cut}'") for cut in cuts), None]
    out = []
    for lo, hi in zip(bounds, bounds[1:]):
        part = rows if lo is None else rows.filter(F.col("ts") >= lo)
        out.append(view(part if hi is None else part.filter(F.col("ts") < hi)))
    return out


MID_FAULTS_SQL = SRC_EVENTS_SQL + """,
mid_expected AS (
  SELECT event_id,
         CASE WHEN k = 4 THEN NULL ELSE biz_type END AS biz_type,
         biz_key,
         CASE WHEN k = 2 THEN NULL ELSE customer_id END AS customer_id,
         CASE WHEN k IN (1, 5) THEN NULL ELSE amount END AS amount,
         CASE WHEN k = 6 THEN NULL ELSE date_trunc('millisecond', event_time) END AS event_time
  FROM src_events WHERE k NOT IN (0, 7, 8))"""

# Mid message faults by k.
MID_TEXT_FAULTS = {0: "'{bad'", 7: "'{}'", 8: "'[1]'"}
MID_FIELD_FAULTS = {
    "biz_type": {4: "NULL"},
    "customer_id": {2: """'"customer_id":"x"'""", 9: """concat('"customer_id":"', customer_id, '"')"""},
    "amount": {1: """'"amount":"abc"'""", 5: "NULL", 10: """concat('"amount":', amount)"""},
    "event_time": {
        3: """concat('"event_time":"', replace(replace(iso, 'T', ' '), 'Z', ''), '"')""",
        6: """'"event_time":"yesterday"'""",
    },
}
MID_REGULAR = {
    "event_id": """concat('"event_id":"', event_id, '"')""",
    "biz_type": """concat('"biz_type":"', biz_type, '"')""",
    "biz_key": """concat('"biz_key":"', biz_key, '"')""",
    "customer_id": """concat('"customer_id":', customer_id)""",
    "amount": """concat('"amount":"', amount, '"')""",
    "event_time": """concat('"event_time":"', iso, '"')""",
}


def mid_messages_with_faults(events: DataFrame) -> DataFrame:
    rows = events.withColumn("iso", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    fields = [
        _case(MID_FIELD_FAULTS[f], text) if f in MID_FIELD_FAULTS else text for f, text in MID_REGULAR.items()
    ]
    text = f"concat('{{', concat_ws(',', {', '.join(fields)}), '}}')"
    return rows.selectExpr(f"{_case(MID_TEXT_FAULTS, text)} AS value")


# Each click is delivered twice, the second time an hour later with another amount.
DUP_EVENTS_SQL = SRC_EVENTS_SQL + """,
dup_events AS (
  SELECT event_id, biz_type, customer_id, amount, 0 AS copy_no, "partition", "offset", arrival_ts FROM src_events
  UNION ALL
  SELECT event_id, biz_type, customer_id, CAST(-amount AS DECIMAL(18,4)), 1, "partition", "offset" + 1000000000000,
         arrival_ts + INTERVAL 1 HOUR
  FROM src_events WHERE biz_type = 'click')"""


def dup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dup_events_of(table(spark, sf_dir, "events"))


def dup_events_of(events: DataFrame) -> DataFrame:
    once = src_events_of(events).select(
        "event_id", "biz_type", "customer_id", "amount", F.lit(0).alias("copy_no"), "partition", "offset", "arrival_ts"
    )
    again = once.filter(F.col("biz_type") == "click").withColumns({
        "amount": (-F.col("amount")).cast(S.AMOUNT),
        "copy_no": F.lit(1),
        "offset": F.col("offset") + F.lit(1_000_000_000_000),
        "arrival_ts": F.col("arrival_ts") + F.expr("interval 1 hour"),
    })
    return once.unionAll(again)


# Besides, each purchase is sent again eight days on, when its first claim no longer counts.
SENT_AGAIN_SQL = DUP_EVENTS_SQL + """,
sent_again AS (
  SELECT event_id, biz_type, "partition", "offset", arrival_ts FROM dup_events
  UNION ALL
  SELECT event_id, biz_type, "partition", "offset" + 2000000000000, arrival_ts + INTERVAL 8 DAY FROM src_events WHERE biz_type = 'purchase')"""


def sent_again_of(events: DataFrame) -> DataFrame:
    once = dup_events_of(events).select("event_id", "biz_type", "partition", "offset", "arrival_ts")
    again = once.filter(F.col("biz_type") == "purchase").withColumns({
        "offset": F.col("offset") + F.lit(2_000_000_000_000), "arrival_ts": F.col("arrival_ts") + F.expr("interval 8 days"),
    })
    return once.unionAll(again)


# A topic on which all events of a customer are one order's messages, and some are sent a thousand places late.
MID_POSITIONS_SQL = SRC_EVENTS_SQL + """,
mid_positions AS (
  SELECT printf('order-%010d', customer_id) AS key, "partition",
         2 * "offset" + CASE WHEN k % 7 = 3 THEN 2001 ELSE 0 END AS "offset", date_trunc('millisecond', event_time) AS event_time FROM src_events)"""


def mid_positions(events: DataFrame) -> DataFrame:
    """key, partition, offset and value of that topic's messages."""
    late = F.when(F.col("k") % 7 == 3, F.lit(2001)).otherwise(F.lit(0))
    own = events.withColumns({"biz_key": padded_id("order-", F.col("customer_id")), "offset": 2 * F.col("offset") + late})
    body = F.struct("event_id", "biz_type", "biz_key", "customer_id", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_time"))
    return own.select(F.col("biz_key").alias("key"), "partition", "offset", F.to_json(body).alias("value"))


INGEST_LOG_SQL = """ingest_log AS (
  SELECT ts AS arrival_ts, printf('evt-%010d', event_id) AS event_id,
         CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'duplicate'
                         WHEN 'view' THEN 'parse_error' ELSE 'persisted' END AS outcome,
         value AS proc_ms
  FROM events)"""


def ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_log_of(table(spark, sf_dir, "events"))


def ingest_log_of(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    outcome = (
        F.when(kind == "error", "failed").when(kind == "signup", "duplicate")
        .when(kind == "view", "parse_error").otherwise("persisted")
    )
    return events.select(
        F.col("ts").cast("timestamp").alias("arrival_ts"),
        padded_id("evt-", F.col("event_id")).alias("event_id"),
        outcome.alias("outcome"),
        F.col("value").alias("proc_ms"),
    )


# Order headers and their returned lines as competing writes of one order row.
ORDER_WRITES_SQL = """order_writes AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, 'ORDER' AS biz_type,
         CAST(o_totalprice AS DECIMAL(18,4)) AS amount, o_orderdate AS written_at, 0 AS line_no
  FROM orders
  UNION ALL
  SELECT l_orderkey, o_custkey, 'REFUND', CAST(-l_extendedprice AS DECIMAL(18,4)), l_shipdate, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')"""


def order_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    headers = orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.lit("ORDER").alias("biz_type"), F.col("o_totalprice").cast(S.AMOUNT).alias("amount"),
        F.col("o_orderdate").alias("written_at"), F.lit(0).alias("line_no"),
    )
    returned = lines.filter(F.col("l_returnflag") == "R").join(
        orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        F.col("l_orderkey"), F.col("o_custkey"), F.lit("REFUND"),
        (-F.col("l_extendedprice")).cast(S.AMOUNT), F.col("l_shipdate"), F.col("l_linenumber"),
    )
    return headers.unionAll(returned)
