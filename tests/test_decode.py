"""Edge rows of raw and mid messages."""

from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ordertide.operators.upsert import rejects
from ordertide.operators.wire import to_wire
from ordertide.sources.decode import decode_mid, decode_raw, with_proc_time

NOW = datetime(2026, 5, 9, 3, 0, 0, tzinfo=timezone.utc)
BASE = {
    "eventId": '"e-1"', "bizType": '"ORDER"', "bizKey": '"order-0000000007"', "customerId": "42",
    "amount": '"128.3200"', "eventTime": '"2026-05-09 10:00:00"', "traceId": '"t"',
}


def message(**changes):
    fields = {**BASE, **changes}
    return "{" + ",".join(f'"{k}":{v}' for k, v in fields.items() if v is not None) + "}"


def decode(spark, *values):
    df = spark.createDataFrame([(v, 0, i) for i, v in enumerate(values)], "value string, partition int, offset long")
    df = df.withColumn("arrival_ts", F.lit(NOW).cast("timestamp"))
    return decode_raw(df, NOW).orderBy("offset")


def case(label, value, reason=None, **fields):
    return pytest.param(value, reason, fields, id=label)


def amount(text):
    return None if text is None else Decimal(text)


CASES = [
    case("regular", message(), event_id="e-1", biz_type="ORDER", biz_key="order-0000000007", customer_id=42,
         amount=amount("128.3200"), trace_id="t", time="2026-05-09 02:00:00"),
    *[case(f"not-an-event-{v}", v, "malformed")
      for v in ("{bad", "null", "[]", "3", "", "  ", None, '"text"', "[1,2]", "{'eventId':'a'}", '{"eventId":"a"')],
    case("no-id", message(eventId=None), "missing_event_id"),
    case("empty-id", message(eventId='""'), "missing_event_id"),
    case("null-id", message(eventId="null"), "missing_event_id"),
    case("blank-id", message(eventId='" "'), event_id=" "),
    case("numeric-id", message(eventId="12"), event_id="12"),
    case("unknown-fields", message(extra='{"eventId":[1],"x":{"y":2}}'), event_id="e-1"),
    case("repeated-field", '{"eventId":"a",' + message(eventId='"b"')[1:], event_id="b"),
    case("nested-text-field", message(traceId='{"x":1}'), "malformed"),
    case("list-as-id", message(eventId="[1]"), "malformed"),
    case("bracketed-text", message(traceId='"{not an object}"'), trace_id="{not an object}"),
    *[case(f"customer-{raw}", message(customerId=raw), customer_id=n)
      for raw, n in (("42", 42), ('"42"', 42), ("42.7", 42), ("-42.7", -42), ('" 42 "', 42), ("1e3", 1000))],
    *[case(f"customer-{raw}", message(customerId=raw), "malformed")
      for raw in ('"x"', '"42.7"', "true", "[1]", '{"a":1}', "9223372036854775808")],
    *[case(f"customer-{raw}", message(customerId=raw), "null_required") for raw in ("null", '""', None)],
    *[case(f"amount-{raw}", message(amount=raw), amount=amount(n))
      for raw, n in (
          ("99.50", "99.5000"), ('"99.50"', "99.5000"), ('"1.23456"', "1.2346"), ('"1.23445"', "1.2345"),
          ("1.23456", "1.2346"), ('"-1.23445"', "-1.2345"), ('"1e2"', "100.0000"), ("1e2", "100.0000"),
          ("12345678901234.5678", "12345678901234.5678"), ('"12345678901234.5678"', "12345678901234.5678"),
          ("0.12344999999999999999", "0.1234"), ('""', None), ("null", None), (None, None),
      )],
    *[case(f"amount-{raw}", message(amount=raw), "malformed")
      for raw in ('"abc"', '"NaN"', "NaN", "true", "100000000000000", '"1e30"', "{}", "[]")],
    *[case(f"key-{raw}", message(bizKey=raw), biz_key=raw.strip('"')) for raw in ('"o-1"', '"77"', '"a-b-9"')],
    *[case(f"key-{raw}", message(bizKey=raw), "bad_biz_key")
      for raw in ('"order-x"', '"order-"', '"order- 5"', '"order-99999999999999999999"', "null", None)],
    case("nested-key", message(bizKey='{"a":1}'), "malformed"),
    case("no-type", message(bizType="null"), "null_required"),
    case("null-time", message(eventTime="null"), time="2026-05-09 03:00:00"),
    case("empty-time", message(eventTime='""'), time="2026-05-09 03:00:00"),
    *[case(f"time-{raw}", message(eventTime=raw), "malformed")
      for raw in (
          '"2026-05-09T10:00:00"', '"2026-05-09 10:00"', '"2026-13-09 10:00:00"', '"2026-05-09 10:00:00.5"',
          '"2026-05-09 25:00:00"', "20260509", '"2026-05-09 10:00:00Z"',
      )],
]


@pytest.fixture(scope="module")
def decoded(spark):
    """All cases in one job, by message text."""
    rows = decode(spark, *[c.values[0] for c in CASES])
    timed = rows.withColumn("time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))
    return {r.value: r for r in timed.collect()}


@pytest.mark.parametrize("value, reason, fields", CASES)
def test_raw_message(decoded, value, reason, fields):
    row = decoded[value]
    assert row.reject_reason == reason
    assert {name: row[name] for name in fields} == fields


def test_filter_parses_each_message_once(spark):
    plan = decode(spark, message()).filter("reject_reason is null")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_rejects_keep_reason_whole_text_and_length(spark):
    long_text = "{" + "x" * 400
    row = rejects(decode(spark, long_text, message())).collect()
    assert len(row) == 1
    assert (row[0].reject_reason, row[0].value_head, row[0].value_length) == ("malformed", long_text[:256], 401)
    assert row[0].value == long_text


def test_wire_form(spark):
    out = to_wire(decode(spark, message(), message(amount=None)), NOW).collect()
    assert out[0].key == "order-0000000007"
    assert out[0].value == (
        '{"event_id":"e-1","biz_type":"ORDER","biz_key":"order-0000000007","customer_id":42,'
        '"amount":"128.3200","event_time":"2026-05-09T02:00:00.000Z"}'
    )
    assert "amount" not in out[1].value


def test_mid_round_trip(spark):
    row = decode_mid(to_wire(decode(spark, message()), NOW)).select(
        "event_id", "customer_id", "amount", F.date_format("event_time", "HH:mm:ss").alias("t")).first()
    assert tuple(row) == ("e-1", 42, Decimal("128.3200"), "02:00:00")


def test_mid_messages(spark):
    """A bad field is null and its row kept; rows without any usable field are skipped; times in ISO or SQL form."""
    values = [
        '{"event_id":"a","amount":"abc","customer_id":"x","event_time":"soon","biz_type":"ORDER"}',
        "{bad", "null", "[]", "3", "", None, "{}", '{"other":1}',
        '{"event_id":"t1","event_time":"2026-05-09T02:00:00.000Z"}',
        '{"event_id":"t2","event_time":"2026-05-09 02:00:00.000"}',
        '{"event_id":"t3","event_time":"2026-05-09 02:00:00"}',
        '{"event_id":"n","customer_id":"42","amount":12345678901234.5678}',
    ]
    df = decode_mid(spark.createDataFrame([(v,) for v in values], "value string"))
    rows = df.withColumn("t", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")).collect()
    got = {r.event_id: (r.biz_type, r.customer_id, r.amount, r.t) for r in rows}
    time = "2026-05-09 02:00:00"
    assert got == {
        "a": ("ORDER", None, None, None),
        "t1": (None, None, None, time), "t2": (None, None, None, time), "t3": (None, None, None, time),
        "n": (None, 42, Decimal("12345678901234.5678"), None),
    }


def test_processing_time_is_one_value(spark):
    df = with_proc_time(spark.range(0, 100, 1, 4))
    assert df.select("proc_time").distinct().count() == 1
