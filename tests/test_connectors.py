"""What is sent to connectors that cannot run here, and session rules."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ordertide import session
from ordertide.functions.clock import shanghai_to_utc, utc_to_shanghai
from ordertide.functions.text import padded_id
from ordertide.sinks.database import clear_statement, upsert_statement
from ordertide.sources.dimension import jdbc_options
from ordertide.sources.topic import TopicConfig


def test_topic_options():
    cfg = TopicConfig("host:1", "raw", max_offsets_per_trigger=500)
    read = cfg.read_options()
    assert read["subscribe"] == "raw" and read["startingOffsets"] == "earliest"
    assert read["kafka.isolation.level"] == "read_committed" and read["maxOffsetsPerTrigger"] == "500"
    write = cfg.write_options()
    assert write["kafka.acks"] == "all" and write["kafka.enable.idempotence"] == "true"


def test_upsert_statement_updates_all_but_the_key():
    sql = upsert_statement("t", "t_stage", ["k", "n", "s"], ["k"])
    assert sql == (
        "INSERT INTO t (k, n, s) SELECT k, n, s FROM t_stage WHERE batch_id = ? "
        "ON DUPLICATE KEY UPDATE n = VALUES(n), s = VALUES(s)"
    )
    assert clear_statement("t_stage") == "DELETE FROM t_stage WHERE batch_id = ?"


def test_jdbc_options():
    assert jdbc_options("u", "t_customer", "d", "me", "pw")["dbtable"] == "t_customer"


def test_work_dir_lies_below_the_shared_folder(spark):
    first, second = session.work_dir(spark, "x"), session.work_dir(spark, "x")
    assert first.startswith(spark.conf.get("spark.checkpoint.dir")) and first != second


def test_wall_time_round_trip_across_an_old_clock_change(spark):
    df = spark.createDataFrame([(datetime(1988, 7, 1, 12),), (datetime(2026, 1, 1),)], "w timestamp_ntz")
    got = df.select(
        shanghai_to_utc(F.col("w")).cast("string").alias("u"), (utc_to_shanghai(shanghai_to_utc(F.col("w"))) == F.col("w")).alias("same")
    ).collect()
    assert [r.u for r in got] == ["1988-07-01 03:00:00", "2025-12-31 16:00:00"]
    assert all(r.same for r in got)


@pytest.mark.parametrize("number, text", [(7, "evt-0000000007"), (12345678901234, "evt-12345678901234")])
def test_padded_id_never_cuts_digits(spark, number, text):
    assert spark.range(1).select(padded_id("evt-", F.lit(number))).first()[0] == text
