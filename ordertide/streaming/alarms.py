"""M5 while running: alarms that are pending, firing and resolved, kept batch by batch.

Steps and sliding ratios of the log are windows of the stream. A window comes out once, when the watermark
has passed its end, so windows come in order of time and only the runs that reach the newest closed window
can go on; those are all that a batch needs of the batches before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.operators.observe import MINUTE, slide_ratio, sustained
from ordertide.operators.upsert import latest_wins
from ordertide.sinks.tables import BATCH, merge_tiers, read_batches, write_batch
from ordertide.streaming.ingest import MERGE_EVERY
from ordertide.streaming.runner import BatchWriter

# States of an alarm. A quiet one ended before it was long enough.
PENDING, FIRING, RESOLVED, QUIET = "pending", "firing", "resolved", "quiet"


def closed_ratios(
    log: DataFrame, width: str = "5 minutes", slide: str = MINUTE, threshold: float = 0.01, delay: str = MINUTE
) -> DataFrame:
    """M4 as a stream: each sliding window of ``failure_ratio``, once, when no message of it is expected any more."""
    steps = log.withWatermark("arrival_ts", delay).groupBy(F.window("arrival_ts", slide)).agg(
        F.count(F.lit(1)).alias("received"), F.count_if(F.col("outcome") == "failed").alias("failed")
    )
    return slide_ratio(steps.select(F.window_time("window").alias("step"), "received", "failed"), width, slide, threshold)


def closed_count_ratios(
    counts: DataFrame, width: str = "5 minutes", slide: str = MINUTE, threshold: float = 0.01, delay: str = MINUTE
) -> DataFrame:
    """The same from the counts per minute that each ingest batch leaves (``observe.minute_counts``): a minute
    may come in several rows. ``slide`` is one minute or a multiple of it."""
    steps = counts.withWatermark("arrival_ts", delay).groupBy(F.window("arrival_ts", slide)).agg(
        F.sum("received").alias("received"), F.sum("failed").alias("failed")
    )
    return slide_ratio(steps.select(F.window_time("window").alias("step"), "received", "failed"), width, slide, threshold)


def alarm_schema(key_fields: Sequence[T.StructField] = ()) -> T.StructType:
    times = [T.StructField(c, T.TimestampType()) for c in ("run_start", "run_end")]
    return T.StructType([*key_fields, *times, T.StructField("buckets", T.LongType()), T.StructField("state", T.StringType())])


def read_alarms(
    spark: SparkSession, path: str, key_fields: Sequence[T.StructField] = (), before: int | None = None
) -> DataFrame:
    """The last state of every run."""
    schema = alarm_schema(key_fields)
    keys = [f.name for f in key_fields]
    rows = read_batches(spark, path, schema, before).select(*schema.names, BATCH)
    return latest_wins(rows, (*keys, "run_start")).select(*schema.names)


def moved_on(
    open_runs: DataFrame, closed: DataFrame, cond: Column, buckets: int, horizon: datetime | None,
    keys: Sequence[str] = (), step_seconds: int = 60,
) -> DataFrame:
    """Runs whose state or length a batch of ``closed`` windows changes.

    A run is open while it reaches ``horizon``, the newest closed window of all series: a later closed window
    without a breach, or without messages, ends it.
    """
    step = F.expr(f"interval {step_seconds} seconds")
    runs = sustained(closed, cond, 1, keys, step_seconds=step_seconds).withColumn("_next", F.col("run_start"))
    before = open_runs.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("run_start").alias("_start"), F.col("run_end").alias("_end"),
        (F.col("run_end") + step).alias("_after"), F.col("buckets").alias("_buckets"), F.col("state").alias("_state"),
    )
    same = F.col("_next") == F.col("_after")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = runs.join(before, same, "full")
    known = F.col("_start").isNotNull()
    end, length = F.coalesce("run_end", "_end"), F.coalesce("buckets", F.lit(0)) + F.coalesce("_buckets", F.lit(0))
    is_open = F.lit(True) if horizon is None else end >= F.lit(horizon)
    state = F.when(length >= buckets, F.when(is_open, FIRING).otherwise(RESOLVED)).otherwise(F.when(is_open, PENDING).otherwise(QUIET))
    changed = F.when(known, (state != F.col("_state")) | (length != F.col("_buckets"))).otherwise(state != QUIET)
    return joined.where(changed).select(
        *[F.when(known, F.col(f"_{k}")).otherwise(F.col(k)).alias(k) for k in keys],
        F.coalesce("_start", "run_start").alias("run_start"), end.alias("run_end"), length.alias("buckets"), state.alias("state"),
    )


def alarms_writer(
    path: str,
    buckets: int = 5,
    key_fields: Sequence[T.StructField] = (),
    step_seconds: int = 60,
    after: Callable[[str, int], None] = lambda step, batch_id: None,
    merge_every: int = MERGE_EVERY,
) -> BatchWriter:
    """The ``foreachBatch`` function over closed windows with ``breach`` and the series' keys.

    Each batch adds the runs it changes; a merge keeps the last state of each. Runs that end before ``buckets`` steps and were never open between
    two batches are not written.
    """
    schema, keys = alarm_schema(key_fields), [f.name for f in key_fields]
    last = lambda rows: latest_wins(rows.select(*schema.names, BATCH), (*keys, "run_start"))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        merge_tiers(spark, path, batch_id, schema, merge_every, combine=last)
        rows = batch.persist()
        try:
            horizon = rows.agg(F.max("window_start")).first()[0]
            still = read_alarms(spark, path, key_fields, before=batch_id).where(F.col("state").isin(PENDING, FIRING))
            write_batch(moved_on(still, rows, F.col("breach") == 1, buckets, horizon, keys, step_seconds), path, batch_id)
            after("alarms", batch_id)
        finally:
            rows.unpersist()

    return write
