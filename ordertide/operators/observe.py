"""M1-M6: ingest health, computed from a log of (arrival_ts, event_id, outcome, proc_ms)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MINUTE = "1 minute"
# Values this close together (one part in 256 per doubling) share a bucket while
# the quantile is narrowed down; the result itself stays exact.
BUCKETS_PER_DOUBLING = 256


def _minute(col: str = "arrival_ts") -> Column:
    return F.date_trunc("minute", F.col(col))


def throughput(log: DataFrame) -> DataFrame:
    """M1 M2: messages per minute by outcome, and received per second."""
    def outcome(name: str) -> Column:
        return F.count_if(F.col("outcome") == name)

    return (
        log.groupBy(_minute().alias("minute"))
        .agg(
            F.count(F.lit(1)).alias("received"),
            outcome("persisted").alias("persisted"),
            outcome("duplicate").alias("duplicate"),
            outcome("parse_error").alias("parse_error"),
        )
        .withColumn("received_per_sec", F.col("received") / F.lit(60.0))
    )


def latency_quantile(log: DataFrame, q: float = 0.95) -> DataFrame:
    """M3: exact interpolated quantile of ``proc_ms`` per minute."""
    return quantile_by(log, _minute(), "minute", "proc_ms", q)


def step_quantile(steps: DataFrame, q: float = 0.95) -> DataFrame:
    """M3: exact interpolated quantile of the time of each step of the work."""
    return quantile_by(steps, F.col("step"), "step", "ms", q)


def quantile_by(rows: DataFrame, group: Column, name: str, value: str, q: float) -> DataFrame:
    """Exact interpolated quantile of ``value`` per ``group``, which becomes the column ``name``.

    No task ever holds a whole group: equal values are counted first, the counts are
    summed into value buckets, and only the buckets holding the two wanted ranks are
    opened. A group with a third of all rows is spread by value like any other.
    """
    values = (
        rows.filter(F.col(value).isNotNull())
        .groupBy(group.alias(name), F.col(value).alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", _bucket(F.col("v")))
    )
    by_bucket = Window.partitionBy(name).orderBy("bucket")
    buckets = (
        values.groupBy(name, "bucket").agg(F.sum("n").alias("n"))
        .withColumn("upto", F.sum("n").over(by_bucket.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("total", F.sum("n").over(Window.partitionBy(name)))
        .withColumn("rank", (F.col("total") - 1) * F.lit(q))
        .withColumn("before", F.col("upto") - F.col("n"))
    )
    lo, hi = F.floor("rank"), F.ceil("rank")
    wanted = buckets.filter(
        ((F.col("before") <= lo) & (lo < F.col("upto"))) | ((F.col("before") <= hi) & (hi < F.col("upto")))
    ).select(name, "bucket", "before", "rank", "total")
    by_value = Window.partitionBy(name, "bucket").orderBy("v")
    opened = (
        values.join(wanted, [name, "bucket"])
        .withColumn(
            "upto",
            F.col("before") + F.sum("n").over(by_value.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .withColumn("from", F.col("upto") - F.col("n"))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("from") <= rank) & (rank < F.col("upto")), F.col("v")))

    ends = opened.groupBy(name).agg(
        F.max("total").alias("samples"), F.max("rank").alias("rank"), at(lo).alias("v_lo"), at(hi).alias("v_hi")
    )
    share = F.col("rank") - F.floor("rank")
    return ends.select(
        name, "samples", (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * share).alias("quantile")
    )


def _bucket(v: Column) -> Column:
    """Order-keeping bucket number: log scale away from zero, mirrored below it.

    Values are never null here. Saying so keeps the two uses of the counted values one
    plan, so Spark computes and shuffles them once.
    """
    size = F.floor(F.log2(F.abs(v) + F.lit(1.0)) * F.lit(BUCKETS_PER_DOUBLING)).cast("int")
    return F.coalesce(F.when(v < 0, -size).otherwise(size), F.lit(0))


def failure_ratio(
    log: DataFrame, width: str = "5 minutes", slide: str = MINUTE, threshold: float = 0.01
) -> DataFrame:
    """M4: share of failed messages over a sliding window, and whether it breaks the threshold.

    Messages are counted per slide step first; the sliding windows then copy those few
    counts instead of every message.
    """
    steps = log.groupBy(F.window("arrival_ts", slide)["start"].alias("step")).agg(
        F.count(F.lit(1)).alias("received"), F.count_if(F.col("outcome") == "failed").alias("failed")
    )
    return slide_ratio(steps, width, slide, threshold)


def minute_counts(log: DataFrame) -> DataFrame:
    """Messages per minute of arrival and how many of them failed: what the sliding ratio needs of a log."""
    return log.groupBy(_minute().alias("arrival_ts")).agg(
        F.count(F.lit(1)).alias("received"), F.count_if(F.col("outcome") == "failed").alias("failed")
    )


def slide_ratio(steps: DataFrame, width: str, slide: str, threshold: float) -> DataFrame:
    """Sliding sums over per-step counts. No messages at all gives a null ratio and no breach."""
    sums = steps.groupBy(F.window("step", width, slide)).agg(
        F.sum("received").alias("received"), F.sum("failed").alias("failed")
    ).select(F.col("window.start").alias("window_start"), "received", "failed")
    ratio = F.try_divide(F.col("failed").cast("double"), F.col("received").cast("double"))
    return sums.withColumn("ratio", ratio).withColumn(
        "breach", F.coalesce(F.col("ratio") > F.lit(threshold), F.lit(False)).cast("int")
    )


def sustained(
    series: DataFrame, cond: Column, buckets: int, keys: Sequence[str] = (), at: str = "window_start", step_seconds: int = 60
) -> DataFrame:
    """M5: unbroken runs of at least ``buckets`` steps for which ``cond`` holds.

    ``step_seconds`` is the series' own step, a whole part of a day. Runs are formed per day in parallel. Only runs touching midnight can go on, so only
    those are merged across days.
    """
    if 86400 % step_seconds:
        raise ValueError("the step must divide a day")
    reach_seconds = step_seconds + 1
    day = F.window(at, "1 day")
    hits = series.filter(cond).select(
        *keys, F.col(at).alias("_at"), day["start"].alias("_day"), day["end"].alias("_next_day")
    )
    # A step's run reaches one second into the next step, so neighbours join and gaps part.
    runs = hits.groupBy("_day", "_next_day", *keys, F.session_window("_at", f"{reach_seconds} seconds").alias("_s")).agg(
        F.min("_at").alias("run_start"), F.max("_at").alias("run_end"), F.count(F.lit(1)).alias("buckets")
    )
    last_step = F.col("_next_day") - F.expr(f"interval {step_seconds} seconds")
    touches = (F.col("run_start") == F.col("_day")) | (F.col("run_end") == last_step)
    shape = [*keys, "run_start", "run_end", "buckets"]
    inner = runs.filter(~touches).select(*shape)
    reach = F.concat(
        (F.col("run_end").cast("long") - F.col("run_start").cast("long") + F.lit(reach_seconds)).cast("string"),
        F.lit(" seconds"),
    )
    merged = (
        runs.filter(touches)
        .withColumn("_from", F.col("run_start"))
        .groupBy(*keys, F.session_window("_from", reach).alias("_s"))
        .agg(
            F.min("run_start").alias("run_start"),
            F.max("run_end").alias("run_end"),
            F.sum("buckets").alias("buckets"),
        )
        .select(*shape)
    )
    return inner.unionAll(merged).filter(F.col("buckets") >= buckets)


def balance(log: DataFrame) -> DataFrame:
    """M6: received messages against the sum of their outcomes; ``difference`` must be 0."""
    def outcome(name: str) -> Column:
        return F.count_if(F.col("outcome") == name).alias(name)

    sums = log.agg(
        F.count(F.lit(1)).alias("received"),
        *[outcome(name) for name in ("parse_error", "duplicate", "persisted", "failed")],
    )
    parts = F.col("parse_error") + F.col("duplicate") + F.col("persisted") + F.col("failed")
    return sums.withColumn("difference", F.col("received") - parts)
