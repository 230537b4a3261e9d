"""Acceptance checks as table operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordertide import schemas as S

# Topic positions that one task looks through per key at most.
STRETCH = 1 << 20


def growth(before: DataFrame, after: DataFrame) -> DataFrame:
    """V1 V2: rows added per table between two :func:`table_counts` results."""
    old = before.select("table_name", F.col("row_cnt").alias("before_cnt"))
    new = after.select("table_name", F.col("row_cnt").alias("after_cnt"))
    both = old.join(new, "table_name", "full_outer").na.fill(0, ["before_cnt", "after_cnt"])
    return both.withColumn("grown_by", F.col("after_cnt") - F.col("before_cnt"))


def reconcile(expected: DataFrame, actual: DataFrame, key: Sequence[str] = S.AGG_KEY) -> DataFrame:
    """V4: keys whose count or sum differs between two aggregates; no rows means they agree.

    Both sides hold one row per key, so the join cannot be skewed by busy keys.
    """
    zero = F.lit(0).cast(S.AMOUNT)
    left = expected.select(*key, F.col("order_cnt").alias("_ec"), F.col("amount_sum").alias("_ea"))
    right = actual.select(*key, F.col("order_cnt").alias("_ac"), F.col("amount_sum").alias("_aa"))
    both = left.join(right, list(key), "full_outer").select(
        *key,
        F.coalesce("_ec", F.lit(0).cast("long")).alias("expected_cnt"),
        F.coalesce("_ac", F.lit(0).cast("long")).alias("actual_cnt"),
        F.coalesce("_ea", zero).alias("expected_sum"),
        F.coalesce("_aa", zero).alias("actual_sum"),
    )
    return both.filter(
        (F.col("expected_cnt") != F.col("actual_cnt")) | (F.col("expected_sum") != F.col("actual_sum"))
    )


def minute_digests(agg: DataFrame, key: Sequence[str] = S.AGG_KEY) -> DataFrame:
    """A row per minute that says, whatever the order, which rows it has: their count, their sum and the xor of their hashes."""
    row = F.xxhash64(*key, "order_cnt", F.col("amount_sum").cast(S.AMOUNT))
    return agg.groupBy("window_start").agg(
        F.count(F.lit(1)).alias("keys"), F.sum(F.col("amount_sum").cast("decimal(28,4)")).alias("total"), F.bit_xor(row).alias("digest")
    )


def differing_minutes(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """V4: minutes whose digests differ, or that one side lacks."""
    sides = [minute_digests(df).select("window_start", F.struct("keys", "total", "digest").alias(name)) for df, name in ((expected, "_e"), (actual, "_a"))]
    return sides[0].join(sides[1], "window_start", "full_outer").filter(~F.col("_e").eqNullSafe(F.col("_a"))).select("window_start")


def reconcile_by_digest(expected: DataFrame, actual: DataFrame, key: Sequence[str] = S.AGG_KEY) -> DataFrame:
    """V4: :func:`reconcile` of the minutes whose digests differ, so agreeing sides move a row per minute
    and not a row per key. Digests of one side can be kept and compared with a running job's at any time."""
    apart = differing_minutes(expected, actual)
    here = [df.join(apart, "window_start", "left_semi") for df in (expected, actual)]
    return reconcile(*here, key)


def order_violations(messages: DataFrame, at: str = "event_time", key: str = "key", stretch: int = STRETCH) -> DataFrame:
    """Messages of a key whose time is before that of the key's message ahead of it in the partition.

    Neighbours are found over all files. A key's positions are looked through in stretches of
    ``stretch`` offsets, in parallel, and a stretch is joined to the end of the one before it that
    has the key, so a busy key isn't one task's work. Messages without a time are passed over.
    """
    part = F.floor(F.col("offset") / F.lit(stretch))
    rows = messages.filter(F.col(at).isNotNull()).select(key, "partition", "offset", F.col(at).alias("_at"), part.alias("_part"))
    own = Window.partitionBy(key, "partition", "_part").orderBy("offset")
    before = F.lag(F.struct("offset", "_at")).over(own)
    ends = rows.groupBy(key, "partition", "_part").agg(F.max(F.struct("offset", "_at")).alias("_end"))
    reached = ends.withColumn("_reached", F.lag("_end").over(Window.partitionBy(key, "partition").orderBy("_part"))).drop("_end")
    marked = rows.withColumn("_before", before)
    inside = marked.filter(F.col("_before").isNotNull())
    first = marked.filter(F.col("_before").isNull()).drop("_before").join(
        reached.filter(F.col("_reached").isNotNull()).withColumnRenamed("_reached", "_before"), [key, "partition", "_part"]
    )
    found = inside.unionByName(first.select(*inside.columns)).filter(F.col("_at") < F.col("_before._at"))
    return found.select(
        key, "partition", "offset", F.col("_before.offset").alias("after_offset"), F.col("_at").alias(at), F.col("_before._at").alias(f"after_{at}")
    )
