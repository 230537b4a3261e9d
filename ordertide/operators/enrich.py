"""Customer lookup that never loses an event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOOKUP_COLUMNS = ("level", "region")


def enrich(
    events: DataFrame, dim: DataFrame, cols: Sequence[str] = LOOKUP_COLUMNS, salt: int = 0
) -> DataFrame:
    """LEFT lookup on ``customer_id``; misses keep the event with null columns.

    Without ``cols`` there is nothing to look up and no join. A dimension under the
    broadcast threshold is broadcast by Spark; a larger one is shuffled, with AQE
    splitting skewed partitions. Where AQE is off, ``salt`` spreads the events of each
    customer over that many keys and repeats the dimension row once per key.
    """
    if not cols:
        return events
    looked_up = dim.select("customer_id", *[F.col(c).alias(f"customer_{c}") for c in cols])
    if salt <= 1:
        return events.join(looked_up, "customer_id", "left")
    spread = events.withColumn("_salt", F.pmod(F.xxhash64(*events.columns), F.lit(salt)).cast("int"))
    copies = looked_up.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return spread.join(copies, ["customer_id", "_salt"], "left").drop("_salt")


def orphans(events: DataFrame, dim: DataFrame) -> DataFrame:
    """Customers that events name but the dimension lacks, with their event counts.

    Events are counted per customer before the join, so a busy customer is one row in it.
    """
    per_customer = events.groupBy("customer_id").agg(F.count(F.lit(1)).alias("event_cnt"))
    return per_customer.join(dim.select("customer_id"), "customer_id", "left_anti")


def miss_count(events: DataFrame, dim: DataFrame) -> DataFrame:
    """Events a lookup leaves without dimension columns, and all events."""
    per_customer = events.groupBy("customer_id").agg(F.count(F.lit(1)).alias("event_cnt"))
    known = dim.select("customer_id", F.lit(1).alias("_known"))
    joined = per_customer.join(known, "customer_id", "left")
    missed = F.when(F.col("_known").isNull(), F.col("event_cnt")).otherwise(0)
    return joined.agg(
        F.coalesce(F.sum("event_cnt"), F.lit(0)).alias("event_cnt"),
        F.coalesce(F.sum(missed), F.lit(0)).alias("miss_cnt"),
    )
