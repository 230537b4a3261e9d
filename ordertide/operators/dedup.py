"""One winner per key, claims against what is already stored, expiry."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordertide.functions.clock import as_instant

ARRIVAL_ORDER = ("partition", "offset")
# The order in which copies of one event claim it, however batches are cut.
CLAIM_ORDER = ("arrival_ts", *ARRIVAL_ORDER)
LEDGER_HORIZON = "7 days"
# Above this many bytes of new keys the stored side is shuffled instead of the new keys broadcast.
BROADCAST_BYTES = 16 << 20
# What a broadcast key takes besides its own bytes.
KEY_OVERHEAD = 48


def first_per_key(df: DataFrame, key: str | Sequence[str], order_cols: Sequence[str | Column]) -> DataFrame:
    """The first row of each key.

    Spark cuts every map task to its own first row per key before the shuffle
    (partial WindowGroupLimit), so a key with very many copies sends one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols))
    return df.withColumn("_rank", ranked).filter(F.col("_rank") == 1).drop("_rank")


def anti_existing(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet."""
    return new.join(existing.select(key), key, "left_anti")


def anti_existing_narrow(
    new: DataFrame, existing: DataFrame, key: str, max_broadcast: int = BROADCAST_BYTES
) -> DataFrame:
    """:func:`anti_existing` for a small batch against a long history.

    ``new`` has one row per key and should be persisted: its key range and size are
    measured first. The range goes to the scan of ``existing`` as a pushed-down filter, so
    files holding only other keys are skipped. Up to ``max_broadcast`` bytes of keys the history
    is scanned in place, without a shuffle; beyond that both sides are shuffled. The rows are
    the same either way.
    """
    size = F.sum(F.octet_length(F.col(key).cast("string")) + F.lit(KEY_OVERHEAD))
    span = new.agg(size.alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    if span["n"] is None:
        return new
    nearby = existing.select(key).filter(F.col(key).between(F.lit(span["lo"]), F.lit(span["hi"])))
    if span["n"] > max_broadcast:
        return anti_existing(new, nearby, key)
    seen = nearby.join(F.broadcast(new.select(key)), key, "left_semi")
    return new.join(F.broadcast(seen.distinct()), key, "left_anti")


def claim(
    new: DataFrame,
    ledger: DataFrame,
    key: str = "event_id",
    order_cols: Sequence[str] = ARRIVAL_ORDER,
) -> DataFrame:
    """K2: rows of ``new`` that own their event id: first of its copies, and not in the ledger.

    The batch is taken to span less time than the ledger's horizon, so two copies inside
    one batch are always the same event.
    """
    return anti_existing(first_per_key(new, key, order_cols), ledger, key)


def span_of(horizon: str) -> timedelta:
    """A length of time written as a number and a unit, on the driver."""
    number, unit = horizon.split()
    return timedelta(**{unit.rstrip("s") + "s": float(number)})


def near_claims(ledger: DataFrame, first: datetime, last: datetime, horizon: str = LEDGER_HORIZON) -> DataFrame:
    """Ledger rows within the horizon of arrivals from ``first`` to ``last``. A ledger kept by ``day`` is
    read only for the days this touches."""
    reach = F.expr(f"interval {horizon}")
    since, until = as_instant(first) - reach, as_instant(last) + reach
    near = ledger.filter(F.col("created_at").between(since, until))
    if "day" in ledger.columns:
        near = near.filter(F.col("day").between(F.to_date(since), F.to_date(until)))
    return near


def unblocked(rows: DataFrame, claims: DataFrame, horizon: str = LEDGER_HORIZON, key: str = "event_id", at: str = "arrival_ts") -> DataFrame:
    """Rows for whose key no claim (key, created_at) lies within the horizon of their own arrival."""
    reach = F.expr(f"interval {horizon}")
    own = claims.select(F.col(key).alias("_key"), "created_at")
    near = F.col("created_at").between(F.col(at) - reach, F.col(at) + reach)
    return rows.join(own, (F.col(key) == F.col("_key")) & near, "left_anti")


def expire(ledger: DataFrame, now: datetime | Column, ttl: str = LEDGER_HORIZON) -> DataFrame:
    """K8: rows that stay. Strictly older rows go."""
    return ledger.filter(F.col("created_at") >= as_instant(now) - F.expr(f"interval {ttl}"))


def dedup_stream(
    events: DataFrame, horizon: str = LEDGER_HORIZON, salt: int = 0, arrival: str = "arrival_ts"
) -> DataFrame:
    """Stateful dedup of a stream on arrival time, for queries that keep no ledger table.

    Which of several copies with different content survives is not fixed; use the
    ledger where that matters. With ``salt`` > 1 copies are first thinned out in
    that many slices per id, so an id holding a large share of the stream does not
    meet in one task; the price is a second state store. Slices go by the message's position,
    which parts copies of equal content too, or by its arrival where there is none.
    """
    marked = events.withWatermark(arrival, horizon)
    if salt > 1:
        position = [c for c in ARRIVAL_ORDER if c in events.columns] or [arrival]
        slice_no = F.pmod(F.xxhash64(*position), F.lit(salt))
        marked = (
            marked.withColumn("_slice", slice_no)
            .dropDuplicatesWithinWatermark(["event_id", "_slice"])
            .drop("_slice")
        )
    return marked.dropDuplicatesWithinWatermark(["event_id"])
