"""Query 1: raw messages -> ledger, order facts, mid messages, set-aside rows, ingest log."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide import schemas as S
from ordertide.functions.clock import as_instant
from ordertide.operators.dedup import (
    ARRIVAL_ORDER, CLAIM_ORDER, LEDGER_HORIZON, anti_existing_narrow, first_per_key, near_claims, span_of, unblocked,
)
from ordertide.operators.facts import to_order_row
from ordertide.operators.observe import minute_counts
from ordertide.operators.upsert import rejects
from ordertide.operators.wire import to_wire
from ordertide.sinks.tables import (
    BATCH, batch_note, drop_days, forget_followed, merge_tiers, read_batches, write_batch,
)
from ordertide.sources.decode import accepted, decode_raw
from ordertide.streaming.runner import BatchWriter
from ordertide.streaming.steps import ProgressLog, StepClock


# Neighbouring folders of one size that are put together.
MERGE_EVERY = 16


@dataclass(frozen=True)
class IngestTables:
    """Where the ingest query keeps its tables, below one shared folder."""

    root: str

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def orders(self) -> str:
        return f"{self.root}/orders"

    @property
    def order_writes(self) -> str:
        return f"{self.root}/order-writes"

    @property
    def steps(self) -> str:
        return f"{self.root}/steps"

    @property
    def mid(self) -> str:
        return f"{self.root}/mid"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def log(self) -> str:
        return f"{self.root}/log"

    @property
    def log_minutes(self) -> str:
        return f"{self.root}/log-minutes"

    def all(self) -> tuple[str, ...]:
        return self.ledger, self.orders, self.order_writes, self.mid, self.rejects, self.log, self.log_minutes, self.steps

    def merged(self, orders_here: bool = True) -> dict[str, tuple[T.StructType, tuple[str, ...]]]:
        """Tables of the ingest query that no stream follows, whose small batches may be put together: schema and partitioning."""
        own = {
            self.ledger: (S.LEDGER_BY_DAY, ("day",)), self.rejects: (S.REJECT, ()), self.log: (S.INGEST_LOG, ()),
            self.steps: (S.STEP_LOG, ()),
        }
        return own | {self.orders: (S.ORDER, ())} if orders_here else own

    def followed(self) -> tuple[str, ...]:
        """Tables that other queries follow and that are forgotten behind them."""
        return self.mid, self.order_writes, self.log_minutes


def ingest_stream(messages: DataFrame) -> DataFrame:
    """The streaming part of query 1, planned once and run for every batch. An event
    without a time gets its arrival time, which a replay finds again."""
    return decode_raw(messages, F.col("arrival_ts"))


def unclaimed(good: DataFrame, ledger: DataFrame, horizon: str = LEDGER_HORIZON) -> DataFrame:
    """K2 W4 for one micro-batch: the rows that claim their event, earliest arrival first.

    A row is blocked by a claim of its id within the horizon of its own arrival, whether that
    claim is in the ledger (which leaves out the batch itself) or in the batch. Of the rows
    left, the first of each id claims it; rows of that id beyond the horizon of that claim have
    another turn. A batch spanning less than the horizon takes one turn. ``good`` should be
    persisted. The answer doesn't depend on how arrivals are cut into batches.
    """
    span = good.agg(F.min("arrival_ts").alias("lo"), F.max("arrival_ts").alias("hi")).first()
    if span["lo"] is None:
        return good
    first, last = (t.astimezone(timezone.utc) for t in span)
    rows = unblocked(good, near_claims(ledger, first, last, horizon), horizon)
    claims = first_per_key(rows, "event_id", CLAIM_ORDER)
    # Each turn moves every id's claim on by more than the horizon.
    turn, reach = claims, F.expr(f"interval {horizon}")
    while first + span_of(horizon) < last:
        until = turn.select(F.col("event_id").alias("_id"), (F.col("arrival_ts") + reach).alias("_until"))
        rows = rows.join(until, (F.col("event_id") == F.col("_id")) & (F.col("arrival_ts") > F.col("_until"))).drop("_id", "_until")
        turn = first_per_key(rows, "event_id", CLAIM_ORDER)
        begins = turn.agg(F.min("arrival_ts")).first()[0]
        if begins is None:
            break
        claims, first = claims.unionByName(turn), begins.astimezone(timezone.utc)
    return claims


def outcomes(decoded: DataFrame, claims: DataFrame, now: datetime, done: datetime) -> DataFrame:
    """M6: what became of each message of a batch that began at ``now`` and was ``done`` later.

    ``wait_ms`` is from a message's arrival to the start of its batch, ``proc_ms`` the work on the
    batch that held it. Rows are matched on their position, which is unique, so copies of one
    id do not meet.
    """
    won = claims.select(*ARRIVAL_ORDER, F.lit(True).alias("_won"))
    outcome = (
        F.when(F.col("reject_reason").isin("malformed", "missing_event_id"), "parse_error")
        .when(F.col("reject_reason").isNotNull(), "failed")
        .when(F.col("_won"), "persisted")
        .otherwise("duplicate")
    )
    waited = (F.unix_micros(as_instant(now)) - F.unix_micros("arrival_ts")) / F.lit(1000.0)
    worked = F.lit((done - now).total_seconds() * 1000.0)
    slim = decoded.select(*ARRIVAL_ORDER, "arrival_ts", "event_id", "reject_reason")
    return slim.join(won, list(ARRIVAL_ORDER), "left").select(
        "arrival_ts", "event_id", outcome.alias("outcome"), waited.alias("wait_ms"), worked.alias("proc_ms")
    )


def expire_ledger(spark: SparkSession, path: str, now: datetime, horizon: str = LEDGER_HORIZON) -> list[str]:
    """K8: delete the ledger's day folders that lie wholly before the horizon, counted from the newest claim at the
    latest, so a backlog still finds those that block it."""
    newest = read_batches(spark, path, S.LEDGER_BY_DAY).agg(F.max("day")).first()[0]
    if newest is None:
        return []
    return drop_days(spark, path, min(now.date(), newest) - span_of(horizon))


def ingest_writer(
    tables: IngestTables,
    publish: BatchWriter | None = None,
    horizon: str = LEDGER_HORIZON,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    after: Callable[[str, int], None] = lambda step, batch_id: None,
    merge_every: int = MERGE_EVERY,
    orders_here: bool = True,
    progress: ProgressLog | None = None,
) -> BatchWriter:
    """The ``foreachBatch`` function of query 1, for batches of :func:`ingest_stream`.

    Every write is a function of the batch's input and of earlier batches, so a batch that
    broke off anywhere is simply run again: committed folders stay, missing ones are
    added, and no event is lost or repeated. ``publish`` replaces the mid table, for example by
    a topic. ``after`` is called when a step is done. Small batches of the tables no stream follows
    are merged by size, expired claims go by the day, and batches that all followers have
    read are forgotten.

    ``orders_here`` looks new order numbers up in all stored orders. Without it the batch's first write of
    each order is handed on to the orders query, which keeps the numbers it has seen as state
    (:func:`orders_writer`), so a batch takes as long whatever has been stored.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, now = batch.sparkSession, clock()
        publish_mid = publish or (lambda df, n: write_batch(df, tables.mid, n))
        steps = StepClock("ingest")
        decoded = batch.persist()
        with steps.step("merge"):
            for path, (schema, partition_by) in tables.merged(orders_here).items():
                merge_tiers(spark, path, batch_id, schema, merge_every, partition_by)
            if batch_id and batch_id % merge_every == 0:
                expire_ledger(spark, tables.ledger, now, horizon)
                for path in tables.followed():
                    forget_followed(spark, path)
        with steps.step("claim"):
            earlier_claims = read_batches(spark, tables.ledger, S.LEDGER_BY_DAY, before=batch_id)
            claims = unclaimed(accepted(decoded), earlier_claims, horizon).persist()
        orders = first_per_key(to_order_row(claims, now, keep=CLAIM_ORDER), "order_id", CLAIM_ORDER).persist()
        try:
            ledger_rows = claims.select(
                "event_id", F.col("arrival_ts").alias("created_at"), F.to_date("arrival_ts").alias("day")
            )
            with steps.step("ledger", ledger_rows) as rows:
                write_batch(rows, tables.ledger, batch_id, partition_by=("day",))
            after("ledger", batch_id)
            if orders_here:
                stored = read_batches(spark, tables.orders, S.ORDER, before=batch_id)
                new_orders, place = anti_existing_narrow(orders, stored, "order_id").select(*S.ORDER.names), tables.orders
            else:
                new_orders, place = orders.select(*S.ORDER_WRITE.names), tables.order_writes
            with steps.step("orders", new_orders) as rows:
                write_batch(rows, place, batch_id)
            after("orders", batch_id)
            with steps.step("mid"):
                publish_mid(to_wire(claims, F.col("arrival_ts")), batch_id)
            after("mid", batch_id)
            with steps.step("rejects", rejects(decoded)) as rows:
                write_batch(rows, tables.rejects, batch_id)
            with steps.step("log", outcomes(decoded, claims, now, clock())) as rows:
                write_batch(rows, tables.log, batch_id)
            with steps.step("log_minutes"):
                logged = read_batches(spark, tables.log, S.INGEST_LOG).filter(F.col(BATCH) == batch_id)
                write_batch(minute_counts(logged), tables.log_minutes, batch_id)
            write_batch(steps.rows(spark, progress), tables.steps, batch_id)
            after("log", batch_id)
        finally:
            for held in (orders, claims, decoded):
                held.unpersist()

    return write


def first_orders(writes: DataFrame) -> DataFrame:
    """For every order written to in a trigger, its first write of all time and the last batch that wrote to it.

    ``writes`` follows the handed-on order rows with their batch's number. The first write is the
    one of the earliest batch, then arrival; it is kept as keyed state and never changes, since later
    writes have larger batch numbers.
    """
    rest = [c for c in S.ORDER.names if c != "order_id"]
    first = F.min(F.struct("batch_id", *CLAIM_ORDER, *rest))
    return writes.groupBy("order_id").agg(first.alias("first"), F.max("batch_id").alias("last_batch"))


def orders_writer(
    path: str, after: Callable[[str, int], None] = lambda step, batch_id: None, merge_every: int = MERGE_EVERY
) -> BatchWriter:
    """The ``foreachBatch`` function of the orders query (update mode): appends each order once.

    An order is new if its first write came after the batches that earlier triggers have read; how
    far those went is in their entries. No stored order is read.
    """

    def write(batch: DataFrame, trigger: int) -> None:
        spark = batch.sparkSession
        merge_tiers(spark, path, trigger, S.ORDER, merge_every)
        since = int(batch_note(spark, path, trigger - 1) or -1) if trigger else -1
        touched = batch.persist()
        try:
            upto = touched.agg(F.max("last_batch")).first()[0]
            new = touched.filter(F.col("first.batch_id") > since)
            rest = [F.col(f"first.{c}").alias(c) for c in S.ORDER.names if c != "order_id"]
            write_batch(new.select("order_id", *rest), path, trigger, note=str(since if upto is None else upto))
            after("orders", trigger)
        finally:
            touched.unpersist()

    return write
