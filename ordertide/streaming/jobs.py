"""The long-running jobs: arguments, sources and the queries each job starts."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ordertide import schemas as S
from ordertide.session import build_session
from ordertide.sinks.tables import forget_followed, merge_tiers, write_batch
from ordertide.sinks.topic import write_topic
from ordertide.sources.batches import follow_batches
from ordertide.sources.decode import decode_mid
from ordertide.sources.dimension import PartialDimProvider, keyed_loader, read_dimension_files
from ordertide.sources.topic import TopicConfig, read_message_files, read_topic
from ordertide.streaming.aggregate import aggregate_stream, aggregate_writer, lookup_writer, set_aside_stream, single_deliveries
from ordertide.streaming.alarms import alarms_writer, closed_count_ratios
from ordertide.streaming.ingest import MERGE_EVERY, IngestTables, first_orders, ingest_stream, ingest_writer, orders_writer
from ordertide.streaming.runner import BatchWriter, run_query
from ordertide.streaming.steps import ProgressLog

#: Seconds between batches: a minute's sums then appear within its end, the lateness and one batch.
EVERY_SECONDS = 10
#: Batches that a following query takes per trigger, so that the first after an outage isn't the whole backlog.
MAX_BATCHES = 100


def arguments(job: str) -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog=job)
    parser.add_argument("--root", required=True, help="shared folder for tables and checkpoints")
    parser.add_argument("--bootstrap", help="topic servers; without them messages come from --files")
    parser.add_argument("--topic", help="topic to read")
    parser.add_argument("--files", help="folder of Parquet message files to follow")
    parser.add_argument("--publish", help="topic that ingest sends mid messages to, in place of the mid table")
    parser.add_argument("--dimension", help="folder of Parquet customers; aggregate then also keeps enriched events")
    parser.add_argument("--every", type=int, default=EVERY_SECONDS, help="seconds between batches; 0: take what is there and stop")
    return parser


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    if args.bootstrap:
        return read_topic(spark, TopicConfig(args.bootstrap, args.topic))
    return read_message_files(spark, args.files) if args.files else None


def _wait(queries: Sequence[StreamingQuery], once: bool) -> None:
    if not once:
        queries[0].sparkSession.streams.awaitAnyTermination()
        return
    for query in queries:
        query.awaitTermination()


def ingest(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    """Raw messages to ledger, orders, mid table or topic, set-aside messages and logs; a second query stores the orders,
    a third keeps the alarms on the share of failed messages."""
    args = arguments("ingest").parse_args(argv)
    spark = spark or build_session("ingest")
    messages = _messages(spark, args)
    if messages is None:
        raise SystemExit("ingest reads --bootstrap and --topic, or --files")
    publish = publisher(args)
    tables, every = IngestTables(args.root), args.every or None
    progress = ProgressLog()
    spark.streams.addListener(progress)
    try:
        writer = ingest_writer(tables, publish=publish, orders_here=False, progress=progress)
        queries = [run_query(
            ingest_stream(messages), writer, f"{args.root}/checkpoints/ingest", every_seconds=every,
            tables=[t for t in tables.all() if t != tables.orders],
        )]
        if not every:
            queries[0].awaitTermination()
        writes = follow_batches(spark, tables.order_writes, S.ORDER_WRITE, "orders", _most(args), with_number=True)
        queries.append(run_query(
            first_orders(writes), orders_writer(tables.orders), f"{args.root}/checkpoints/orders", mode="update", every_seconds=every,
            tables=[tables.orders],
        ))
        alarms, counts = f"{args.root}/alarms", follow_batches(spark, tables.log_minutes, S.LOG_MINUTE, "alarms", _most(args))
        queries.append(run_query(
            closed_count_ratios(counts), alarms_writer(alarms), f"{args.root}/checkpoints/alarms", every_seconds=every, tables=[alarms],
        ))
        _wait(queries, not every)
    finally:
        spark.streams.removeListener(progress)


def publisher(args: argparse.Namespace) -> BatchWriter | None:
    """K3: what sends a batch's mid messages to ``--publish``; none if they stay in the mid table."""
    if not args.publish:
        return None
    if not args.bootstrap:
        raise SystemExit("--publish needs --bootstrap")
    cfg = TopicConfig(args.bootstrap, args.publish)
    return lambda messages, batch_id: write_topic(messages, cfg)


def _most(args: argparse.Namespace) -> int | None:
    """Batches a trigger takes at most; a run that ends with what is there takes all."""
    return MAX_BATCHES if args.every else None


def aggregate(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    """Mid events to minutes and days, kept up to date batch by batch, and those the result can't hold to ``aside``.

    Follows the ingest job's mid table; with a topic, repeated deliveries are taken out first. With
    ``--dimension`` a query of its own looks the customers up and keeps the events in ``enriched``.
    """
    args = arguments("aggregate").parse_args(argv)
    spark, root, every = spark or build_session("aggregate"), args.root, args.every or None
    topic, queries = _messages(spark, args), []
    source = IngestTables(root).mid
    if topic is not None:
        source = f"{root}/mid-once"
        def once(df: DataFrame, n: int) -> None:
            forget_followed(spark, source)
            write_batch(df, source, n)

        queries.append(run_query(single_deliveries(topic), once, f"{root}/checkpoints/mid-once", every_seconds=every))
        if not args.every:
            queries[0].awaitTermination()
    mid = lambda who: follow_batches(spark, source, S.WIRE, who, _most(args))

    def aside(df: DataFrame, n: int) -> None:
        merge_tiers(spark, f"{root}/aside", n, S.SET_ASIDE, MERGE_EVERY)
        write_batch(df, f"{root}/aside", n)

    minutes = aggregate_writer(f"{root}/agg", daily=f"{root}/daily")
    queries.append(run_query(aggregate_stream(mid("agg")), minutes, f"{root}/checkpoints/agg", every_seconds=every))
    queries.append(run_query(set_aside_stream(mid("aside")), aside, f"{root}/checkpoints/aside", every_seconds=every))
    if args.dimension:
        dims = PartialDimProvider(keyed_loader(lambda: read_dimension_files(spark, args.dimension)))
        enriched = f"{root}/enriched"
        queries.append(run_query(
            decode_mid(mid("enriched")), lookup_writer(enriched, dims), f"{root}/checkpoints/enriched", every_seconds=every, tables=[enriched],
        ))
    _wait(queries, not args.every)
