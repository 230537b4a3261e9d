"""Start a query with its checkpoint, trigger and sink."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ordertide.sinks.tables import committed_batches, path_exists

# Fixed value: time between checkpoints of the aggregate query.
TRIGGER_SECONDS = 60

BatchWriter = Callable[[DataFrame, int], None]


def check_fresh_start(df: DataFrame, checkpoint: str, tables: Iterable[str]) -> None:
    """Refuse a new checkpoint over tables that already hold batches.

    Batch numbers start again at 0 with a new checkpoint. The writer refuses such a table in any
    case; this says so before the query starts.
    """
    spark = df.sparkSession
    if path_exists(spark, f"{checkpoint}/offsets"):
        return
    for path in tables:
        if committed_batches(spark, path):
            raise ValueError(f"{path} holds batches of another checkpoint than {checkpoint}")


def run_query(
    df: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    mode: str = "append",
    every_seconds: int | None = TRIGGER_SECONDS,
    tables: Iterable[str] = (),
) -> StreamingQuery:
    """Run ``write`` on every micro-batch. ``every_seconds=None`` takes what is there and stops."""
    check_fresh_start(df, checkpoint, tables)
    trigger = {"availableNow": True} if every_seconds is None else {"processingTime": f"{every_seconds} seconds"}
    return (
        df.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def catch_up(df: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append", tables: Iterable[str] = ()) -> None:
    """Process everything available, then return; a failure in ``write`` is raised here."""
    run_query(df, write, checkpoint, mode, None, tables).awaitTermination()
