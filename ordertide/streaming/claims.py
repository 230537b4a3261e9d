"""Claims of event ids as a stream of its own, without a watermark.

A watermark drops rows that lag behind the newest of all partitions, also ids never seen. Here an
id's claims are rows of a table with a folder per day of arrival, and a batch is judged by the days
around its own arrivals, so a partition that is weeks behind loses nothing and each claim is
forgotten by its own age.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.operators.dedup import LEDGER_HORIZON
from ordertide.sinks.tables import merge_tiers, read_batches, write_batch
from ordertide.streaming.ingest import MERGE_EVERY, unclaimed
from ordertide.streaming.runner import BatchWriter


def claims_writer(
    path: str,
    schema: T.StructType,
    horizon: str = LEDGER_HORIZON,
    after: Callable[[str, int], None] = lambda step, batch_id: None,
    merge_every: int = MERGE_EVERY,
) -> BatchWriter:
    """The ``foreachBatch`` function that keeps the rows claiming their ``event_id``, with all their columns.

    The rows kept are the claims later batches are judged by; ``schema`` is that of the stream, with
    arrival_ts, partition and offset. Only event ids and times are read back, and only of the days that a
    batch's arrivals can reach. The answer doesn't depend on how arrivals are cut into batches, if
    each id's messages come in the order of their arrival.
    """
    stored = T.StructType([*schema.fields, T.StructField("day", T.DateType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        merge_tiers(spark, path, batch_id, stored, merge_every, ("day",))
        rows = batch.persist()
        try:
            earlier = read_batches(spark, path, stored, before=batch_id).select("event_id", F.col("arrival_ts").alias("created_at"), "day")
            claims = unclaimed(rows, earlier, horizon)
            write_batch(claims.select(*schema.names, F.to_date("arrival_ts").alias("day")), path, batch_id, ("day",))
            after("claims", batch_id)
        finally:
            rows.unpersist()

    return write
