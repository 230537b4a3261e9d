"""What several operators share: reading tables, cutting lineage, small column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.session import work_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder; lost executors don't cost it again."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(work_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as compressed Parquet to the shared folder and read it back."""
    path = work_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of one Arrow batch handed to Python.
BATCH_BYTES = 4 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, with batches for Python bounded by bytes, so that long texts don't add up in a worker.

    Sets the session's bound if it is larger.
    """
    name, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    if not 0 < int(conf.get(name).rstrip("b")) <= BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else. Where bytes and characters are as many, the plain function does just that."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))
