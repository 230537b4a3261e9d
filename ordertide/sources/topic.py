"""Messages from topics or from files of messages.

Operators never see a topic, only a DataFrame with a ``value`` column, so either
reader can feed the same query.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide import schemas as S


# Admission per batch, so that the first batch after an outage is not the whole backlog.
MAX_OFFSETS = 5_000_000
MAX_FILES = 1000


@dataclass(frozen=True)
class TopicConfig:
    bootstrap: str
    topic: str
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int | None = MAX_OFFSETS
    extra: dict[str, str] = field(default_factory=dict)

    def read_options(self) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.bootstrap,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "kafka.isolation.level": "read_committed",
        }
        if self.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        return {**options, **self.extra}

    def write_options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.bootstrap,
            "topic": self.topic,
            "kafka.acks": "all",
            "kafka.enable.idempotence": "true",
            **self.extra,
        }


def read_topic(spark: SparkSession, cfg: TopicConfig) -> DataFrame:
    """Topic -> key, value, partition, offset, arrival_ts.

    Offsets live in the query's checkpoint; a consumer group's own offsets are not used.
    Needs the Kafka connector on the session's class path.
    """
    rows = spark.readStream.format("kafka").options(**cfg.read_options()).load()
    return rows.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "partition",
        "offset",
        F.col("timestamp").alias("arrival_ts"),
    )


def read_message_files(
    spark: SparkSession, path: str, schema: T.StructType = S.MESSAGE, max_files: int | None = MAX_FILES
) -> DataFrame:
    """Stream of messages from a growing folder of parquet files."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)
