"""K4, K5, K9: versions of keyed rows, write stamps, set-aside messages."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.functions.clock import as_instant
from ordertide.functions.text import head


def stamped(df: DataFrame, now: datetime | Column) -> DataFrame:
    """K5: set ``update_time`` on every write."""
    return df.withColumn("update_time", as_instant(now))


def latest_wins(
    versions: DataFrame, key: Sequence[str], order: str = "batch_id", keep_first: Sequence[str] = ()
) -> DataFrame:
    """K4: the newest version of each key. Columns in ``keep_first`` come from the oldest
    version instead (a creation time survives updates).

    Each column is picked by ``max_by``, which combines before the shuffle and runs as a
    hash aggregate for numbers and times.
    """
    rest = [c for c in versions.columns if c not in (*key, order)]
    picked = [
        (F.min_by if c in keep_first else F.max_by)(c, order).alias(c)
        for c in rest
    ]
    return versions.groupBy(*key).agg(*picked).select(*[c for c in versions.columns if c != order])


def rejects(decoded: DataFrame) -> DataFrame:
    """K9: set-aside messages with their reason and whole text, which is the only copy kept; its
    start and length are for reading."""
    return decoded.filter(F.col("reject_reason").isNotNull()).select(
        "partition",
        "offset",
        "arrival_ts",
        "reject_reason",
        "value",
        head(F.col("value")).alias("value_head"),
        F.length("value").alias("value_length"),
    )
