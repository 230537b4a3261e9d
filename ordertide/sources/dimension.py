"""The customer dimension and how stale a stream may see it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide import schemas as S
from ordertide.session import work_dir

# How long a looked-up customer may be reused, and how many rows
# may be held next to every task.
LOOKUP_TTL_SECONDS = 600
LOOKUP_MAX_ROWS = 100_000
# Bytes of text and keys of those rows, at most.
LOOKUP_MAX_BYTES = 64 << 20


def jdbc_options(
    url: str, table: str, driver: str, user: str, password: str, fetch_size: int = 1000
) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "driver": driver,
        "user": user,
        "password": password,
        "fetchsize": str(fetch_size),
    }


def read_jdbc_dimension(
    spark: SparkSession, options: dict[str, str], lower: int, upper: int, partitions: int
) -> DataFrame:
    """S3: keyed table over JDBC, read in parallel ranges of ``customer_id``."""
    split = {
        "partitionColumn": "customer_id",
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }
    rows = spark.read.format("jdbc").options(**options, **split).load()
    return rows.select("customer_id", "name", "level", "region", "updated_at")


class DimProvider:
    """Holds the dimension, loading it again once ``ttl_seconds`` have passed.

    Between loads it is read from the executors' copy; the source is asked again only for
    parts lost with an executor.

    Call :meth:`get` inside ``foreachBatch``: a static side bound when the query starts
    would keep its file list for good. At each load rows and bytes are counted; only a
    dimension within both bounds is marked for broadcast, a larger one is joined by shuffle.
    """

    def __init__(
        self,
        loader: Callable[[], DataFrame],
        ttl_seconds: int = LOOKUP_TTL_SECONDS,
        max_broadcast_rows: int = LOOKUP_MAX_ROWS,
        max_broadcast_bytes: int = LOOKUP_MAX_BYTES,
    ):
        self._loader = loader
        self._ttl = timedelta(seconds=ttl_seconds)
        self._max_rows, self._max_bytes = max_broadcast_rows, max_broadcast_bytes
        self._held: DataFrame | None = None
        self._loaded_at: datetime | None = None
        self._dim: DataFrame | None = None
        self.is_broadcast = False

    def get(self, now: datetime) -> DataFrame:
        if self._dim is None or now - self._loaded_at >= self._ttl:
            if self._held is not None:
                self._held.unpersist()
            self._held = fresh = self._loader().persist()
            size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in fresh.columns), F.lit(0))
            rows, bytes_ = fresh.agg(F.count(F.lit(1)), F.sum(size)).first()
            self.is_broadcast = rows <= self._max_rows and (bytes_ or 0) <= self._max_bytes
            self._dim = F.broadcast(fresh) if self.is_broadcast else fresh
            self._loaded_at = now
        return self._dim


def read_dimension_files(spark: SparkSession, path: str) -> DataFrame:
    """S3: the dimension as Parquet files, one row per ``customer_id``; files are listed anew at each call."""
    return spark.read.schema(S.CUSTOMER).parquet(path).select("customer_id", "name", "level", "region", "updated_at")


def keyed_loader(dim: Callable[[], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """A loader of single customers from any table: the rows whose ``customer_id`` is asked for."""
    return lambda keys: dim().join(keys, "customer_id", "left_semi")


class PartialDimProvider:
    """Holds only customers that events have named, each with an age of its own.

    :meth:`get`, called inside ``foreachBatch``, asks the loader for those of the batch's keys that
    aren't held or have reached ``ttl_seconds``. Keys the source lacks are held as misses, so they aren't asked for
    again before that age. Of what is held, the ``max_rows`` loaded last stay for later batches; the
    batch itself gets all its customers, however many. The loader returns one row per customer it finds.

    What is held is a checkpoint in the shared folder, so neither lost executors nor the number of
    batches make its lineage longer. Null keys are never asked for.
    """

    def __init__(
        self,
        loader: Callable[[DataFrame], DataFrame],
        ttl_seconds: int = LOOKUP_TTL_SECONDS,
        max_rows: int = LOOKUP_MAX_ROWS,
    ):
        self._loader = loader
        self._ttl = timedelta(seconds=ttl_seconds)
        self._max_rows = max_rows
        self._held: DataFrame | None = None

    def get(self, events: DataFrame, now: datetime) -> DataFrame:
        """The dimension's rows of the customers in ``events``."""
        wanted = _durable(events.select("customer_id").where("customer_id IS NOT NULL").distinct())
        fresh = None if self._held is None else self._held.where(F.col("_loaded_at") > F.lit(now - self._ttl))
        missing = wanted if fresh is None else _durable(wanted.join(fresh, "customer_id", "left_anti"))
        known = fresh
        if fresh is None or not missing.isEmpty():
            found = self._loader(missing).withColumn("_found", F.lit(True))
            loaded = missing.join(found, "customer_id", "left").withColumn("_loaded_at", F.lit(now))
            loaded = _durable(loaded.withColumn("_found", F.coalesce("_found", F.lit(False))))
            known = loaded if fresh is None else fresh.unionByName(loaded)
            self._held = _durable(known.orderBy(F.desc("_loaded_at"), "customer_id").limit(self._max_rows))
        rows = known.where("_found").join(wanted, "customer_id", "left_semi")
        return rows.drop("_found", "_loaded_at")


def _durable(df: DataFrame) -> DataFrame:
    """``df``, computed once into the shared checkpoint folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(work_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()
