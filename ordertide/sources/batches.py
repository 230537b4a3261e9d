"""Follow a table of batches by number.

A stream's offset is the number of the last committed batch it has read, taken from the table's
entries. A batch is offered once it has its entry and its files have moved, so what a broken-off
writer leaves is never read, and a batch is read whole or not at all. Each trigger lists entries
and the folders of its own batches, whatever the table's age; batches that all followers are
done with can be forgotten (``sinks.tables.forget_followed``).

Files are read as Arrow batches by the tasks that Spark gives them to, one file each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT, BATCH = "ordertide_batches", "batch_id"
DRAFT = "_writing-"


class BatchFile(InputPartition):
    def __init__(self, batch_id: int, name: str):
        self.batch_id, self.name = batch_id, name


class Follower(DataSourceStreamReader):
    """Driver: which batches there are. Tasks: the rows of one file."""

    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.uri, self.schema = options["path"], schema
        self.name = options.get("follower")
        self.most = int(options["maxbatches"]) if options.get("maxbatches") else None
        self.reached: int | None = None

    def _open(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.uri)

    def _names(self, folder: str) -> list[str]:
        store, base = self._open()
        found = store.get_file_info(fs.FileSelector(f"{base}/{folder}".rstrip("/"), allow_not_found=True))
        return [info.base_name for info in found]

    def _number(self, name: str) -> int | None:
        store, base = self._open()
        if store.get_file_info(f"{base}/{name}").type == fs.FileType.NotFound:
            return None
        with store.open_input_stream(f"{base}/{name}") as stream:
            return int(stream.readall().decode() or 0)

    def _write(self, name: str, number: int) -> None:
        store, base = self._open()
        store.create_dir(f"{base}/_followers", recursive=True)
        with store.open_output_stream(f"{base}/{name}") as stream:
            stream.write(str(number).encode())

    def committed(self) -> set[int]:
        return {int(name) for name in self._names("_commits") if name.isdigit()}

    def initialOffset(self) -> dict:
        self.reached = (self._number("_kept_from") or 0) - 1
        return {BATCH: self.reached}

    def latestOffset(self) -> dict:
        """The last batch that can be read with all before it, at most ``maxbatches`` ahead."""
        committed = self.committed()
        moving = {int(name[len(DRAFT):]) for name in self._names("") if name.startswith(DRAFT)} & committed
        latest = min(moving) - 1 if moving else max(committed, default=-1)
        if self.most:
            # Spark may ask this before it says where the query stands. What was planned last is that place: a
            # trigger that broke off is planned again before anything new is asked for.
            if self.reached is None:
                planned = self._number(f"_followers/.planned-{self.name}")
                self.reached = (self._number("_kept_from") or 0) - 1 if planned is None else planned
            latest = max(self.reached, min(latest, self.reached + self.most))
        return {BATCH: latest}

    def partitions(self, start: dict, end: dict) -> list[BatchFile]:
        self.reached = end[BATCH]
        if self.most:
            self._write(f"_followers/.planned-{self.name}", end[BATCH])
        kept_from = self._number("_kept_from") or 0
        if start[BATCH] + 1 < kept_from and end[BATCH] > start[BATCH]:
            raise ValueError(f"batches {start[BATCH] + 1} to {kept_from - 1} of {self.uri} are no longer kept")
        out = []
        for batch_id in range(start[BATCH] + 1, end[BATCH] + 1):
            names = self._names(f"{BATCH}={batch_id}")
            out += [BatchFile(batch_id, f"{BATCH}={batch_id}/{name}") for name in sorted(names) if name.endswith(".parquet")]
        return out

    def read(self, partition: BatchFile) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        store, base = self._open()
        wanted = to_arrow_schema(self.schema)
        with store.open_input_file(f"{base}/{partition.name}") as source:
            for rows in pq.ParquetFile(source).iter_batches(columns=[n for n in wanted.names if n != BATCH], use_threads=False):
                own = {
                    f.name: pa.array([partition.batch_id] * len(rows), f.type) if f.name == BATCH else rows.column(f.name).cast(f.type, safe=False)
                    for f in wanted
                }
                yield pa.RecordBatch.from_arrays(list(own.values()), schema=wanted)

    def commit(self, end: dict) -> None:
        if self.name:
            self._write(f"_followers/{self.name}", end[BATCH])


class BatchTables(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: T.StructType) -> Follower:
        return Follower(dict(self.options), schema)


def can_follow(uri: str) -> bool:
    """Whether tasks can open the store on their own; where they can't, follow the files (``stream_batches``)."""
    try:
        fs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, OSError):
        return False
    return True


def follow_batches(
    spark: SparkSession, path: str, schema: T.StructType, follower: str | None = None, max_batches: int | None = None,
    with_number: bool = False,
) -> DataFrame:
    """Stream of a batch table's rows. ``follower`` names who is to be waited for before batches are forgotten.

    ``max_batches`` bounds a trigger of a query that goes on for ever; one that takes what is there
    and stops should have none. ``with_number`` adds the column ``batch_id``.
    """
    from ordertide.sinks.tables import ensure_dir, qualified, stream_batches

    if max_batches and not follower:
        raise ValueError("a bound on batches needs a follower's name, under which its place is kept")
    uri = qualified(spark, ensure_dir(spark, path))
    full = T.StructType([*schema.fields, *([T.StructField(BATCH, T.LongType())] if with_number else [])])
    if not can_follow(uri):
        return stream_batches(spark, path, full)
    spark.dataSource.register(BatchTables)
    reader = spark.readStream.format(FORMAT).schema(full).option("path", uri)
    for name, value in (("follower", follower), ("maxbatches", max_batches)):
        if value is not None:
            reader = reader.option(name, str(value))
    return reader.load()
