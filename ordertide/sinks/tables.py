"""Parquet tables with one folder per micro-batch: ``<path>/batch_id=N``.

A micro-batch writes only its own folder, so running it again cannot add rows, and readers can
leave out the batch being written. Its files are written to a hidden draft ``_writing-N``; when all
are there, an entry ``_commits/N`` says so, and only then they move to the visible folder. A move
that breaks off is finished from the draft, never written anew, so a file once seen by a follower
keeps its name and content. A batch counts once it has an entry and no draft.
``<path>/_owner`` names the streaming query whose checkpoint numbers the batches; another query is
refused. ``<path>/_followers/<name>`` holds the last batch each follower is done with.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide import schemas as S
from ordertide.functions.clock import as_instant
from ordertide.operators.upsert import latest_wins, stamped

BATCH = "batch_id"


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop_path(spark, path)
    return fs.exists(target)


def ensure_dir(spark: SparkSession, path: str) -> str:
    fs, target = _hadoop_path(spark, path)
    fs.mkdirs(target)
    return path


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its store, as tools beside Spark need it."""
    fs, target = _hadoop_path(spark, path)
    return target.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/{BATCH}={batch_id}"


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, target = _hadoop_path(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _create_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    fs, target = _hadoop_path(spark, path)
    stream = fs.create(target, overwrite)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _files_below(spark: SparkSession, path: str) -> list[str]:
    """Files at any depth below ``path``, relative to it."""
    fs, target = _hadoop_path(spark, path)
    found, base = fs.listFiles(target, True), target.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()
    out = []
    while found.hasNext():
        out.append(found.next().getPath().toString()[len(base) + 1:])
    return out


def _listed(spark: SparkSession, path: str) -> list[str]:
    fs, target = _hadoop_path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(target)] if fs.exists(target) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop_path(spark, path)
    fs.delete(target, True)


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, old = _hadoop_path(spark, source)
    new = _hadoop_path(spark, target)[1]
    fs.delete(new, True)
    if not fs.rename(old, new):
        raise OSError(f"could not move {source} to {target}")


def draft_path(path: str, batch_id: int) -> str:
    return f"{path}/_writing-{batch_id}"


def commit_path(path: str, batch_id: int) -> str:
    return f"{path}/_commits/{batch_id}"


def is_committed(spark: SparkSession, path: str, batch_id: int) -> bool:
    return path_exists(spark, commit_path(path, batch_id))


def committed_batches(spark: SparkSession, path: str) -> set[int]:
    return {int(name) for name in _listed(spark, f"{path}/_commits") if name.isdigit()}


def batch_note(spark: SparkSession, path: str, batch_id: int) -> str:
    """What the writer of a committed batch left in its entry."""
    return (_read_text(spark, commit_path(path, batch_id)) or "").partition("\n")[2]


def finish_move(spark: SparkSession, path: str, batch_id: int) -> None:
    """Make a committed batch's files visible. Those a broken-off move has taken along stay as they are."""
    draft, place = draft_path(path, batch_id), batch_path(path, batch_id)
    if not path_exists(spark, draft):
        return
    if not path_exists(spark, place):
        _move(spark, draft, place)
        return
    for name in _files_below(spark, draft):
        ensure_dir(spark, f"{place}/{name}".rpartition("/")[0])
        _move(spark, f"{draft}/{name}", f"{place}/{name}")
    _delete(spark, draft)


def unmoved(spark: SparkSession, path: str) -> set[int]:
    """Committed batches whose files may not all be visible yet."""
    prefix = "_writing-"
    drafts = {int(name[len(prefix):]) for name in _listed(spark, path) if name.startswith(prefix)}
    return drafts & committed_batches(spark, path)


def table_owner(spark: SparkSession, path: str) -> str | None:
    return _read_text(spark, f"{path}/_owner")


def check_owner(spark: SparkSession, path: str) -> None:
    """Bind a table to the checkpoint that numbers its batches, or refuse a foreign one.

    Spark tells the running query's id, which its checkpoint keeps. Jobs outside a stream have
    none and number their batches themselves.
    """
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        return
    owner = table_owner(spark, path)
    if owner is None and not committed_batches(spark, path):
        _create_text(spark, f"{path}/_owner", query)
    elif owner != query:
        raise ValueError(f"{path} holds batches of another checkpoint than that of query {query}")


def write_batch(
    df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (), replace: bool = False, note: str = "",
    after: Callable[[str], None] = lambda step: None,
) -> None:
    """Write the rows of one micro-batch once.

    A committed batch is kept, and its move finished: its rows are a function of its input and of
    earlier batches, and readers may have taken its files already. It is still computed, since a
    stateful query commits its state only if its batch runs. ``replace`` is for scheduled jobs that
    state the whole of a batch anew, of tables that nothing follows. ``note`` is kept in the entry;
    ``after`` is told of each step.
    """
    spark = df.sparkSession
    check_owner(spark, path)
    if is_committed(spark, path, batch_id) and not replace:
        finish_move(spark, path, batch_id)
        df.write.format("noop").mode("overwrite").save()
        return
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(draft_path(path, batch_id))
    after("draft")
    # Without an entry nobody has read this folder; a replaced batch has no followers.
    _delete(spark, commit_path(path, batch_id))
    _delete(spark, batch_path(path, batch_id))
    _create_text(spark, commit_path(path, batch_id), f"{table_owner(spark, path) or ''}\n{note}")
    after("entry")
    finish_move(spark, path, batch_id)
    after("move")


def stream_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Follow a table's visible folders as a stream of files. Works on every store that Spark reads; the
    whole table is listed at each trigger (see ``sources.batches`` for following it by number)."""
    if BATCH in schema.names:
        return spark.readStream.schema(schema).parquet(ensure_dir(spark, path))
    return spark.readStream.schema(schema).parquet(f"{ensure_dir(spark, path)}/{BATCH}=*")


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, before: int | None = None
) -> DataFrame:
    """All committed batches of a table, or those before batch ``before``; an absent table is empty."""
    with_batch = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    rows = spark.read.schema(with_batch).parquet(ensure_dir(spark, path))
    prefix = f"{BATCH}="
    present = {int(name[len(prefix):]) for name in _listed(spark, path) if name.startswith(prefix)}
    if unfinished := (present - committed_batches(spark, path)) | unmoved(spark, path):
        rows = rows.filter(~F.col(BATCH).isin(*unfinished))
    return rows if before is None else rows.filter(F.col(BATCH) < before)


def merge_batches(
    spark: SparkSession, path: str, upto: int, rows: DataFrame, partition_by: Sequence[str] = (), since: int = 0
) -> None:
    """Put ``rows``, the wanted rows of the batches ``since`` to ``upto``, in place of those batches.

    For the query that owns the table, between two of its batches, when nothing follows it; a report
    that is just reading those files fails and is run again. Broken off, it is finished by
    :func:`finish_merge`.
    """
    if not is_committed(spark, path, upto):
        raise ValueError(f"batch {upto} of {path} is not committed")
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/_merged")
    _create_text(spark, f"{path}/_merge_upto", f"{since} {upto}", overwrite=True)
    finish_merge(spark, path)


def finish_merge(spark: SparkSession, path: str) -> None:
    """Complete a merge whose rows were written; without one, nothing."""
    found = _read_text(spark, f"{path}/_merge_upto")
    if not found:
        return
    *since, upto = (int(x) for x in found.split())
    if path_exists(spark, f"{path}/_merged"):
        _move(spark, f"{path}/_merged", batch_path(path, upto))
    for batch_id in committed_batches(spark, path):
        if (since or [0])[0] <= batch_id < upto:
            _delete(spark, commit_path(path, batch_id))
            _delete(spark, batch_path(path, batch_id))
    _delete(spark, f"{path}/_merge_upto")


def merge_tiers(
    spark: SparkSession, path: str, batch_id: int, schema: T.StructType, fan: int, partition_by: Sequence[str] = (),
    combine: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> tuple[int, int] | None:
    """K4: before batch ``batch_id``, put its last ``fan`` neighbours together; every ``fan`` such folders
    make a larger one, and so on.

    A merge reads only what came since the last of its size, so a row is written again once per
    size, which grows with the logarithm of the batches, and as many folders stay. ``combine``
    may thin rows out, such as versions a later one replaces. Returns the batches merged.
    """
    finish_merge(spark, path)
    width = 1
    while fan > 1 and batch_id and batch_id % (width * fan) == 0:
        width *= fan
    since, upto = batch_id - width, batch_id - 1
    if width == 1 or not is_committed(spark, path, upto):
        return None
    rows = read_batches(spark, path, schema, before=batch_id).filter(F.col(BATCH) >= since)
    merge_batches(spark, path, upto, combine(rows).select(*schema.names), partition_by, since)
    return since, upto


def drop_days(spark: SparkSession, path: str, before: date, column: str = "day") -> list[str]:
    """K8: delete the day folders of all batches whose day is before ``before``. No row is read or written.

    Only folder names reach the driver. For the query that owns the table, between its batches.
    """
    dropped, prefix = [], f"{column}="
    for batch_id in sorted(committed_batches(spark, path)):
        for name in _listed(spark, batch_path(path, batch_id)):
            if name.startswith(prefix) and name[len(prefix):] < before.isoformat():
                _delete(spark, f"{batch_path(path, batch_id)}/{name}")
                dropped.append(f"{batch_id}/{name}")
    return dropped


def note_followed(spark: SparkSession, path: str, name: str, upto: int) -> None:
    """Say that follower ``name`` is done with the batches up to ``upto``."""
    _create_text(spark, f"{path}/_followers/{name}", str(upto), overwrite=True)


def forget_followed(spark: SparkSession, path: str, keep: int = 0) -> int:
    """Delete the batches that every follower is done with, but for the last ``keep``; the first one left.

    ``_kept_from`` is written first, so that a follower that would miss rows is refused.
    """
    done = [int(_read_text(spark, f"{path}/_followers/{name}") or -1) for name in _listed(spark, f"{path}/_followers") if not name.startswith(".")]
    kept_from = int(_read_text(spark, f"{path}/_kept_from") or 0)
    first = min(done) + 1 - keep if done else 0
    if first <= kept_from:
        return kept_from
    _create_text(spark, f"{path}/_kept_from", str(first), overwrite=True)
    for batch_id in committed_batches(spark, path):
        if batch_id < first:
            _delete(spark, commit_path(path, batch_id))
            _delete(spark, batch_path(path, batch_id))
    return first


def upsert_batch(
    df: DataFrame, batch_id: int, path: str, now: datetime | Column, replace: bool = False, partition_by: Sequence[str] = ()
) -> None:
    """K4 K5: add new versions of keyed rows, stamped with the write time."""
    write_batch(stamped(df, now), path, batch_id, partition_by, replace=replace)


def read_latest(
    spark: SparkSession, path: str, schema: T.StructType = S.AGG_1MIN, key: Sequence[str] = S.AGG_KEY
) -> DataFrame:
    """K4: current state of an upserted table. Filters on the key reach the file scan, and filters on the
    day of a schema that has one reach its folders."""
    folders = [c for c in ("stat_date",) if c in schema.names and c not in key]
    return latest_wins(read_batches(spark, path, schema).select(*schema.names, BATCH), (*key, *folders)).select(*schema.names)


def compact(
    spark: SparkSession,
    path: str,
    new_path: str,
    upto: int,
    schema: T.StructType = S.AGG_1MIN,
    key: Sequence[str] = S.AGG_KEY,
) -> None:
    """Collapse batches up to and including ``upto`` into one folder of a new table.

    The old table is left alone, and its folders within a batch stay as they are. Run it while no query writes, then start the query on
    the new table with the same checkpoint: its next batch is ``upto + 1``.
    """
    rows = read_batches(spark, path, schema, before=upto + 1)
    folders = [c for c in rows.columns if c not in (*schema.names, BATCH)]
    write_batch(latest_wins(rows, key), new_path, upto, folders)
    owner = table_owner(spark, path)
    if owner is not None:
        _create_text(spark, f"{new_path}/_owner", owner, overwrite=True)


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Make tables available to ad-hoc SQL by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def drop_expired_batches(
    spark: SparkSession, path: str, now: datetime | Column, ttl: str = "7 days", schema: T.StructType = S.LEDGER
) -> list[int]:
    """K8: delete the folders of ledger batches whose every row is older than ``ttl``.

    Rows of younger folders stay until their folder ages; readers filter them by time.
    Only the batch numbers reach the driver. Run it while no batch reads the ledger; the ingest
    query drops expired rows itself when it merges batches.
    """
    cutoff = as_instant(now) - F.expr(f"interval {ttl}")
    aged = (
        read_batches(spark, path, schema)
        .groupBy(BATCH)
        .agg(F.max("created_at").alias("newest"))
        .filter(F.col("newest") < cutoff)
    )
    dropped = sorted(row[BATCH] for row in aged.select(BATCH).collect())
    for batch_id in dropped:
        _delete(spark, commit_path(path, batch_id))
        _delete(spark, batch_path(path, batch_id))
    return dropped


def fan_out(df: DataFrame, batch_id: int, sinks: dict[str, Callable[[DataFrame, int], None]]) -> None:
    """K6: several writes from one input that is computed once."""
    shared = df.persist()
    try:
        for write in sinks.values():
            write(shared, batch_id)
    finally:
        shared.unpersist()
