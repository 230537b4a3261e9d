"""K4 over JDBC: stage a batch, then merge it in one statement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows per round trip and parallel writers of the result sink.
FLUSH_ROWS = 1000
WRITERS = 2


def upsert_statement(table: str, staging: str, columns: Sequence[str], key: Sequence[str]) -> str:
    """One batch of the staging table into the keyed table; ``?`` is the batch number."""
    names = ", ".join(columns)
    updates = ", ".join(f"{c} = VALUES({c})" for c in columns if c not in key)
    return (
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} WHERE batch_id = ? "
        f"ON DUPLICATE KEY UPDATE {updates}"
    )


def clear_statement(staging: str) -> str:
    return f"DELETE FROM {staging} WHERE batch_id = ?"


def _run(df: DataFrame, options: dict[str, str], statement: str, batch_id: int) -> None:
    jvm = df.sparkSession._jvm
    jvm.java.lang.Class.forName(options["driver"])
    link = jvm.java.sql.DriverManager.getConnection(options["url"], options["user"], options["password"])
    try:
        call = link.prepareStatement(statement)
        call.setLong(1, batch_id)
        call.executeUpdate()
    finally:
        link.close()


def upsert_jdbc(
    df: DataFrame, batch_id: int, options: dict[str, str], table: str, staging: str, key: Sequence[str]
) -> None:
    """K4: rows travel from the executors to the staging table; the database merges them.

    A replayed batch first clears its own staging rows, so it ends in the same state. The two
    writers sit behind a shuffle, so the work before them keeps its own width.
    """
    _run(df, options, clear_statement(staging), batch_id)
    staged = df.withColumn("batch_id", F.lit(batch_id)).repartition(WRITERS)
    target = {**options, "dbtable": staging, "batchsize": str(FLUSH_ROWS)}
    staged.write.format("jdbc").options(**target).mode("append").save()
    _run(df, options, upsert_statement(table, staging, df.columns, key), batch_id)
    _run(df, options, clear_statement(staging), batch_id)
