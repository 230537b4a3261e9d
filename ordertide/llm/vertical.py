"""Vectors of whole numbers in vertical layout: tiles of columns, met by blocks of queries.

A tile holds up to about ``TILE_NUMBERS`` numbers, dimension by dimension, so that a scan reads the
dimensions it wants and of those the vectors still in question. Tiles are of equal size whatever
their rows, so no label or id is a task's load. Queries come in blocks of about ``BLOCK_NUMBERS``
numbers; a cell of work is one block of queries and ``TILES`` tiles, so its memory is bounded and
the shuffle copies each vector once per block. Nothing is gathered on the driver but two counts.

Vectors that are null or hold null, NaN or infinite components take no part, nor do rows
with a null id. Vectors of other length never meet. Repeated rows are rows of their own: each
has its number, ``row``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import bounded_batches, durable

TILE_NUMBERS, BLOCK_NUMBERS, TILES = 1 << 19, 1 << 16, 4
#: Dimensions added up at a time.
STEP = 8
#: Sums of whole numbers below this are exact in double precision.
EXACT = 2.0**52


def whole_rows(df: DataFrame, scale: int, vec_id: str = "vec_id", embedding: str = "embedding", **more: Column) -> DataFrame:
    """(row, id, d, v) and ``more``: rows that take part, components as whole numbers ``floor(scale * x)``."""
    v = F.col(embedding).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = df.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & finite)
    named = good.select(
        F.col(vec_id).cast("long").alias("id"), F.size(v).alias("d"), F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x)).alias("v"),
        *[c.alias(name) for name, c in more.items()],
    )
    return durable(named.withColumn("row", F.monotonically_increasing_id()))


def _dealt(rows: DataFrame, numbers: int, name: str) -> tuple[DataFrame, int]:
    """``rows`` with a number below the count returned, about ``numbers`` numbers each."""
    held = rows.agg(F.sum(F.greatest("d", F.lit(1)))).first()[0] or 0
    n = max(1, math.ceil(held / numbers))
    return rows.withColumn(name, F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")), n


def tiles(rows: DataFrame, label: str | None = None, numbers: int = TILE_NUMBERS) -> tuple[DataFrame, int]:
    """(d, tile, ids, rows, labels, columns), and how many tiles there are at most of one dimension."""
    dealt, n = _dealt(rows, numbers, "tile")
    slim = dealt.select("d", "tile", "row", "id", "v", (F.col(label) if label else F.lit(0)).cast("long").alias("label"))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        d = int(group["d"].iloc[0])
        columns = np.array([*group["v"]], dtype=np.int64).reshape(len(group), d).T
        return pd.DataFrame({
            "d": [d], "tile": [int(group["tile"].iloc[0])], "ids": [group["id"].to_numpy()], "rows": [group["row"].to_numpy()],
            "labels": [group["label"].to_numpy()], "columns": [np.ascontiguousarray(columns).tobytes()],
        })

    packed = bounded_batches(slim).groupBy("d", "tile").applyInPandas(
        pack, "d int, tile int, ids array<long>, rows array<long>, labels array<long>, columns binary"
    )
    return durable(packed), n


class Tile:
    """A tile's arrays in a task; ``columns`` is dimension by vector."""

    def __init__(self, packed, d: int):
        self.ids, self.rows, self.labels = (np.array(packed[k], dtype=np.int64) for k in ("ids", "rows", "labels"))
        whole = np.frombuffer(packed["columns"], dtype=np.int64).reshape(d, len(self.ids))
        self.most = float(np.abs(whole.astype(np.float64)).max(initial=0.0))
        self.whole, self.columns = whole, whole.astype(np.float64)
        #: Smallest and largest value of each dimension.
        self.span = np.array([self.columns.min(axis=1, initial=np.inf), self.columns.max(axis=1, initial=-np.inf)])

    def products(self, q: np.ndarray, at: np.ndarray) -> np.ndarray | None:
        """Where sums could outgrow double precision: the products, exact up to the bounds of a long; else None."""
        if self.most * float(np.abs(q.astype(np.float64)).max(initial=0.0)) * max(1, len(q)) < EXACT:
            return None
        out = [sum(int(a) * int(b) for a, b in zip(q, self.whole[:, k], strict=True)) for k in at]
        return np.array([min(max(x, -(1 << 63)), (1 << 63) - 1) for x in out], dtype=np.int64)


def order(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def scan(queries: DataFrame, packed: tuple[DataFrame, int], run: Callable[[pd.DataFrame, list[Tile]], pd.DataFrame], schema: str) -> DataFrame:
    """``run`` on every block of queries and group of tiles of the same dimension; its rows.

    ``queries`` has row, d, v and whatever else ``run`` reads.
    """
    stored, n_tiles = packed
    dealt, n_blocks = _dealt(queries, BLOCK_NUMBERS, "block")
    groups = math.ceil(n_tiles / TILES)
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cell = ["d", "block", "part"]
    asked = dealt.withColumn("part", upto(groups))
    offered = stored.withColumn("part", F.pmod("tile", F.lit(groups))).withColumn("block", upto(n_blocks))
    spread = min(n_blocks * groups, 1 << 12)

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({name: [] for name in names}, dtype="int64")
        d = int(left["d"].iloc[0])
        return run(left, [Tile(t, d) for t in right.sort_values("tile").to_dict("records")])

    names = [f.split()[0] for f in schema.split(", ")]
    return bounded_batches(asked).repartition(spread, *cell).groupBy(*cell).cogroup(
        offered.repartition(spread, *cell).groupBy(*cell)
    ).applyInPandas(meet, schema)
