"""Exact search for the vectors of highest inner product by columnar branch-and-bound.

Vectors lie in tiles, dimension by dimension (``vertical``), and a tile's dimensions are read
heaviest first, a block at a time. After each block a candidate's product is known but for the
rest, whose size is at most the product of the rests' lengths (their remaining mass). A query's
``k``-th highest lower bound so far is what a candidate's upper bound must reach; those that can't
are dropped from the columns read next. The bound found in one tile goes on to the next tile of the
cell, and the best of all cells are cut to ``k`` by a window, which Spark limits before the shuffle.

Scores are whole numbers, so rounding in bounds is covered by half a unit. Ties go to the smaller
id. Which rows take part is said in ``vertical``. Fewer candidates than ``k`` give fewer rows, an
empty table none. A query that occurs twice has its results twice, and each is the other's
candidate. Other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordertide.llm import vertical
from ordertide.llm.vertical import STEP, Tile, order

K, SCALE, QUERY_EVERY = 20, 64, 20
#: Queries whose first block is multiplied at once.
SLICE = 32
SCHEMA = "query_row long, query_id long, vec_id long, score long"


def _lengths(m: np.ndarray, ends: list[int]) -> list[np.ndarray]:
    """For each end: the lengths of the columns from there on."""
    return [np.sqrt(np.square(m[e:]).sum(axis=0)) for e in ends]


def tile_best(queries: np.ndarray, own: np.ndarray, tile: Tile, k: int, least: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (row of ``queries``): places in the tile and scores of up to ``k`` best candidates.

    ``least`` holds a score each query's results must reach to matter, and is raised.
    """
    d = len(tile.columns)
    heavy = np.argsort(-np.square(tile.columns).sum(axis=1), kind="stable")
    columns, q = tile.columns[heavy], queries[:, heavy].astype(np.float64)
    ends = [*range(STEP, d, STEP), d]
    rest, rest_q = _lengths(columns, ends), _lengths(q.T, ends)
    out = []
    for begin in range(0, len(q), SLICE):
        first = q[begin : begin + SLICE, : ends[0]] @ columns[: ends[0]]
        for n in range(begin, min(begin + SLICE, len(q))):
            at = np.flatnonzero(tile.rows != own[n])
            if (exact := tile.products(queries[n], at)) is None:
                total, start = first[n - begin][at], ends[0]
                for step, end in enumerate(ends):
                    if step:
                        total = total + q[n, start:end] @ columns[start:end, at]
                        start = end
                    reach = rest_q[step][n] * rest[step][at] + 0.5
                    if len(at) > k:
                        least[n] = max(least[n], np.partition(total - reach, -k)[-k])
                    alive = total + reach >= least[n]
                    at, total = at[alive], total[alive]
                exact = np.rint(total).astype(np.int64)
            best = order(exact, tile.ids[at], k)
            out.append((at[best], exact[best]))
    return out


def cell_best(k: int):
    def run(block: pd.DataFrame, tiles: list[Tile]) -> pd.DataFrame:
        queries = np.array([*block["v"]], dtype=np.int64).reshape(len(block), -1)
        own, least = block["row"].to_numpy(), np.full(len(block), -np.inf)
        held: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(len(block))]
        for tile in tiles:
            for n, (at, scores) in enumerate(tile_best(queries, own, tile, k, least)):
                held[n].append((tile.ids[at], scores))
        parts = []
        for n, found in enumerate(held):
            ids, scores = (np.concatenate(x) for x in zip(*found, strict=True))
            best = order(scores, ids, k)
            parts.append(pd.DataFrame({"query_row": own[n], "query_id": block["id"].iloc[n], "vec_id": ids[best], "score": scores[best]}))
        return pd.concat(parts)

    return run


def search(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K, scale: int = SCALE, every: int = QUERY_EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows of every row whose id ``every`` divides."""
    rows = vertical.whole_rows(df, scale, vec_id, embedding)
    found = vertical.scan(rows.where(F.col("id") % every == 0), vertical.tiles(rows), cell_best(k), SCHEMA)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
