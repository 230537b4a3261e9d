"""Hard negatives by a vertical scan in each anchor's own order of dimensions.

Vectors lie in tiles, dimension by dimension (``vertical``). An anchor reads a tile's columns
in descending order of its own components' size. What the columns not yet read can add lies between
sums of the least and the most that each can contribute, from the column's smallest and largest
value; that bounds every candidate's score from both sides, and those that can't count any more are
taken out of the anchor's bitmap of candidates.

First the ``positives`` best rows of the same label are found: a candidate's upper bound must reach
the lower bound of the last place. Each positive's score gives a window of scores for negatives
(half to 95 hundredths of it). The second scan keeps the candidates of other labels whose bounds
touch a window and, in it, can still be among the first ``per_positive``, until all scores are exact.
The best of all tiles are cut by windows, which Spark limits before their shuffle.

Rows with a null label take no part; which others don't is said in ``vertical``. Ties go to the
smaller id. A positive with a negative score has an empty window. Anchors without a positive and
positives without a negative give no rows, nor does an empty table. Repeated rows are rows of their
own. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordertide.llm import vertical
from ordertide.llm.common import durable
from ordertide.llm.vertical import STEP, Tile, order

SCALE, ANCHOR_EVERY, MOVED_EVERY, LABELS = 256, 50, 7, 10
POSITIVES, PER_POSITIVE = 5, 3
#: A negative's score lies between these hundredths of the positive's.
LEAST, MOST = 50, 95
POSITIVE_SCHEMA = "anchor_row long, anchor_id long, positive_row long, positive_id long, positive_score long"
NEGATIVE_SCHEMA = "anchor_row long, anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long"


def resolved(tile: Tile, anchor: np.ndarray, at: np.ndarray, keep: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the candidates ``at`` that ``keep(lower, upper)`` leaves after every step."""
    if not len(at) or (exact := tile.products(anchor, at)) is not None:
        return at, exact if len(at) else np.zeros(0, dtype=np.int64)
    q = anchor.astype(np.float64)
    largest = np.argsort(-np.abs(q), kind="stable")
    ends = tile.span[:, largest] * q[largest]
    # What the columns from each place of that order on add at least and at most.
    low, high = (np.append(np.cumsum(e[::-1])[::-1], 0.0) for e in (ends.min(axis=0), ends.max(axis=0)))
    known = np.zeros(len(at))
    for begin in range(0, len(q), STEP):
        dims, end = largest[begin : begin + STEP], min(begin + STEP, len(q))
        known = known + q[dims] @ tile.columns[np.ix_(dims, at)]
        alive = keep(known + low[end], known + high[end])
        at, known = at[alive], known[alive]
    return at, np.rint(known).astype(np.int64)


def same_label(n: int):
    """Block of anchors by tiles: each anchor's ``n`` best rows of its label."""

    def run(block: pd.DataFrame, tiles: list[Tile]) -> pd.DataFrame:
        parts = []
        for a in block.itertuples():
            anchor, least, ids, rows, scores = np.array(a.v, dtype=np.int64), [-np.inf], [], [], []

            def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
                if len(lower) > n:
                    least[0] = max(least[0], np.partition(lower, -n)[-n])  # noqa: B023
                return upper >= least[0]  # noqa: B023

            for tile in tiles:
                at, found = resolved(tile, anchor, np.flatnonzero((tile.labels == a.label) & (tile.rows != a.row)), keep)
                ids.append(tile.ids[at])
                rows.append(tile.rows[at])
                scores.append(found)
            ids, rows, scores = np.concatenate(ids), np.concatenate(rows), np.concatenate(scores)
            best = order(scores, ids, n)
            parts.append(pd.DataFrame({
                "anchor_row": a.row, "anchor_id": a.id, "positive_row": rows[best], "positive_id": ids[best], "positive_score": scores[best],
            }))
        return pd.concat(parts)

    return run


def windows(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest score of a negative for each positive's score."""
    exact = [int(s) for s in scores]
    return np.array([-(-LEAST * s // 100) for s in exact]), np.array([MOST * s // 100 for s in exact])


def other_labels(n: int):
    """Block of anchors with their positives by tiles: the ``n`` best rows of other labels in each positive's window."""

    def run(block: pd.DataFrame, tiles: list[Tile]) -> pd.DataFrame:
        parts = []
        for a in block.itertuples():
            anchor, positive = np.array(a.v, dtype=np.int64), [(p["positive_id"], p["positive_score"]) for p in a.positives]
            floor, ceiling = windows(np.array([s for _, s in positive]))
            least = floor.astype(np.float64)
            found_ids, found_scores = [], []

            def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
                alive = np.zeros(len(lower), dtype=bool)
                for w in range(len(floor)):  # noqa: B023
                    sure = lower[(lower >= floor[w]) & (upper <= ceiling[w])]  # noqa: B023
                    if len(sure) >= n:
                        least[w] = max(least[w], np.partition(sure, -n)[-n])  # noqa: B023
                    alive |= (upper >= least[w]) & (lower <= ceiling[w])  # noqa: B023
                return alive

            if (floor <= ceiling).any():
                for tile in tiles:
                    at, scores = resolved(tile, anchor, np.flatnonzero(tile.labels != a.label), keep)
                    found_ids.append(tile.ids[at])
                    found_scores.append(scores)
            if not found_ids:
                continue
            ids, scores = np.concatenate(found_ids), np.concatenate(found_scores)
            for place, (positive_id, positive_score) in enumerate(positive):
                inside = np.flatnonzero((scores >= floor[place]) & (scores <= ceiling[place]))
                best = inside[order(scores[inside], ids[inside], n)]
                parts.append(pd.DataFrame({
                    "anchor_row": a.row, "anchor_id": a.id, "place": place, "positive_id": positive_id, "positive_score": positive_score,
                    "negative_id": ids[best], "negative_score": scores[best],
                }))
        return pd.concat(parts) if parts else pd.DataFrame({f.split()[0]: [] for f in NEGATIVE_SCHEMA.split(", ")}, dtype="int64")

    return run


def moved_labels(df: DataFrame, vec_id: str = "vec_id", label: str = "label") -> DataFrame:
    """``df`` with the label of every row whose id ``MOVED_EVERY`` divides moved on by one."""
    moved = F.when(F.col(vec_id) % MOVED_EVERY == 0, (F.col(label) + 1) % LABELS).otherwise(F.col(label))
    return df.withColumn(label, moved)


def mine(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
         scale: int = SCALE, every: int = ANCHOR_EVERY, positives: int = POSITIVES, per_positive: int = PER_POSITIVE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    labelled = df.where(F.col(label).isNotNull())
    rows = vertical.whole_rows(labelled, scale, vec_id, embedding, label=F.col(label).cast("long"))
    packed, anchors = vertical.tiles(rows, "label"), rows.where(F.col("id") % every == 0)
    near = vertical.scan(anchors, packed, same_label(positives), POSITIVE_SCHEMA)
    place = F.row_number().over(Window.partitionBy("anchor_row").orderBy(F.desc("positive_score"), "positive_id", "positive_row"))
    near = near.withColumn("_place", place).where(F.col("_place") <= positives)
    per_anchor = near.groupBy("anchor_row").agg(F.array_sort(F.collect_list(F.struct("_place", "positive_id", "positive_score"))).alias("positives"))
    asked = durable(anchors.join(per_anchor, F.col("row") == F.col("anchor_row")).drop("anchor_row"))
    far = vertical.scan(asked, packed, other_labels(per_positive), NEGATIVE_SCHEMA)
    rank = F.row_number().over(Window.partitionBy("anchor_row", "place").orderBy(F.desc("negative_score"), "negative_id"))
    return far.withColumn("rank", rank).where(F.col("rank") <= per_positive).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
    )
