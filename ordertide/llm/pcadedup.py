"""Near-duplicate embeddings: tiles of vectors compared along their principal axes.

Vectors are brought to length one and turned onto the principal axes of the whole table, so
that the first coordinates carry the most. Two vectors of cosine c are sqrt(2 - 2c) apart, so
along no axis further than that: cells of that width along the first ``CELL_AXES`` axes need
comparing only with themselves and their neighbours. A cell of more than ``TILE`` vectors is
split into tiles, and pairs of tiles are the tasks' work.

Within a pair of tiles products are added up a few coordinates at a time. After each step the
rest of a product is at most the product of the rests' lengths, and pairs that can't reach the
threshold any more are dropped; what is left at the end is checked in double precision on the
unturned vectors.

Equal vectors with equal labels are compared once and counted as many. Of a tile pair's links
only a spanning forest is passed on, and the number of links of each vector. Vectors that are
null, zero, or hold null, NaN or infinite components link with nothing, nor do those with a
null label or of other dimension. Repeated rows are vectors of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import bounded_batches, durable
from ordertide.llm.components import components

THRESHOLD, TILE, CELL_AXES = 0.98, 1024, 3
#: Coordinates added per step; room for rounding in bounds.
STEP, SLACK = 8, 1e-9
#: Numbers of a side gathered at once while pairs are checked.
NUMBERS = 1 << 20


def comparable(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(node, label, v, first_id, n): each distinct vector that can link, with its smallest id and how many rows have it."""
    v = F.col("v")
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = rows.where(F.col("label").isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0))
    grouped = good.groupBy("label", "v").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    return durable(grouped.select(F.monotonically_increasing_id().alias("node"), "label", "v", "first_id", "n"))


def units(vectors: pd.Series | list) -> np.ndarray:
    """Rows of length one; scaled first, so that large components can't overflow."""
    m = np.array([*vectors], dtype=np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def axes(distinct: DataFrame) -> dict[int, np.ndarray]:
    """By dimension: principal axes as columns, the strongest first. Only sums of products are gathered."""

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, part in batch.groupby(batch["v"].map(len))["v"]:
                u = units(part)
                sums[d] = sums.get(d, 0.0) + u.T @ u
        for d, m in sums.items():
            i, j = np.divmod(np.arange(d * d), d)
            yield pd.DataFrame({"d": d, "i": i, "j": j, "x": m.ravel()})

    parts = distinct.select("v").mapInPandas(moments, "d int, i int, j int, x double")
    out: dict[int, np.ndarray] = {}
    # Dimension squared rows.
    for r in parts.groupBy("d", "i", "j").agg(F.sum("x").alias("x")).collect():
        out.setdefault(r["d"], np.zeros((r["d"], r["d"])))[r["i"], r["j"]] = r["x"]
    return {d: np.linalg.eigh(m)[1][:, ::-1].copy() for d, m in out.items()}


def celled(distinct: DataFrame, turned: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """``distinct`` with its unit vector ``u``, turned vector ``z``, dimension ``d`` and cell number ``cell`` along the first axes."""
    width = float(np.sqrt(max(2 - 2 * threshold, 0.0)) + 1e-6)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for d, part in batch.groupby(batch["v"].map(len)):
                u = units(part["v"])
                z = u @ turned[d]
                cells = np.floor(z[:, :CELL_AXES] / width).astype(np.int64)
                yield pd.DataFrame({
                    "node": part["node"], "label": part["label"], "n": part["n"], "d": d,
                    "cell": [c.tolist() for c in cells], "u": [*u], "z": [*z],
                })

    kind = distinct.schema["label"].dataType.simpleString()
    return distinct.select("node", "label", "n", "v").mapInPandas(
        run, f"node long, label {kind}, n long, d int, cell array<long>, u array<double>, z array<double>"
    )


def steps(d: int) -> list[int]:
    """Ends of the stretches of coordinates that are added up at a time."""
    return [*range(STEP, d, STEP), d]


def dots(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Products of rows ``i`` of ``a`` with rows ``j`` of ``b``, ``NUMBERS`` gathered at once."""
    step = max(1, NUMBERS // max(1, a.shape[1]))
    return np.concatenate([np.einsum("ij,ij->i", a[i[k : k + step]], b[j[k : k + step]]) for k in range(0, len(i), step)])


def close_pairs(a: dict[str, np.ndarray], b: dict[str, np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers in ``a`` and ``b`` of all pairs at or above the threshold."""
    za, zb, d = a["z"], b["z"], a["z"].shape[1]
    i = j = total = None
    begin = 0
    for end in steps(d):
        ra, rb = np.linalg.norm(za[:, end:], axis=1), np.linalg.norm(zb[:, end:], axis=1)
        if i is None:
            sums = za[:, begin:end] @ zb[:, begin:end].T
            i, j = np.nonzero(sums + ra[:, None] * rb >= threshold - SLACK)
            total = sums[i, j]
        else:
            total = total + dots(za[:, begin:end], zb[:, begin:end], i, j)
            left = total + ra[i] * rb[j] >= threshold - SLACK
            i, j, total = i[left], j[left], total[left]
        begin = end
        if not len(i):
            return i, j
    exact = dots(a["u"], b["u"], i, j) >= threshold
    return i[exact], j[exact]


def forest(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For nodes 0..max: the smallest node each is connected to by the pairs, by spreading minima."""
    root = np.arange(max(i.max(), j.max()) + 1)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def tile_links(left: pd.DataFrame, right: pd.DataFrame, same: bool, threshold: float) -> pd.DataFrame:
    """Rows (node, links, other): how many vectors each links with here, and one node it is connected to."""
    side = lambda p: {k: np.array([*p[k]], dtype=np.float64) for k in ("z", "u")}
    a = side(left)
    b = a if same else side(right)
    i, j = close_pairs(a, b, threshold)
    if same:
        i, j = i[i < j], j[i < j]
    if not len(i):
        return pd.DataFrame({"node": [], "links": [], "other": []}, dtype="int64")
    na, nb = left["n"].to_numpy(), right["n"].to_numpy()
    nodes = np.concatenate([left["node"].to_numpy(), [] if same else right["node"].to_numpy()]).astype(np.int64)
    shift = 0 if same else len(left)
    links = np.zeros(len(nodes), dtype=np.int64)
    np.add.at(links, i, nb[j])
    np.add.at(links, j + shift, na[i])
    root = forest(i, j + shift)
    met = np.unique(np.concatenate([i, j + shift]))
    return pd.DataFrame({"node": nodes[met], "links": links[met], "other": nodes[root[met]]})


def pair_work(cells: DataFrame, tile: int) -> tuple[DataFrame, DataFrame]:
    """Vectors with their tile, and for each tile the pairs of tiles it takes part in."""
    where = ["label", "d", "cell"]
    sizes = cells.groupBy(*where).agg(F.count(F.lit(1)).alias("size"))
    sizes = durable(sizes.withColumn("tiles", F.ceil(F.col("size") / tile).cast("int")))
    steps_ = [s for s in product((-1, 0, 1), repeat=CELL_AXES) if s >= (0,) * CELL_AXES]
    moves = F.array(*[F.array(*[F.lit(x).cast("long") for x in s]) for s in steps_])
    near = sizes.withColumn("_m", F.explode(moves)).withColumn("cell2", F.zip_with("cell", F.slice("_m", F.lit(1), F.size("cell")), lambda x, y: x + y))
    # With fewer dimensions than axes several moves are one.
    near = near.select(*where, "tiles", "cell2").distinct()
    other = sizes.select("label", "d", F.col("cell").alias("cell2"), F.col("tiles").alias("tiles2"))
    met = near.join(other, ["label", "d", "cell2"])
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    pairs = met.withColumn("t", F.explode(upto("tiles"))).withColumn("t2", F.explode(upto("tiles2")))
    pairs = pairs.where((F.col("cell") != F.col("cell2")) | (F.col("t") <= F.col("t2")))
    pairs = durable(pairs.select("label", "d", "cell", "t", "cell2", "t2").withColumn("pair", F.monotonically_increasing_id()))
    same = (F.col("cell") == F.col("cell2")) & (F.col("t") == F.col("t2"))
    sides = pairs.select("pair", same.alias("same"), F.lit(0).alias("side"), *where, "t").unionByName(
        pairs.where(~same).select("pair", F.lit(False).alias("same"), F.lit(1).alias("side"), "label", "d", F.col("cell2").alias("cell"), F.col("t2").alias("t"))
    )
    tiled = cells.join(sizes.select(*where, "tiles"), where).withColumn("t", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    return tiled, sides


def links(distinct: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(node, links, other), several rows per node: see ``tile_links``."""
    cells = celled(distinct, axes(distinct), threshold)
    tiled, sides = pair_work(cells, tile)
    work = tiled.join(sides, ["label", "d", "cell", "t"]).select("pair", "same", "side", "node", "n", "z", "u")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        left, right = group[group["side"] == 0], group[group["side"] == 1]
        same = bool(group["same"].iloc[0])
        if not same and (left.empty or right.empty):
            return pd.DataFrame({"node": [], "links": [], "other": []}, dtype="int64")
        return tile_links(left, left if same else right, same, threshold)

    return work.groupBy("pair").applyInPandas(run, "node long, links long, other long")


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row per row of ``df``: (vec_id, n_links, component_id, kept)."""
    distinct = comparable(bounded_batches(df), vec_id, embedding, label)
    found = durable(links(distinct, threshold, tile))
    rooted = components(found, "node", "other")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    own = distinct.join(counted, "node", "left").join(rooted, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = own.groupBy("component").agg(F.min("first_id").alias("component_id"))
    judged = own.join(least, "component").select(
        F.col("label").alias("_label"), F.col("v").alias("_v"), "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
    )
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("_l"), F.col(embedding).cast("array<double>").alias("_e"))
    met = rows.join(judged, (F.col("_l") == F.col("_label")) & (F.col("_e") == F.col("_v")), "left")
    component = F.coalesce("component_id", "vec_id")
    return met.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
