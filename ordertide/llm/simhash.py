"""SimHash near-duplicates by meeting in the middle.

A text's fingerprint has 64 bits: bit k is set if it is set in more than half the XXH64
hashes (seed 42) of the text's 3-word shingles, repeats included. Two fingerprints at
distance 2 have a common neighbour at distance 1 from both, so every distinct fingerprint
emits itself and its 64 neighbours, and these variants are shuffled. All fingerprints that
meet on a variant are within distance 2 of each other; each is linked to the smallest of
them, which keeps them connected without writing out pairs. At most 65 fingerprints can meet
on one variant, however many documents carry them.

Copies share a fingerprint and are collapsed before anything else is done. A null or empty
text has no words and fingerprint zero, which links like any other. Null ids are never the
smallest unless all ids of a component are null. Repeated rows each get their row.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.llm.common import bounded_batches, durable
from ordertide.llm.components import components

SHINGLE, SEED, RADIUS = 3, 42, 2
BITS = 64
#: Hashes whose bits are counted at once.
SLICE = 1 << 14


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode().lower().split() if text else []


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    w, hashed, join = words(text), xxhash.xxh64_intdigest, b" ".join
    if not w:
        return 0
    if len(w) < size:
        hashes = [hashed(join(w), SEED)]
    else:
        hashes = [hashed(join(s), SEED) for s in zip(*(w[i:] for i in range(size)), strict=False)]
    all_hashes, ones = np.array(hashes, dtype=">u8"), np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(all_hashes), SLICE):
        part = all_hashes[i : i + SLICE]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def as_long(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def ball_masks(radius: int) -> list[int]:
    """Bit patterns within ``radius`` of zero, as signed longs."""
    return [as_long(sum(1 << b for b in c)) for k in range(radius + 1) for c in combinations(range(BITS), k)]


def links(prints: DataFrame, fp: str = "fp", radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all within ``radius`` of each other."""
    if radius % 2:
        raise ValueError("the radius is met from both sides and so must be even")
    x = F.col(fp)
    variants = prints.select(x.alias("a"), F.explode(F.array(*[x.bitwiseXOR(F.lit(m)) for m in ball_masks(radius // 2)])).alias("variant"))
    hubs = variants.groupBy("variant").agg(F.min("a").alias("b"), F.max("a").alias("most")).where("b < most")
    met = variants.join(hubs.select("variant", "b"), "variant").where("a != b")
    return met.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b").distinct()


def classes(prints: DataFrame, fp: str = "fp", doc_id: str = "doc_id", found: DataFrame | None = None) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint in ``prints``; ``found`` are other links than those of ``links``."""
    own = durable(prints.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("first_id")))
    rooted = own.join(components(links(own) if found is None else found).withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("component", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.select("fp", "root").join(least, "root")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``df``."""
    prints = durable(bounded_batches(df).select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text)).alias("fp")))
    return prints.join(classes(prints), "fp").select("doc_id", "fp", "component_id")


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", printed=fingerprints, grouped=classes) -> DataFrame:
    """``df`` with one row of each component: the smallest id; of rows that share it, one.

    ``printed`` and ``grouped`` can give other fingerprints and classes.

    Only ids and fingerprints are grouped; whole rows move once, to meet the chosen ids. A
    component of null ids keeps a row of its smallest fingerprint.
    """
    key = ["_near_fp", "_near_id", "_near_null"]
    tagged = bounded_batches(df).withColumns({
        "_near_fp": printed(F.col(text)), "_near_id": F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "_near_null": F.col(doc_id).isNull(),
    })
    prints = durable(tagged.select(F.col("_near_fp").alias("fp"), F.col(doc_id).alias("doc_id"), "_near_id", "_near_null"))
    rooted = prints.join(grouped(prints), "fp")
    chosen = rooted.groupBy("root").agg(F.min(F.struct("_near_null", "doc_id", "fp", "_near_id")).alias("k"))
    chosen = chosen.select(F.col("k.fp").alias("_near_fp"), "k._near_id", "k._near_null")
    again = Window.partitionBy(*key).orderBy(F.xxhash64(F.col(text)))
    met = tagged.join(chosen, key, "left_semi").withColumn("_near_n", F.row_number().over(again))
    return met.where("_near_n = 1").select(*df.columns)


def digest(near: DataFrame) -> DataFrame:
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
