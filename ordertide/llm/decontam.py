"""Benchmark decontamination by a prefix-filtered join of word shingles.

A window is ``WINDOW`` consecutive words of a benchmark item; a shorter item is one window. A
window can only occur where all its shingles (``SHINGLE`` words) occur, so it is enough to
look for one of them: shingles are ordered by how often the documents hold them and each
window joins on its rarest alone. A window with a shingle that no document holds can't occur
and is dropped. From the shingle's place in the document and in the window follows where the
window would start; it must lie within the document, and its words are compared exactly.

Documents are read as segments of ``SEGMENT`` words with the words a window may reach on
either side, so rows stay small however long a text is. Shingles and windows of the benchmark
are broadcast while they are at most ``MAX_BROADCAST`` rows of bounded length; beyond that the
documents' shingles are shuffled, and only candidates meet their segments again.

A null or empty text has no words, no hits and is not contaminated. A null or empty item has
no windows. Repeated documents each get their row; repeated items count once per ``item_id``,
null ids not at all. Equally rare shingles: the first in the window. Extra columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import ascii_lower, durable

WINDOW, SHINGLE, SEGMENT = 13, 4, 256
REACH = WINDOW - 1
#: Rows; a window's words are at most ``WINDOW``, so long words are bounded too by ``MAX_WORD_CHARS``.
MAX_BROADCAST, MAX_WORD_CHARS = 200_000, 1_000
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEY = ["doc_id", "_text_hash"]


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAK, -1), "")


def windows_of(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(window, item_id): distinct windows as word arrays, with each item that has them."""
    w = items.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - REACH, F.lit(1)))
    return w.select("item_id", "w", F.explode(starts).alias("s")).select(F.slice("w", F.col("s"), WINDOW).alias("window"), "item_id").distinct()


def _hash(k: int, parts: list[Column]) -> Column:
    return F.xxhash64(F.lit(k), *parts)


def window_shingles(windows: DataFrame) -> DataFrame:
    """(window, at, size, shingle): all shingles of each distinct window; short windows are one shingle."""
    size = F.least(F.size("window"), F.lit(SHINGLE))
    one = windows.select("window").distinct().withColumn("size", size)
    placed = one.select("window", "size", F.explode(F.sequence(F.lit(0), F.size("window") - F.col("size"))).alias("at"))
    cases = F.coalesce(*[
        F.when(F.col("size") == k, _hash(k, [F.get("window", F.col("at") + i) for i in range(k)])) for k in range(1, SHINGLE + 1)
    ])
    return placed.withColumn("shingle", cases)


def segments(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, _text_hash, base, lead, seg): ``SEGMENT`` words from ``base`` on, ``lead`` words before them and as many as exist after."""
    t = F.col(text)
    w = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(t).alias("_text_hash"), words(t).alias("w")).where(F.size("w") > 0)
    cut = w.select(*KEY, "w", F.explode(F.sequence(F.lit(0), F.size("w") - 1, F.lit(SEGMENT))).alias("base"))
    lead = F.least(F.col("base"), F.lit(REACH))
    return cut.select(*KEY, "base", lead.alias("lead"), F.slice("w", F.col("base") - lead + 1, lead + SEGMENT + REACH).alias("seg"))


def positions(segs: DataFrame, sizes: list[int], *keep: str) -> DataFrame:
    """(keep..., pos, shingle): every place in a segment proper (``pos`` counts from the segment's first word) with its shingles."""
    shifted = [F.slice("seg", F.col("lead") + 1 + i, F.lit(SEGMENT)).alias(f"w{i}") for i in range(SHINGLE)]
    rows = segs.select(*keep, F.col("lead").alias("_lead"), F.posexplode(F.arrays_zip(*shifted)))
    parts = [F.col(f"col.w{i}") for i in range(SHINGLE)]
    hashes = {k: F.when(parts[k - 1].isNotNull(), _hash(k, parts[:k])) for k in sizes}
    rows = rows.withColumn("pos", F.col("_lead") + F.col("pos"))
    if len(sizes) == 1:
        return rows.select(*keep, "pos", hashes[sizes[0]].alias("shingle")).where("shingle is not null")
    return rows.select(*keep, "pos", F.explode(F.array(*hashes.values())).alias("shingle")).where("shingle is not null")


def _small(df: DataFrame, broadcast: bool) -> DataFrame:
    return F.broadcast(df) if broadcast else df


def _fits(windows: DataFrame, limit: int) -> bool:
    """Whether the windows may be broadcast: few enough, and without monstrous words."""
    longest = F.max(F.array_max(F.transform("window", lambda w: F.length(w))))
    n, chars = windows.agg(F.count(F.lit(1)), longest).first()
    return n * (WINDOW - SHINGLE + 1) <= limit and (chars or 0) <= MAX_WORD_CHARS


def hits(docs: DataFrame, windows: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = MAX_BROADCAST) -> DataFrame:
    """(doc_id, _text_hash, start, window): every place where a window occurs; ``start`` counts words from 0."""
    shingles = durable(window_shingles(windows))
    small = _fits(windows, limit)
    sizes = [r[0] for r in shingles.select("size").distinct().orderBy("size").collect()]
    segs = segments(docs, doc_id, text)
    if not sizes:
        return segs.select(*KEY, F.lit(0).alias("start"), F.lit(None).cast("array<string>").alias("window")).limit(0)
    wanted = shingles.select("shingle").distinct()
    seen = positions(segs, sizes).join(_small(wanted, small), "shingle").groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    # One row per window: its rarest shingle; left join, so that a shingle nobody holds counts zero.
    ranked = shingles.join(seen, "shingle", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "shingle")).alias("rarest")
    )
    anchors = durable(ranked.where("rarest.n > 0").select("window", F.col("rarest.at").alias("at"), F.col("rarest.shingle").alias("shingle")))
    if small:
        met = positions(segs, sizes, *KEY, "base", "lead", "seg").join(F.broadcast(anchors), "shingle")
    else:
        slim = positions(segs, sizes, *KEY, "base").join(anchors, "shingle").select(
            F.col("doc_id").alias("_d"), F.col("_text_hash").alias("_h"), F.col("base").alias("_b"), "pos", "at", "window"
        ).distinct()
        met = slim.join(segs.distinct(), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_text_hash") == F.col("_h")) & (F.col("base") == F.col("_b")))
    first = F.col("pos") - F.col("at")
    inside = (first >= 0) & (first + F.size("window") <= F.size("seg"))
    exact = F.when(inside, F.slice("seg", first + 1, F.size("window")) == F.col("window"))
    return met.where(exact).select(*KEY, (F.col("base") - F.col("lead") + first).alias("start"), "window")


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", limit: int = MAX_BROADCAST) -> DataFrame:
    """One row per document: (doc_id, _text_hash, n_words, n_hit, items); ``items`` are ids as sorted strings."""
    windows = durable(windows_of(items, item_id, item_text))
    distinct = windows.select("window").distinct()
    found = durable(hits(docs, distinct, doc_id, text, limit).distinct())
    covered = F.aggregate(
        F.array_sort(F.col("spans")), F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["end"]).alias("end"),
            (a["n"] + F.greatest(s["end"] - F.greatest(a["end"], s["start"]), F.lit(0))).alias("n"),
        ),
        lambda a: a["n"],
    )
    span = F.struct(F.col("start"), (F.col("start") + F.size("window")).alias("end"))
    words_hit = found.groupBy(*KEY).agg(F.collect_set(span).alias("spans")).select(*KEY, covered.cast("long").alias("n_hit"))
    by_item = found.select(*KEY, "window").distinct().join(windows.where(F.col("item_id").isNotNull()), "window")
    of_item = by_item.groupBy(*KEY).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    t = F.col(text)
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(t).alias("_text_hash"), F.size(words(t)).cast("long").alias("n_words"))
    out = sized
    for part in (words_hit, of_item):
        renamed = part.select(F.col("doc_id").alias("_d"), F.col("_text_hash").alias("_h"), *part.columns[2:])
        out = out.join(renamed, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_text_hash") == F.col("_h")), "left").drop("_d", "_h")
    return out.withColumns({
        "n_hit": F.coalesce("n_hit", F.lit(0).cast("long")),
        "items": F.coalesce("items", F.array().cast("array<string>")),
    })


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def digest(judged: DataFrame) -> DataFrame:
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without its contaminated rows; all columns stay."""
    bad = contamination(docs.select(doc_id, text), items, doc_id, text).where(contaminated())
    bad = bad.select(F.col("doc_id").alias("_bench_doc"), F.col("_text_hash").alias("_bench_hash")).distinct()
    return docs.join(bad, (F.xxhash64(F.col(text)) == F.col("_bench_hash")) & F.col(doc_id).eqNullSafe(F.col("_bench_doc")), "left_anti")
