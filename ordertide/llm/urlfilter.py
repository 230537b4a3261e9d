"""URL filter: host and path rules first, then a blocked Bloom filter with an exact check behind it.

A rule names a host (with all its subdomains) and the start of a path; the longest fitting
rule decides. For the other urls a list decides: canonical urls that are listed are blocked.
The list is hashed into a blocked Bloom filter of at most ``MAX_BLOCKS`` rows of 256 bits,
so what is broadcast is bounded by that constant however long the list grows (a fuller filter
only passes more). Urls the filter passes are joined exactly with the list; the others never
enter a shuffle.

A null url, or one without ``://``, has an empty host and path, fits no rule and is on no
list, so it is allowed. Repeated rows are judged each on its own. Listed urls may repeat or
be null. Columns named host, path, rule or verdict are replaced by the results; all others pass
through. No pages give no rows, and an empty list blocks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import ascii_lower

#: (action, host, start of the path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
MIN_BLOCKS, MAX_BLOCKS = 1 << 8, 1 << 16
#: Listed urls per block of 256 bits: eight bits set by each leave about one false hit in 500.
PER_BLOCK = 20
WORDS = 4
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(host_: Column, path_: Column) -> Column:
    """Host without ``www.`` and path without closing slashes; no scheme, query or fragment."""
    return F.concat(F.regexp_replace(host_, r"^www\.", ""), F.regexp_replace(path_, "/+$", ""))


def _first_rule(host_: Column, path_: Column, rules, value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null."""
    cases = [
        F.when(((host_ == name) | host_.endswith("." + name)) & path_.startswith(start), F.lit(value((act, name, start))))
        for act, name, start in sorted(rules, key=lambda r: -len(r[1] + r[2]))
    ]
    return F.coalesce(*cases, F.lit(None).cast("string"))


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url, F.lit("block")), F.lit(blocks)).cast("int")


def _masks(url: Column) -> list[Column]:
    """Two bits in each of four words."""
    bits = F.xxhash64(url, F.lit("bits"))
    one = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(bits, 6 * k).bitwiseAND(63).cast("int"))
    return [one(2 * w).bitwiseOR(one(2 * w + 1)) for w in range(WORDS)]


def bloom_blocks(listed: DataFrame, url: str, blocks: int) -> DataFrame:
    """The filter as rows: block number and its four words; blocks with nothing in them are absent."""
    u = F.col(url)
    masked = listed.select(_block(u, blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(u))])
    return masked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def blocks_for(n_listed: int) -> int:
    """The power of two that gives each block about ``PER_BLOCK`` urls, within the bounds."""
    blocks = MIN_BLOCKS
    while blocks < MAX_BLOCKS and blocks * PER_BLOCK < n_listed:
        blocks *= 2
    return blocks


def judge(df: DataFrame, listed: DataFrame, url: str = "url", listed_url: str = "canonical", rules=RULES) -> DataFrame:
    """``df`` with host, path, rule and verdict. ``listed`` holds canonical urls to block."""
    keys = listed.where(F.col(listed_url).isNotNull()).select(F.col(listed_url).alias("_url_listed")).distinct()
    blocks = blocks_for(keys.count())
    parted = df.withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
    h, p = F.col("host"), F.col("path")
    ruled = parted.withColumns({
        "rule": _first_rule(h, p, rules, lambda r: r[1] + r[2]),
        "_url_by_rule": _first_rule(h, p, rules, lambda r: r[0]),
    }).withColumn("_url_key", F.when(F.col("rule").isNull() & (h != ""), canonical(h, p)))
    words = [f"_url_w{i}" for i in range(WORDS)]
    bloom = bloom_blocks(keys, "_url_listed", blocks).select(F.col("block").alias("_url_block"), *[
        F.col(f"w{i}").alias(words[i]) for i in range(WORDS)
    ])
    probed = ruled.withColumn("_url_block", F.when(F.col("_url_key").isNotNull(), _block(F.col("_url_key"), blocks)))
    probed = probed.join(F.broadcast(bloom), "_url_block", "left")
    passes = F.lit(True)
    for word, mask in zip(words, _masks(F.col("_url_key")), strict=True):
        passes = passes & (F.col(word).bitwiseAND(mask) == mask)
    probed = probed.withColumn("_url_passes", F.coalesce(passes, F.lit(False)))
    hits = probed.where("_url_passes").join(keys, F.col("_url_key") == F.col("_url_listed"), "left")
    misses = probed.where("not _url_passes").withColumn("_url_listed", F.lit(None).cast("string"))
    verdict = F.coalesce("_url_by_rule", F.when(F.col("_url_listed").isNotNull(), F.lit("block")), F.lit("allow"))
    out = hits.unionByName(misses).withColumn("verdict", verdict)
    return out.drop("_url_by_rule", "_url_key", "_url_block", "_url_passes", "_url_listed", *words)


def spam_list(pages: DataFrame, url: str = "url", word: str = "spam") -> DataFrame:
    """Canonical urls of all pages whose host has a label that starts with ``word``."""
    h = host(F.col(url))
    return pages.where(h.rlike(rf"(^|[.-]){word}")).select(canonical(h, path(F.col(url))).alias("canonical"))
