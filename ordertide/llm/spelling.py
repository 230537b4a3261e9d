"""Spelling variants: words one edit apart, met by signatures of their letters.

A word's letters are a binary vector: one dimension for each letter and each number of its
occurrence, so that ``noon`` has n1 n2 o1 o2. One inserted or deleted letter changes one dimension,
one replaced letter two. The dimensions are dealt into ``PARTS`` parts; two vectors at a distance of
at most two differ in two parts at most, so they agree on the rest. A word emits a signature for
every choice of two parts left out, the hash of what it has in the others, and all words with a
near word share a signature with it. One edit also leaves the first three letters or the last four
alone, so a signature is emitted with each of those, which parts crowded signatures.

Words are joined on equal signatures and every pair met is checked by its edit distance within the
join; a distance of letters over two, read off a 64-bit vector, spares most of those checks.

A null or empty text has no words; a null id counts as an empty one. Repeated rows are counted
again. Words of any length are taken whole. Ties for a form go to the smaller word in code-point
order. Other columns of the table aren't read, so their names can't clash. An empty table gives no
rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import ascii_lower, durable, written

LEAST_LETTERS, LEAST_COUNT, FORM_TIMES, CUT_EVERY = 7, 2, 10, 31
#: Parts of the dimensions; letters at the two ends that go with a signature.
PARTS, FIRST, LAST = 5, 3, 4
RADIUS = 2


def words(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words of at least ``LEAST_LETTERS`` letters that occur ``LEAST_COUNT`` times or more.

    Of every run whose checksum ``CUT_EVERY`` divides, one letter is left out.
    """
    # Shorter runs can't give a word.
    runs = F.regexp_extract_all(ascii_lower(F.col(text)), F.lit(f"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}"), F.lit(0))
    each = df.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_doc"), F.explode(runs).alias("_run"))
    check, run = F.crc32(F.concat("_doc", F.lit(":"), "_run")), F.col("_run")
    at = (check % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    said = each.select(F.when(check % CUT_EVERY == 0, cut).otherwise(run).alias("word"))
    counted = said.where(F.char_length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def offsets(found: DataFrame) -> dict[str, int]:
    """By letter: the part of its first occurrence, dealt so that parts are about equally full. At most one row a letter is gathered."""
    letters = found.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter"))
    load, out = [0] * PARTS, {}
    for r in sorted(letters.groupBy("letter").count().collect(), key=lambda r: (-r["count"], r["letter"])):
        out[r["letter"]] = load.index(min(load))
        load[out[r["letter"]]] += r["count"]
    return out


def elements(word: Column, dealt: dict[str, int]) -> Column:
    """The vector's dimensions as (part, hash)."""
    deal = F.create_map(*[F.lit(x) for pair in dealt.items() for x in pair]) if dealt else None

    def occurrences(letter: Column) -> Column:
        n = F.char_length(word) - F.char_length(F.replace(word, letter, F.lit("")))
        first = F.coalesce(F.try_element_at(deal, letter), F.lit(0)) if deal is not None else F.lit(0)
        return F.transform(
            F.sequence(F.lit(1), n), lambda k: F.struct(F.pmod(first + k - 1, F.lit(PARTS)).alias("part"), F.xxhash64(letter, k).alias("hash"))
        )

    return F.flatten(F.transform(F.array_distinct(F.split(word, "")), occurrences))


def signatures(found: DataFrame, dealt: dict[str, int]) -> DataFrame:
    """(key, word, n, bits): a row for every signature of every word. ``bits`` is the vector folded to 64 dimensions."""
    xor = lambda pick: F.aggregate("_elements", F.lit(0).cast("long"), lambda acc, e: acc.bitwiseXOR(pick(e)))
    parts = [xor(lambda e, p=p: F.when(e["part"] == p, e["hash"]).otherwise(F.lit(0).cast("long"))).alias(f"_p{p}") for p in range(PARTS)]
    one = F.lit(1).cast("long")
    bits = F.aggregate(
        "_elements", F.lit(0).cast("long"), lambda acc, e: acc.bitwiseXOR(F.call_function("shiftleft", one, F.pmod(e["hash"], F.lit(64)).cast("int")))
    )
    rows = found.withColumn("_elements", elements(F.col("word"), dealt)).select("word", "n", bits.alias("bits"), *parts)
    ends = {0: F.left("word", F.lit(FIRST)), 1: F.right("word", F.lit(LAST))}
    keys = []
    for left_out in combinations(range(PARTS), RADIUS):
        kept = [f"_p{p}" for p in range(PARTS) if p not in left_out]
        keys += [F.xxhash64(F.lit(f"{left_out}{side}"), *kept, end) for side, end in ends.items()]
    return rows.select(F.explode(F.array(*keys)).alias("key"), "word", "n", "bits")


def near_pairs(found: DataFrame) -> DataFrame:
    """(a, na, b, nb), a < b in code-point order: words one edit apart, each pair once."""
    rows = signatures(found, offsets(found))
    left = rows.select("key", F.col("word").alias("a"), F.col("n").alias("na"), F.col("bits").alias("_abits"))
    right = rows.select("key", F.col("word").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("_bbits"))
    apart = F.bit_count(F.col("_abits").bitwiseXOR(F.col("_bbits")))
    met = left.join(right, "key").where((F.col("a") < F.col("b")) & (apart <= RADIUS) & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "na", "b", "nb").distinct()


def followed(forms: DataFrame, most: int) -> DataFrame:
    """(word, root): the last word that forms lead to, from (word, form).

    Each step leads to a word at least ``FORM_TIMES`` as frequent, so chains have at most the
    logarithm of ``most`` links; every round doubles the links followed.
    """
    links, reach = 0, LEAST_COUNT * FORM_TIMES
    while reach <= most:
        links, reach = links + 1, reach * FORM_TIMES
    rooted = forms.select("word", F.col("form").alias("root"))
    for _ in range((links - 1).bit_length() if links else 0):
        onward = rooted.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        rooted = durable(rooted.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root")))
    return rooted


def variants(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the table."""
    found = written(words(df, doc_id, text), "spelling-words")
    pairs = near_pairs(found)
    way = lambda w, n, o, m: F.struct(F.col(w).alias("word"), F.col(n).alias("n"), F.col(o).alias("other"), F.col(m).alias("m"))
    both = pairs.select(F.explode(F.array(way("a", "na", "b", "nb"), way("b", "nb", "a", "na"))).alias("_x")).select("_x.*")
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.first("n").alias("n"), F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("_best")
    )
    strong = -F.col("_best.less") >= FORM_TIMES * F.col("n")
    near = durable(best.select(
        "word", "n_near", F.when(strong, F.col("_best.other")).alias("form"), F.when(strong, -F.col("_best.less")).alias("form_n"),
    ))
    most = found.agg(F.max("n")).first()[0] or 0
    rooted = followed(near.where(F.col("form").isNotNull()).select("word", "form"), most)
    return found.join(near, "word", "left").join(rooted, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n",
    )
