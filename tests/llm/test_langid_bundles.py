"""op9 against plain loops: trigrams from text, rotation by index, products, sums and cosines, one document at a time."""

import math
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pyarrow.parquet as pq

import __spark_entry__ as entry
from ordertide.llm import langid

SF = "/root/testdata/sf0.001"
D = langid.DIMENSIONS


def plain_trigrams(text):
    letters = "".join(c if c.isalpha() else "\0" for c in (text or "").lower())
    if not letters.strip("\0"):
        return Counter()
    line = re.sub("\0+", "\0", f"\0{letters}\0")
    return Counter(line[i : i + 3] for i in range(len(line) - 2))


@cache
def plain_vector(trigram):
    a, b, c = (langid.letter_vector(ord(x)).astype(int) for x in trigram)
    return np.array([a[(d - 2) % D] * b[(d - 1) % D] * c[d] for d in range(D)], dtype=float)


def plain_bundle(weights):
    total = np.zeros(D)
    for trigram, weight in weights.items():
        total += weight * plain_vector(trigram)
    return total


def test_query_follows_plain_loops(spark):
    name = next(n for n in entry.queries() if n.startswith("op9_"))
    got = {r.doc_id: r for r in entry.queries()[name](spark, SF).collect()}
    rows = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows}
    weights = defaultdict(Counter)
    for r in rows:
        grams = plain_trigrams(r["text"])
        if r["lang"] is not None and not held[r["doc_id"]] and grams:
            size = sum(grams.values())
            for g, n in grams.items():
                weights[r["lang"]][g] += n / size
    learned = {}
    for lang in sorted(weights):
        v = plain_bundle(weights[lang])
        learned[lang] = v / math.sqrt(float((v * v).sum()))
    assert len(got) == len(rows) > 100 and len(learned) > 1
    told = Counter()
    for r in rows:
        mine, v = got[r["doc_id"]], plain_bundle(plain_trigrams(r["text"]))
        assert mine.held_out == held[r["doc_id"]]
        if not v.any():
            assert (mine.lang_pred, mine.score) == ("und", 0.0)
            continue
        cosines = {lang: float((v * p).sum()) / math.sqrt(float((v * v).sum())) for lang, p in learned.items()}
        best = max(cosines, key=cosines.get)
        second = max(c for lang, c in cosines.items() if lang != best)
        if cosines[best] - second > 1e-9:
            assert mine.lang_pred == best, (r["doc_id"], cosines)
        share = 1 / sum(math.exp(langid.SHARPNESS * (c - cosines[best])) for c in cosines.values())
        assert abs(mine.score - share) < 1e-6
        told[best] += 1
    assert len(told) > 1
