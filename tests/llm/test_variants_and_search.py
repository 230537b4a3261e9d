"""Spelling variants, exact top-k search and hard negatives: brute force and odd rows."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordertide.llm import hardneg, spelling, topk, vertical

VECTORS = "vec_id long, embedding array<double>, label int"


# --- spelling variants -------------------------------------------------------

def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def brute_variants(docs):
    import re

    n = Counter()
    for doc_id, text in docs:
        lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for run in re.findall("[a-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    n = {w: k for w, k in n.items() if k >= 2}
    near = {w: sorted((x for x in n if one_edit(w, x)), key=lambda x: (-n[x], x)) for w in n}
    form = {w: xs[0] if xs and n[xs[0]] >= 10 * n[w] else None for w, xs in near.items()}
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return out


def found_variants(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df).collect()}


def edited(rng, word, alphabet):
    k = rng.randrange(len(word))
    return rng.choice([word[:k] + word[k + 1:], word[:k] + rng.choice(alphabet) + word[k + 1:], word[:k] + rng.choice(alphabet) + word[k:]])


def test_variants_match_brute_force_on_crowded_words(spark):
    """Few letters, so signatures are crowded; chains of forms; letters beyond ASCII; edits at every place."""
    rng = random.Random(5)
    words = ["abcabcabc", "straßenbahn", "ÀÉÎÕÜàéîõü", "aaaaaaaa", "x" * 300, "noonnoon"]
    bag = [w for w in words for _ in range(400)]
    for w in words:
        for _ in range(40):
            v = edited(rng, w, "abcßé×")
            bag += [v] * rng.choice([1, 2, 4, 39])
            bag += [edited(rng, v, "abc")] * 3
    rng.shuffle(bag)
    docs = [(k, " ".join(bag[k::50])) for k in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    expected = brute_variants(docs)
    assert found_variants(df) == expected
    assert any(form and root != form for form, root, *_ in expected.values())


def test_variants_of_odd_tables(spark):
    rows = [(1, None), (2, ""), (None, "Wörtlich wörtlich"), (3, "wÖrtlich WORDING"), (3, "wÖrtlich WORDING"), (4, "short words only go"), (5, "b" * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_variants(df) == brute_variants(rows)
    assert found_variants(df.limit(0)) == {}
    assert found_variants(df.where("doc_id < 3")) == {}
    assert found_variants(df.unionAll(df)) == brute_variants(rows * 2)


def test_pairs_of_one_edit_share_a_signature(spark):
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyzéü"
    pairs = [(w, edited(rng, w, letters)) for w in ("".join(rng.choices(letters, k=rng.randrange(8, 13))) for _ in range(300))]
    words = spark.createDataFrame([(w, 2) for w in sorted({x for p in pairs for x in p})], "word string, n long")
    found = {(r.a, r.b) for r in spelling.near_pairs(words).collect()}
    assert {tuple(sorted(p)) for p in pairs if p[0] != p[1]} <= found
    assert all(one_edit(a, b) for a, b in found)


# --- vectors -----------------------------------------------------------------

def whole(rows, scale):
    """(row, id, components, label) of the rows that take part, by plain numbers."""
    out = []
    for k, (vec_id, v, label) in enumerate(rows):
        if vec_id is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            out.append((k, vec_id, [int(np.floor(scale * x)) for x in v], label))
    return out


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_top(rows, k, scale, every):
    own = whole(rows, scale)
    out = Counter()
    for q in own:
        if q[1] % every == 0:
            best = sorted((-dot(q[2], c[2]), c[1]) for c in own if c[0] != q[0] and len(c[2]) == len(q[2]))[:k]
            out.update((q[1], n + 1, c, -s) for n, (s, c) in enumerate(best))
    return out


def brute_negatives(rows, scale, every):
    own = [r for r in whole(rows, scale) if r[3] is not None]
    out = Counter()
    for a in own:
        if a[1] % every:
            continue
        scored = [(-dot(a[2], c[2]), c[1], c[0], c[3]) for c in own if c[0] != a[0] and len(c[2]) == len(a[2])]
        for p in sorted(s for s in scored if s[3] == a[3])[:5]:
            fit = sorted(s for s in scored if s[3] != a[3] and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0])[:3]
            out.update((a[1], p[1], n + 1, s[1], -p[0], -s[0]) for n, s in enumerate(fit))
    return out


def clustered(n, d=24, seed=1):
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(6, d))
    return [(k, [float(x) for x in heads[k % 6] + rng.normal(size=d) * (0.1 + k % 5)], int(k // 3 % 4)) for k in range(n)]


ODD = [
    (None, [1.0, 2.0], 1), (100, None, 1), (200, [1.0, None], 1), (300, [float("nan"), 1.0], 2), (400, [float("inf"), 1.0], 2),
    (0, [0.0, 0.0], 1), (50, [1.0, 1.0], 1), (50, [1.0, 1.0], 1), (51, [1.0, 1.0], 1), (52, [0.7, 0.7], 2), (53, [0.7, 0.7], 2), (54, [0.7, 0.7], 2),
    (55, [0.7, 0.7], 3), (60, [-1.0, -1.0], None), (500, [], 1), (501, [], 1), (502, [], 2), (-40, [1.0], 1), (-20, [-1.0], 1), (40, [2.0**40, 1.0], 2),
    (600, [0.9], None),
]


@pytest.fixture(params=["clustered", "odd"])
def rows(request):
    return clustered(420) if request.param == "clustered" else ODD


@pytest.fixture(params=["one tile", "many tiles"])
def sized(request, monkeypatch):
    if request.param == "many tiles":
        monkeypatch.setattr(vertical, "BLOCK_NUMBERS", 200)
        for name in ("tiles",):
            monkeypatch.setattr(vertical, name, lambda r, label=None, made=vertical.tiles: made(r, label, 600))


def vectors(spark, rows):
    df = spark.createDataFrame(rows, VECTORS)
    for name in ("row", "d", "v", "id", "tile", "ids", "score", "rank", "block"):
        df = df.withColumn(name, F.lit(name))
    return df


def test_top_k_matches_brute_force(spark, rows, sized):
    got = Counter(tuple(r) for r in topk.search(vectors(spark, rows), k=7, every=10).collect())
    assert got == brute_top(rows, 7, 64, 10)


def test_negatives_match_brute_force(spark, rows, sized):
    got = Counter(tuple(r) for r in hardneg.mine(vectors(spark, rows)).collect())
    expected = brute_negatives(rows, 256, 50)
    assert got == expected and (rows is ODD or len(got) > 20)


def test_vector_searches_of_an_empty_table(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert topk.search(empty).columns == ["query_id", "rank", "vec_id", "score"] and topk.search(empty).count() == 0
    assert hardneg.mine(empty).count() == 0
    assert hardneg.mine(hardneg.moved_labels(spark.createDataFrame(ODD[:5], VECTORS))).count() == 0


def test_search_drops_candidates_before_the_last_dimension(monkeypatch):
    """Columns read shrink from step to step, and an anchor's largest dimensions come first."""
    rng = np.random.default_rng(2)
    m = np.vstack([rng.normal(size=(500, 64)) * 5, np.full((20, 64), 90.0)]).round().astype(np.int64)
    packed = {"ids": range(520), "rows": range(520), "labels": [0] * 520, "columns": np.ascontiguousarray(m.T).tobytes()}
    left = []
    tile = vertical.Tile(packed, 64)
    at, scores = hardneg.resolved(tile, m[519], np.arange(520), lambda lower, upper: left.append(len(lower)) or upper >= np.sort(lower)[-20])
    assert sorted(at) == list(range(500, 520)) and set(scores) == {64 * 8100}
    assert left[0] == 520 and left[-1] == 20
    [(best, found)] = topk.tile_best(m[519:], np.array([519]), tile, 5, least := np.full(1, -np.inf))
    assert list(best) == [500, 501, 502, 503, 504] and set(found) == {64 * 8100} and least[0] > 0
