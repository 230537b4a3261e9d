"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordertide.llm import chat, components, decontam, langid, packing, pcadedup, pitmanyor, secrets, simhash, urlfilter, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the quick brown fox " * 60_000


def docs(spark, *texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t in texts], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Null id, null and empty text, a long text, a repeated row, and columns whose names operators use inside."""
    rows = docs(spark, (None, "one two three four"), (1, None), (2, ""), (3, LONG), (4, "same words here"), (4, "same words here"), (5, None))
    for name in ("fp", "_id", "_d", "_h", "id", "key", "part", "start", "items", "w", "spans", "component_id", "length"):
        rows = rows.withColumn(name, F.lit(name))
    return rows


@pytest.fixture(scope="module")
def none(spark):
    return docs(spark).limit(0)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


# --- secrets -----------------------------------------------------------------

TOKEN = "ghp_" + (body := "zQWBuTSOoRi4A9spHcVY5ncnsDkxkJ") + secrets.checksum62(body)


@pytest.mark.parametrize("text, spans", [
    (None, []), ("", []), ("token=short", []), ("Api_Key : 'abcdefgh'", [("assign", 0, 19)]),
    ("é token=abcdefgh", [("assign", 2, 16)]),
    ("token=secret=abcdefgh", [("assign", 0, 21)]),
    ("\u017fecret=abcdefgh to\u212aen=abcdefgh", []),  # letters that only lower-casing makes an s and a k
    ("AKIA" + "A" * 11, []), ("xAKIA" + "A" * 12, [("access", 1, 17)]),
    ("g" + "a" * 31, []), ("g" + "a" * 32 + "g", [("hex", 1, 33)]), ("a" * 31 + "g" + "b" * 40, [("hex", 32, 72)]),
    (TOKEN, [("github", 0, 40)]), (TOKEN[:-1] + "0", []), (TOKEN + "x", []),
    ("token=" + "a" * 32, [("assign", 0, 38), ("hex", 6, 38)]),
])
def test_spans(text, spans):
    assert secrets.find_spans(text) == spans


def test_spans_match_plain_patterns():
    rng = random.Random(3)
    parts = ["token", "=", " ", "'", "api_key", ":", "AKIA", "A" * 9, "a" * 15, "f" * 17, "password", "x", "\n", "SECRET", "é"]
    plain = {
        "assign": (secrets.ASSIGN, lambda m: len(m[2]) >= 8), "access": (secrets.ACCESS, lambda m: len(m[0]) >= 16),
        "hex": (secrets.HEX, lambda m: len(m[0]) >= 32),
    }
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        wanted = [(k, m.start(), m.end()) for k, (p, ok) in plain.items() for m in p.finditer(text) if ok(m)]
        assert [s for s in secrets.find_spans(text) if s[0] in plain] == sorted(wanted, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_checksum_of_a_published_token():
    assert secrets.checksum62("zQWBuTSOoRi4A9spHcVY5ncnsDkxkJ") == "0mLq17"


def test_secret_scan_of_odd_rows(spark, odd, none):
    found = secrets.digest(secrets.scan(odd)).collect()
    assert len(found) == 7 and all(r.n_assign == 0 and r.spans == "" for r in found)
    assert secrets.digest(secrets.scan(none)).count() == 0
    red = by_id(secrets.redact(docs(spark, (1, "a token=abcdefgh " + "f" * 32 + " z"), (2, None))))
    assert red[1].text == "a [secret] [secret] z" and red[2].text is None


def test_sql_finds_checked_tokens_too(spark, tmp_path):
    import duckdb

    from ordertide.llm import oracle

    texts = [TOKEN + " and " + TOKEN, "npm_" + TOKEN[4:] + ", " + TOKEN[:-1] + "0", "x\x01token=abcdefgh"]
    rows = docs(spark, *enumerate(texts))
    rows.write.parquet(f"{tmp_path}/d")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    told = {r[0]: r[1:] for r in con.execute(oracle.statements()["op1_secret_scan"]).fetchall()}
    found = {r.doc_id: tuple(r[1:]) for r in secrets.digest(secrets.scan(rows)).collect()}
    assert told == found and found[0][-1] == "github:0:40,github:45:85"


# --- scoring -----------------------------------------------------------------

def test_score_of_odd_rows(odd, none):
    found = pitmanyor.score(odd).collect()
    assert len(found) == 7
    assert all(r.n_tokens == 1 for r in found if r.doc_id in (1, 2, 5))
    assert pitmanyor.score(none).count() == 0
    unseen = pitmanyor.score(odd, held=F.lit(True)).collect()
    assert all((r.train_tokens, r.n_known) == (0, 0) and np.isfinite(r.score) for r in unseen)


def test_spelling_model_is_a_distribution(spark):
    words = ["the", "then", "than", "ten", "net", "tent"]
    grams = [(g[:-1], g[-1], n) for w, n in zip(words, (40, 9, 5, 3, 2, 1), strict=True) for g in pitmanyor.spelled(w)]
    p = pitmanyor.fit(spark.createDataFrame(grams, "u string, w string, n long").groupBy("u", "w").agg(F.sum("n").alias("n")), 0)
    sums = {r.u: r.p for r in p.groupBy("u").agg(F.sum("p").alias("p")).collect()}
    # What is missing from one goes to letters that never followed.
    assert all(0 < x <= 1 + 1e-9 for x in sums.values())
    assert sums[""] > 0.8


def test_restaurant_probabilities_sum_to_one():
    c, base = np.array([5000, 500, 3, 0, 2, 0]), np.array([0.5, 0.2, 0.2, 0.1, 0.6, 0.4])
    alpha, beta, tables, mean = pitmanyor.gibbs(c, base, np.array([0, 0, 0, 0, 1, 1]), 0.6, 1.0, [1])
    for own in (slice(0, 4), slice(4, 6)):
        assert (alpha[own] + beta[own] * base[own]).sum() == pytest.approx(1.0)
    assert tables[2] in (1, 2, 3) and tables[3] == 0 and tables[0] > tables[2] and mean[4] >= 1


def test_blocks_are_drawn_as_single_moves_would():
    """The table counts drawn at once against those of many single Gibbs moves."""
    rng, draws = random.Random(9), np.random.default_rng(9)
    at_once = pitmanyor.draw_tables(np.full(4000, 12), np.full(4000, 1.7), 0.5, draws)
    sizes, counts = pitmanyor.seat(12, 1.7, 0.5, rng, draws), []
    for k in range(60_000):
        pitmanyor._leave(sizes, 12, rng)
        pitmanyor._sit(sizes, 11, 1.7, 0.5, rng)
        if k % 12 == 0:
            counts.append(len(sizes))
    assert at_once.mean() == pytest.approx(np.mean(counts), rel=0.03)
    assert at_once.std() == pytest.approx(np.std(counts), rel=0.08)


def test_seating_in_groups_agrees_with_one_by_one(monkeypatch):
    told = []
    for few in (16, 10_000):
        monkeypatch.setattr(pitmanyor, "FEW", few)
        rng, draws = random.Random(7), np.random.default_rng(7)
        sizes = [pitmanyor.seat(400, 3.0, 0.5, rng, draws) for _ in range(500)]
        assert all(sum(s) == 400 for s in sizes)
        told.append((np.mean([len(s) for s in sizes]), np.mean([max(s) for s in sizes])))
    assert told[0] == pytest.approx(told[1], rel=0.06)


# --- WARC --------------------------------------------------------------------

def test_warc_records_read_back(spark):
    html = "<html><head><title>A &amp; B</title></head><body><p>x<p>y &lt;é\r\n<script>var a='</p>'</script><!-- no --><a href='/q'>z</a>"
    pages = spark.createDataFrame([(1, "http://a/b", html), (2, None, None), (3, "http://c", ""), (3, "http://c", "")], "page_id long, url string, html string")
    records = warc.derive(warc.responses(pages.withColumn("block", F.lit(1))))
    rows = records.withColumn("raw", warc.serialised()).collect()
    assert len(rows) == 8
    for r in rows:
        headers, block = warc.parse(r.raw)
        assert block == r.block and headers["WARC-Type"] == r.warc_type
        assert headers["WARC-Refers-To"] == r.refers_to and headers["WARC-Block-Digest"] == warc.digest(block.encode())
        assert headers.get("WARC-Target-URI") == r.target_uri
        assert headers["WARC-Source-HTTP-Header"] == r.source_headers.rstrip("\r\n")
    first = {r.warc_type: r.block for r in rows if r.page_id == 1}
    assert first["conversion"] == "x\ny <é\nz"
    assert "title: A & B\r\n" in first["metadata"] and "outlinks: 1\r\n" in first["metadata"]
    assert warc.derive(warc.responses(pages.limit(0))).count() == 0


def test_open_quotes_and_tags_stay_cheap():
    assert len(warc.visible_text('<a "' * 100_000)) > 0
    assert warc.visible_text("a<script>b") == "a"
    open_head = "<html><head><title>T</title><style>p {}</style><meta charset=x><body><p>Hello all</p><script>no</script>"
    assert warc.visible_text(open_head) == "Hello all"
    assert warc.visible_text(open_head.replace("<body>", "")) == "Hello all"
    assert warc.visible_text(open_head.replace("<meta", "</head><meta")) == "Hello all"
    assert warc.visible_text("<noscript>a<p>b<template>c") == "a\nbc"
    assert warc.visible_text("a<!-- <head> -->b<HEAD>x</HEAD >c<!-- d") == "a b c"
    assert warc.visible_text("<template>a" * 100_000) == "a" * 100_000


# --- SimHash -----------------------------------------------------------------

def test_simhash_of_odd_rows(odd, none):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == 7
    assert {r.component_id for r in found if r.doc_id in (1, 2, 5)} == {1}
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 1, 3, 4] and all(r._id == "_id" for r in rows)
    assert simhash.keep_one(none).count() == 0


def test_links_are_those_within_the_radius(spark):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    prints = {simhash.as_long(s ^ sum(1 << b for b in rng.sample(range(64), k))) for s in seeds for k in (0, 1, 2, 3, 4) for _ in range(4)}
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2
    df = spark.createDataFrame([(p, i) for i, p in enumerate(sorted(prints))], "fp long, doc_id long")
    wanted = [(a, b) for a, b in itertools.combinations(sorted(prints), 2) if near(a, b)]
    found = simhash.links(df).collect()
    assert found and all(near(r.a, r.b) for r in found)
    root = {p: p for p in prints}
    for _ in prints:
        for a, b in wanted:
            root[a] = root[b] = min(root[a], root[b])
    comp = {r.node: r.component for r in components.components(simhash.links(df)).collect()}
    assert {p: comp.get(p, p) for p in prints} == root


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{k: 100 for k in range(100, 160)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- urls --------------------------------------------------------------------

def test_urls(spark):
    urls = [
        "https://a.net/x", "http://Sub.EXAMPLE.net/en/1", "http://example.net/en", "//no", None, "", "x://h?q#f", "u://example.com/de/?a://b",
        "http://x.org/fr/9", "http://www.listed.org/a/?utm=1", "http://listed.org/a", "http://listed.org/ab", "http://net/", "http://net",
    ]
    pages = spark.createDataFrame([(i, u, "keep") for i, u in enumerate(urls)], "page_id long, url string, block string")
    listed = spark.createDataFrame([("listed.org/a",), ("listed.org/a",), (None,)], "canonical string")
    got = {r.page_id: r for r in urlfilter.judge(pages, listed).collect()}
    assert [got[i].verdict for i in range(len(urls))] == [
        "block", "allow", "block", "allow", "allow", "allow", "allow", "block", "allow", "block", "block", "allow", "block", "allow",
    ]
    assert (got[1].host, got[1].path, got[1].rule) == ("sub.example.net", "/en/1", "example.net/en/")
    assert (got[6].host, got[6].path) == ("h", "") and got[4].host == "" and got[0].block == "keep"
    assert urlfilter.judge(pages.limit(0), listed).count() == 0
    clash = pages
    for name in ("host", "path", "rule", "verdict", "canonical", "w0"):
        clash = clash.withColumn(name, F.lit("mine"))
    again = {r.page_id: r for r in urlfilter.judge(clash, listed).collect()}
    assert all(tuple(again[k][c] for c in ("host", "path", "rule", "verdict")) == tuple(r[c] for c in ("host", "path", "rule", "verdict")) for k, r in got.items())
    assert {(r.block, r.canonical, r.w0) for r in again.values()} == {("keep", "mine", "mine")}
    assert {r.verdict for r in urlfilter.judge(pages, listed.limit(0)).where("rule is null").collect()} == {"allow"}


def test_full_filter_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "MAX_BLOCKS", 1 << 8)
    urls = spark.range(60_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.io/"), "id").alias("url"))
    listed = urls.where("page_id % 2 = 0").select(F.concat(F.lit("h.io/"), "page_id").alias("canonical"))
    got = urlfilter.judge(urls, listed)
    assert got.where((F.col("verdict") == "block") != (F.col("page_id") % 2 == 0)).count() == 0


# --- packing -----------------------------------------------------------------

def test_packing_of_odd_rows(odd, none):
    found = packing.pack(odd).collect()
    assert sum(r.length for r in found if r.doc_id in (1, 2, 5)) == 3
    assert len([r for r in found if r.doc_id == 4]) == 2
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        assert [o for o, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 1024
    assert packing.pack(none).count() == 0


def test_sequences_hold_the_ids(spark):
    tk = packing.tokenizer(packing.vocabulary_path())
    texts = {1: "some words " * 900, 2: "few", 3: "a<|endoftext|>b"}
    packed = packing.pack(docs(spark, *texts.items()), keep_ids=True)
    got = packing.assemble(packed).collect()
    wanted = [i for t in texts.values() for i in [*tk.tokenizer.encode(t, add_special_tokens=False).ids, 2]]
    assert sorted(i for r in got for i in r.ids) == sorted(wanted)
    assert 50256 in wanted and all(len(r.ids) <= 1024 for r in got)


def test_runs_give_the_tokenizers_ids():
    tk = packing.tokenizer(packing.vocabulary_path(), packing.vocabulary_path(packing.RANKS))
    rng, alphabet = random.Random(1), ["a", "B", "é", "漢", " ", "  ", "\n", "\t", "\r", "\u00a0", "\u2003", "'", "'s", "1", ".", ",", "\x1c", "\x85", "<|endoftext|>"]
    for _ in range(5000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 14)))
        ids = np.array(tk.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        assert tk.encode(text) == ids.tobytes()


def fewest(items, capacity):
    """The least number of bins, by trying all."""
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                go(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1 :]])
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def test_plan_is_optimal_on_small_cases():
    from collections import Counter

    rng = random.Random(2)
    for _ in range(150):
        items = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 9))), reverse=True)
        counts = dict(Counter(items))
        patterns = packing.plan(counts, 20)
        used = Counter()
        for p, n in patterns:
            assert sum(p) <= 20
            used.update({k: n * m for k, m in Counter(p).items()})
        assert used == Counter(items)
        assert sum(n for _, n in patterns) == fewest(items, 20) >= packing.lower_bound(counts, 20)


# --- chat --------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def test_chat_examples(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\nhi", "<\\|im_end|> [\\\\INST]", "", None, "<|endoftext|><s>[/INST]\\"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(nasty)] + [
        (1, 6, "tool\n\\n", "tail"), (2, 0, "user", "alone"), (2, 0, "user", "alone"), (None, None, None, None), (3, 1, "assistant", "b"), (3, 0, "assistant", "a"),
    ]
    turns = spark.createDataFrame(rows, TURNS)
    examples = chat.expand(turns)
    back = {r.conv_id: r for r in chat.read_back(examples).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [(r[2], r[3] or "") for r in rows[:7]]
    assert back[1].loss == "".join((t or "") for t in nasty[1::2])
    assert [(t.role, t.text) for t in back[2].turns] == [("user", "alone")] * 2 and back[2].loss == ""
    assert [(t.role, t.text) for t in back[None].turns] == [("", "")]
    assert back[3].loss == "ab"
    full = chat.materialise(examples).orderBy("conv_id", "example").collect()
    assert len(full) == 5
    for r in full:
        if r.conv_id == 1:
            assert (r.context + r.target) in back[1].formatted and r.context.endswith("assistant\n")
    assert full[-1].context.count("<|im_start|>") == 2
    loss = lambda rows: {r.conv_id: r.loss for r in chat.read_back(rows).collect()}
    assert any(loss(examples).values())
    for column in ("context_chars", "n_context_turns"):
        assert not any(loss(examples.withColumn(column, F.col(column) + 1)).values())
    assert chat.digest(chat.expand(turns.limit(0))).count() == 0


def test_long_conversation_stays_linear(spark):
    turns = spark.range(6000).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 1, "assistant").otherwise("user").alias("role"), F.lit("x" * 50).alias("text"),
    )
    r = chat.digest(chat.expand(turns)).first()
    assert (r.n_turns, r.loss_chars) == (6000, 150_000) and r.formatted_chars < 600_000


# --- decontamination ---------------------------------------------------------

def test_decontamination_of_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "same words"), (1, "same words"), (2, None), (3, " .,"), (None, "quick"), (12, "Brown  FOX")], "item_id long, text string")
    found = decontam.digest(decontam.contamination(odd, items)).collect()
    assert len(found) == 7
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in found}
    assert got[1] == got[2] == (0, 0, 0, False)
    assert got[3] == (240_000, 180_000, 1, True) and got[4] == (3, 2, 1, True) and got[None] == (4, 0, 0, False)
    kept = decontam.decontaminate(odd, items)
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 5] and kept.columns == odd.columns
    assert decontam.contamination(none, items).count() == 0
    assert decontam.contamination(odd, items.limit(0)).where("n_hit = 0").count() == 7


@pytest.mark.parametrize("limit", [decontam.MAX_BROADCAST, 0])
def test_decontamination_matches_brute_force(spark, limit):
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choices("abcd", k=n))
    bench = [(i, text(rng.choice([0, 1, 2, 5, 12, 13, 14, 30]))) for i in range(12)]
    given = []
    for i in range(40):
        t = text(rng.choice([0, 3, 12, 20, 300, 600]))
        if i % 3 == 0:
            t = f"{t} {bench[rng.randrange(12)][1]} {text(5)}"
        given.append((i, t))
    found = {r.doc_id: (r.n_hit, r["items"]) for r in decontam.contamination(
        docs(spark, *given), spark.createDataFrame(bench, "item_id long, text string"), limit=limit).collect()}
    for i, t in given:
        w, hit, items = t.split(), set(), set()
        for k, b in bench:
            bw = b.split()
            n = min(13, len(bw))
            for s in range(len(bw) - n + 1 if n else 0):
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == bw[s : s + n]:
                        hit |= {*range(at, at + n)}
                        items.add(str(k))
        assert found[i] == (len(hit), sorted(items)), i


# --- language ----------------------------------------------------------------

def test_language_of_odd_rows(spark, odd, none):
    texts = [(i, t) for i in range(12) for t in ["the house and the garden"]]
    train = docs(spark, *texts).unionByName(docs(spark, *[(i + 20, "la casa y el jardín") for i, _ in texts], lang="es"))
    train = train.unionByName(spark.createDataFrame([(50, "unlabelled", None, "s", 1)], DOCS))
    learned = langid.learn(train)
    assert sorted(learned) == ["en", "es"]
    told = langid.identify(docs(spark, (1, None), (2, "12 ,."), (3, "THE house"), (4, "el jardín"), (5, "the house and " * 300_000)), learned)
    got = {r.doc_id: r.predicted for r in told.collect()}
    assert [got[i].lang for i in range(1, 6)] == ["und", "und", "en", "es", "en"] and got[1].score == 0
    assert langid.identify(none, learned).count() == 0
    assert langid.learn(none) == {} and langid.identify(odd, {}).where("predicted.lang <> 'und'").count() == 0
    assert {r.predicted.lang for r in langid.identify(odd, langid.learn(train)).collect()} <= {"en", "es", "und"}


def test_trigrams_do_not_depend_on_slices(monkeypatch):
    text = "Ab1 cé.. d" * 50
    whole = langid.trigrams(text)
    monkeypatch.setattr(langid, "TEXT_SLICE", 7)
    assert all((a == b).all() for a, b in zip(whole, langid.trigrams(text), strict=True))


# --- embeddings --------------------------------------------------------------

def test_embedding_dedup_matches_brute_force(spark):
    rng = np.random.default_rng(6)
    rows, centres = [], rng.normal(size=(6, 12))
    for i in range(160):
        v = centres[i % 6] + rng.normal(size=12) * rng.choice([0.0, 0.05, 0.1, 0.6])
        rows.append((i, [float(x) for x in np.float32(v * rng.choice([1.0, 3.0]))], int(i % 2)))
    rows += [(200, None, 1), (201, [0.0] * 12, 1), (202, [float("nan")] * 12, 1), (203, rows[0][1], None), (204, rows[0][1], 0), (204, rows[0][1], 0)]
    rows += [(205, [1.0, None], 0), (206, [float("inf")] + [0.0] * 11, 0), (207, [1.0, 0.0], 0), (208, [2.0, 0.0], 0), (209, [], 0), (None, rows[1][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit("x"))
    unit = {}
    for k, (_, v, label) in enumerate(rows):
        if v and label is not None and None not in v and np.isfinite(v).all() and np.any(v):
            unit[k] = np.array(v, dtype=float) / np.linalg.norm(v)
    linked = {k: [] for k in range(len(rows))}
    for a, b in itertools.combinations(unit, 2):
        if rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98:
            linked[a].append(b)
            linked[b].append(a)

    def reach(k):
        seen, todo = {k}, [k]
        while todo:
            for n in linked[todo.pop()]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        ids = [rows[n][0] for n in seen if rows[n][0] is not None]
        return min(ids) if ids else None

    wanted = sorted(((rows[k][0], len(linked[k]), reach(k)) for k in range(len(rows))), key=str)
    for tile in (1024, 7):
        found = pcadedup.near_duplicates(df, tile=tile).collect()
        assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == wanted
        assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in found)
    assert pcadedup.near_duplicates(df.limit(0)).count() == 0


def test_chat_read_back_reads_the_written_examples(spark, monkeypatch):
    import hashlib

    turns = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b")], TURNS)
    examples = chat.expand(turns)
    written_out = chat.materialise
    monkeypatch.setattr(chat, "materialise", lambda e: written_out(e).withColumn("target", F.upper("target")))
    r = chat.digest(examples).first()
    assert r.loss_chars == 2 and r.loss_sha256 == hashlib.sha256(b"AB").hexdigest()
