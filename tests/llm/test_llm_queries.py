"""Registered queries of the subpackage on whole small tables, against SQL or a second way to the result."""

import math
import re
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest
import xxhash

import __spark_entry__ as entry
from ordertide.llm import catalog, oracle
from oracle_check import compare, duck
from test_resemblance import brute_pairs, brute_set

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.registered(), oracle.statements()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def rows_of(table):
    return pq.read_table(f"{SF}/{table}.parquet").to_pylist()


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def test_all_operators_and_the_pipeline_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(entry.queries()) >= {*QUERIES, "pipeline"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL[name], SF) > 0


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def brute_fingerprint(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", lower(text or "")) if x]
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    ones = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        ones.update(k for k in range(64) if h >> k & 1)
    return sum(1 << k for k in range(64) if 2 * ones[k] > len(shingles))


def brute_components(docs):
    prints = {d["doc_id"]: brute_fingerprint(d["text"]) for d in docs}
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    return prints, union_find(ids, links)


def test_simhash_matches_brute_force(spark):
    prints, roots = brute_components(rows_of("documents"))
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op4_simhash_near_dedup"](spark, SF).collect()}
    assert found == {k: (f"{p:016x}", roots[k]) for k, p in prints.items()}
    assert len(set(roots.values())) < len(roots)


def test_score_matches_brute_force_and_beats_the_base(spark):
    docs = rows_of("documents")
    found = {r.doc_id: r for r in QUERIES["op2_pitman_yor_score"](spark, SF).collect()}
    tokens = {d["doc_id"]: [x for x in re.split("[\x20\x09-\x0d]+", lower(d["text"] or "")) if x] + ["\n"] for d in docs}
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k in tokens}
    c = Counter(t for k, ts in tokens.items() if not held[k] for t in ts)
    total, distinct = sum(c.values()), len(c)
    sums = defaultdict(float)
    for k, ts in tokens.items():
        r = found[k]
        base = sum(math.log10((c[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in ts)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[k], len(ts), sum(c[t] > 0 for t in ts), total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
        if held[k]:
            sums["base"] += base
            sums["own"] += r.score
    assert sums["own"] > sums["base"]


def check_packing(docs, placed, encode):
    """Every piece is right, sequences are gapless and full, and there are few of them."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in placed:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == {d["doc_id"] for d in docs}
    for d in docs:
        ids, at = encode(d["text"] or "") + [2], 0
        own = sorted(by_doc[d["doc_id"]], key=lambda r: r.piece)
        for k, r in enumerate(own):
            data = b"".join(i.to_bytes(4, "little") for i in ids[r.start : r.start + r.length])
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(data))
            assert r.length == 1024 or k == 0
            at += r.length
        assert at == len(ids)
        assert len(own) == -(-len(ids) // 1024)
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    return len(by_sequence), -(-sum(r.length for r in placed) // 1024)


@pytest.fixture(scope="module")
def encode():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_is_right_and_tight(spark, encode):
    used, least = check_packing(rows_of("documents"), QUERIES["op6_best_fit_packing"](spark, SF).collect(), encode)
    assert used <= least * 1.02 + 1


def test_language_accuracy_on_held_out_texts(spark):
    docs = {d["doc_id"]: d for d in rows_of("documents")}
    found = QUERIES["op9_language_id"](spark, SF).collect()
    assert len(found) == len(docs)
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {k for k in docs if zlib.crc32(str(k).encode()) % 4 == 2}
    right = sum(r.lang_pred == docs[r.doc_id]["lang"] for r in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


class Visible(HTMLParser):
    """Visible words by an event parser, for comparison."""

    SKIP = {"script", "style", "noscript", "template", "head"}

    def __init__(self):
        super().__init__()
        self.hidden, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in self.SKIP

    def handle_endtag(self, tag):
        self.hidden -= tag in self.SKIP

    def handle_data(self, data):
        if not self.hidden:
            self.words.append(data)


def test_warc_derivatives_match_an_event_parser(spark):
    pages = {p["page_id"]: p for p in rows_of("pages")}
    found = QUERIES["op3_warc_derivatives"](spark, SF).collect()
    assert Counter(r.warc_type for r in found) == {"metadata": len(pages), "conversion": len(pages)}
    sources = defaultdict(set)
    for r in found:
        page = pages[r.page_id]
        sources[r.page_id].add(r.refers_to)
        assert r.target_uri == page["url"]
        assert r.content_length == len(r.block.encode())
        if r.warc_type == "conversion":
            parser = Visible()
            parser.feed(page["html"])
            assert "".join(r.block.split()) == "".join("".join(parser.words).split())
        else:
            assert f"conversion: {next(x.record_id for x in found if x.page_id == r.page_id and x.warc_type == 'conversion')}" in r.block
    assert all(len(s) == 1 for s in sources.values())
    assert len({r.record_id for r in found}) == len(found)


def test_pipeline_follows_brute_force(spark, encode):
    import corpus_pipeline
    from ordertide.llm import secrets

    docs = [d for d in rows_of("documents") if any(ch.isalpha() for ch in d["text"] or "")]
    sets, pairs = brute_pairs([d["text"] for d in docs])
    group, least = union_find(range(len(sets)), pairs), {}
    near = {d["doc_id"]: group[sets.index(brute_set(d["text"]))] for d in docs}
    for doc_id, g in near.items():
        least[g] = min(least.get(g, doc_id), doc_id)
    kept = [d for d in docs if least[near[d["doc_id"]]] == d["doc_id"]]
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(t or ""))
    windows = defaultdict(set)
    for item in rows_of("benchmark"):
        w = words(item["text"])
        for i in range(max(len(w) - 12, 1) if w else 0):
            windows[min(len(w), 13)].add(tuple(w[i : i + 13]))
    clean = []
    for d in kept:
        w = words(d["text"])
        hit = {i + j for n, own in windows.items() for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in own for j in range(n)}
        if not (hit and 20 * len(hit) >= len(w)):
            clean.append({**d, "text": secrets.redact_text(d["text"])})
    assert len(clean) < len(kept) < len(rows_of("documents"))
    placed = corpus_pipeline.run(spark, SF).collect()
    used, least = check_packing(clean, placed, encode)
    assert used <= least * 1.02 + 1


def test_secrets_match_sql_where_there_are_some(spark):
    larger = SF.replace("0.001", "0.01")
    name = "op1_secret_scan"
    assert compare(spark, duck(larger), name, QUERIES[name], SQL[name], larger) > 0
    assert QUERIES[name](spark, larger).where("n_assign > 0").count() > 0
