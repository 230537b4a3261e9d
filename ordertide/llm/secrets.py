"""Secret scan: a keyword automaton first, anchored patterns near its hits, checksums last.

Every text is read once by an Aho-Corasick automaton that knows all keywords in every
spelling of their letters. Only where a keyword was seen is the pattern of its kind matched,
at that very place. Hex runs have no keyword, so every 32nd character is probed instead: a
run of 32 covers at least one of them. Kinds that carry a checksum are kept only if it holds.

Kinds, in this order: ``assign`` (a named value), ``access`` (cloud access keys), ``hex``
(long hex runs), ``github`` and ``npm`` (tokens whose last six characters are the CRC-32 of
the 30 before them in base 62). Spans of one kind never overlap, the leftmost wins; spans of
different kinds may. Positions count code points, the end is exclusive.

A null text has no spans. Repeated rows are scanned each on its own; other columns pass
through untouched.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import product

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.llm.common import bounded_batches

KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = KINDS[:3]
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32

NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_DIGITS = frozenset("0123456789abcdef")
CHECKED = {
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")),
    "npm": (("npm_",), re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
]))


def checksum62(body: str) -> str:
    """CRC-32 of ``body`` as six base-62 digits."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, low = divmod(value, 62)
        digits = BASE62[low] + digits
    return digits


@cache
def automaton() -> ahocorasick.Automaton:
    """All keywords; a name is entered in every mix of upper and lower case."""
    out = ahocorasick.Automaton()
    for name in NAMES:
        for letters in product(*({c, c.upper()} for c in name)):
            out.add_word("".join(letters), ("assign", len(name)))
    out.add_word("AKIA", ("access", 4))
    for kind, (prefixes, _) in CHECKED.items():
        for prefix in prefixes:
            out.add_word(prefix, (kind, len(prefix)))
    out.make_automaton()
    return out


def _hex_runs(text: str) -> Iterator[tuple[int, int]]:
    at = MIN_HEX - 1
    while at < len(text):
        if text[at] not in HEX_DIGITS:
            at += MIN_HEX
            continue
        start = at
        while start and text[start - 1] in HEX_DIGITS:
            start -= 1
        end = HEX.match(text, at).end()
        if end - start >= MIN_HEX:
            yield start, end
        # The next run starts after ``end``, so its 32nd character is the next that can prove one.
        at = end + MIN_HEX


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of one text, by start, then by kind."""
    if not text:
        return []
    hits = sorted((end - size + 1, kind) for end, (kind, size) in automaton().iter(text))
    found, after = [("hex", *run) for run in _hex_runs(text)], dict.fromkeys(KINDS, 0)
    for start, kind in hits:
        if start < after[kind]:
            continue
        if kind == "assign":
            m = ASSIGN.match(text, start)
            good = m and len(m[2]) >= MIN_VALUE
        elif kind == "access":
            m = ACCESS.match(text, start)
            good = m and len(m[0]) >= MIN_ACCESS
        else:
            m = CHECKED[kind][1].match(text, start)
            good = m and checksum62(m[1]) == m[2]
        if m:
            # A match that fails its test still takes its characters.
            after[kind] = m.end()
        if good:
            found.append((kind, start, m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


@F.pandas_udf(SPANS)
def secret_spans(texts: pd.Series) -> pd.Series:
    return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t)] for t in texts], dtype=object)


def redact_text(text: str | None) -> str | None:
    """The text with each stretch of secret characters replaced by ``[secret]``."""
    spans = find_spans(text)
    if not spans:
        return text
    parts, at, covered = [], 0, 0
    for _, start, end in spans:
        if start >= covered:
            parts += [text[at:start], "[secret]"]
        covered = at = max(covered, end)
    return "".join([*parts, text[at:]])


@F.pandas_udf(T.StringType())
def redacted(texts: pd.Series) -> pd.Series:
    return pd.Series([redact_text(t) for t in texts], dtype=object)


def scan(df: DataFrame, text: str = "text", out: str = "secret_spans") -> DataFrame:
    """``df`` with a column of spans (kind, start, end). Empty, never null."""
    return bounded_batches(df).withColumn(out, secret_spans(F.col(text)))


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with all secrets in ``text`` replaced; a null text stays null."""
    return bounded_batches(df).withColumn(text, redacted(F.col(text)))


def _of(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(scanned: DataFrame, doc_id: str = "doc_id", spans: str = "secret_spans") -> DataFrame:
    """Counts, the digest of the base spans and all spans as text, one row per document."""
    s = F.col(spans)
    return scanned.select(
        F.col(doc_id),
        *[F.size(_of(s, (kind,))).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(joined(_of(s, BASE_KINDS)), 256).alias("base_sha256"),
        joined(s).alias("spans"),
    )
