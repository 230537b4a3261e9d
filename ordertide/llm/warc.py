"""WARC derivatives: a metadata and a plain-text conversion record for every response.

Both refer to the response by its id, keep its target, date, HTTP header block and payload
digest, and carry the digest of their own block. The conversion holds the visible text, the
metadata record names status, type, title, link count and the conversion made from the same
response. Ids are derived from the response's, so a second run gives the same records.

Comments, scripts and styles that never close hide the rest of a page; a head, title, noscript or
template without its closing tag hides nothing but the tag, so the page's text stays.

A null html is an empty payload with an empty text; a null url leaves the target out. Repeated
responses give the same records again. Records of very long pages are built one at a time.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import bounded_batches

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
MARK = re.compile(r"<!--|<(script|style|noscript|template|head|title)\b", re.I)
#: Without their closing tag these hide the rest of the page; the others then hide nothing but their tag.
RUN_ON = ("<!--", "script", "style")
CLOSE = {"<!--": re.compile("-->")} | {
    name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template", "head", "title")
}
TITLE = re.compile(r"<title\b[^<>]*>(.*?)(?:</title|\Z)", re.I | re.S)
LINK = re.compile(r"<a\s[^<>]*?\bhref\s*=", re.I)
BLOCK = re.compile(
    r"</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|tr|td|th|table|h[1-6]|section|article|aside|nav|header|footer|main|blockquote|pre|form|body)\b[^<>]*>", re.I
)
# A tag ends before the next "<", so an open quote never makes the search start over.
TAG = re.compile(r"<[/!?a-zA-Z](?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*>")
FIELDS = (
    "record_id", "warc_type", "refers_to", "target_uri", "date", "content_type", "source_headers",
    "payload_digest", "block_digest", "content_length", "block",
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def derived_id(source: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source}#{kind}')}>"


def without_hidden(page: str) -> str:
    """The page without comments and elements that aren't shown. A closing tag that is missing is looked for once."""
    parts, at, start, missing = [], 0, 0, set()
    while mark := MARK.search(page, at):
        name = (mark[1] or mark[0]).lower()
        close = None if name in missing else CLOSE[name].search(page, mark.end())
        if close or name in RUN_ON:
            parts.append(page[start : mark.start()])
            start = at = close.end() if close else len(page)
        else:
            missing.add(name)
            at = mark.end()
    return " ".join([*parts, page[start:]])


def visible_text(page: str) -> str:
    """The text a reader sees, one line per block, white space collapsed."""
    text = TAG.sub("", BLOCK.sub("\n", without_hidden(page)))
    lines = (" ".join(line.split()) for line in html.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def responses(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, record_id, target_uri, date, headers, payload): response records of a table of pages."""
    name = F.md5(F.concat_ws("|", F.col(page_id).cast("string"), F.coalesce(F.col(url), F.lit(""))))
    cut = lambda at, n: F.substring(name, at, n)
    uid = F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12)), F.lit(">"))
    payload = F.coalesce(F.col(page), F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(payload), F.lit(CRLF * 2))
    return pages.select(
        F.col(page_id).alias("page_id"), uid.alias("record_id"), F.col(url).alias("target_uri"), F.lit(DATE).alias("date"),
        head.alias("headers"), payload.alias("payload"),
    )


def derive_one(record_id: str, target: str | None, date: str, headers: str, payload: str) -> list[tuple]:
    """The two records of one response, in the order of ``FIELDS``."""
    source_digest, text = digest(payload.encode()), visible_text(payload)
    converted, described = derived_id(record_id, "conversion"), derived_id(record_id, "metadata")
    status = re.match(r"HTTP/\S+ (\d+)", headers)
    kind = re.search(r"^content-type:\s*([^\r\n]*)", headers, re.I | re.M)
    title = TITLE.search(payload)
    facts = {
        "fetch-status": status[1] if status else "", "source-content-type": kind[1] if kind else "",
        "title": " ".join(html.unescape(title[1]).split()) if title else "", "outlinks": len(LINK.findall(payload)),
        "text-characters": len(text), "conversion": converted,
    }
    out = []
    for own, type_, content, block in (
        (described, "metadata", "application/warc-fields", "".join(f"{k}: {v}{CRLF}" for k, v in facts.items())),
        (converted, "conversion", "text/plain; charset=utf-8", text),
    ):
        data = block.encode()
        out.append((own, type_, record_id, target, date, content, headers, source_digest, digest(data), len(data), block))
    return out


def derive(records: DataFrame) -> DataFrame:
    """Two rows per response: its ``page_id`` and the fields of the record."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (r.page_id, *made) for r in batch.itertuples(index=False)
                for made in derive_one(r.record_id, r.target_uri, r.date, r.headers, r.payload)
            ]
            yield pd.DataFrame(rows, columns=["page_id", *FIELDS]).astype({"page_id": batch["page_id"].dtype})

    kind = records.schema["page_id"].dataType.simpleString()
    types = ", ".join(f"{f} {'long' if f == 'content_length' else 'string'}" for f in FIELDS)
    return bounded_batches(records).mapInPandas(run, f"page_id {kind}, {types}")


def serialised() -> Column:
    """The whole record as it stands in a file. The source's HTTP headers go into one header line, folded."""
    line = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"{name}: "), c, F.lit(CRLF))).otherwise("")
    folded = F.replace(F.regexp_replace("source_headers", r"(\r\n)+$", ""), F.lit(CRLF), F.lit(CRLF + "\t"))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.col("warc_type")), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Refers-To", F.col("refers_to")), line("WARC-Target-URI", F.col("target_uri")), line("WARC-Date", F.col("date")),
        line("WARC-Source-Payload-Digest", F.col("payload_digest")), line("WARC-Source-HTTP-Header", folded),
        line("WARC-Block-Digest", F.col("block_digest")), line("Content-Type", F.col("content_type")),
        line("Content-Length", F.col("content_length").cast("string")), F.lit(CRLF), F.col("block"), F.lit(CRLF * 2),
    )


def parse(record: str) -> tuple[dict[str, str], str]:
    """Headers and block of a serialised record."""
    head, _, rest = record.partition(CRLF * 2)
    lines = head.replace(CRLF + "\t", "\v").split(CRLF)[1:]
    headers = {k: v.replace("\v", CRLF) for k, _, v in (x.partition(": ") for x in lines)}
    data = rest.encode()
    return headers, data[: int(headers["Content-Length"])].decode()
