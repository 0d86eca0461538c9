"""WARC derivatives: of each response a metadata record and a plain-text conversion record.

Both refer to the response by ``WARC-Refers-To`` and repeat its target, date and digests; the
metadata record holds the source's HTTP headers and what the page says of itself, the
conversion record the text of the page. ``read_warc`` and ``write_warc`` are the source and the
sink: a table of records from WARC files, plain or gzipped, and WARC files from such a table.
``responses`` makes response records of a table of pages. A page is read in one pass, however
many of its tags and comments never end.

Defined results: records that aren't responses have no derivative; a null block is empty, and
its conversion an empty text; without a target the header is left out; a repeated record is
derived again, with the same identifiers; an empty table gives an empty one; other columns are
ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.shared import lean_map, small_batches
from linkloom.runtime import make_importable

CRLF = "\r\n"
RECORD = "key long, record_id string, type string, target_uri string, date string, content_type string, refers_to string, payload_digest string, block_digest string, content_length long, headers string, block binary"
_RECORD = pa.schema([("key", pa.int64()), *[(c, pa.string()) for c in ("record_id", "type", "target_uri", "date", "content_type", "refers_to", "payload_digest", "block_digest")], ("content_length", pa.int64()), ("headers", pa.string()), ("block", pa.binary())])
#: Elements whose content isn't text, and those that end a line.
HIDDEN = "script|style|noscript|template|head"
BREAKS = "p|div|br|li|ul|ol|tr|table|h[1-6]|section|article|header|footer|nav|blockquote|pre|hr|dl|dt|dd"
HIDES = re.compile(rf"<({HIDDEN})\b", re.I)
BREAK = re.compile(rf"</?(?:{BREAKS})\b", re.I)
TAG = re.compile(r"<[!/?a-zA-Z]")
TITLE, TITLE_END = re.compile(r"<title", re.I), re.compile(r"</title\s*>", re.I)
HTML, LANG = re.compile(r"<html\b", re.I), re.compile(r"\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
CHARSET = re.compile(rb"charset\s*=\s*[\"']?([A-Za-z0-9_-]+)", re.I)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


class Ahead:
    """Where the next match of a pattern begins and ends, asked at places that only grow: the page is searched once."""

    def __init__(self, pattern: str, page: str):
        self.found, self.page, self.at = re.compile(pattern, re.I), page, (-1, -1)

    def __call__(self, place: int) -> tuple[int, int] | None:
        if self.at is not None and self.at[0] < place:
            m = self.found.search(self.page, place)
            self.at = m and m.span()
        return self.at


def visible(page: str) -> str:
    """A page without comments, hidden elements and tags, in one pass; tags that break lines leave a line break.

    What is opened and never closed counts as a tag of its own, a tag without end as text.
    """
    tag_end, comment_end = Ahead(">", page), Ahead("-->", page)
    ends = {x: Ahead(rf"</{x}\s*>", page) for x in HIDDEN.split("|")}
    out, at = [], 0
    while (i := page.find("<", at)) >= 0:
        out.append(page[at:i])
        if page.startswith("<!--", i) and (end := comment_end(i + 4)):
            out.append(" ")
            at = end[1]
            continue
        close = tag_end(i + 2)
        if close is None:
            return "".join(out) + page[i:]  # no tag ends from here on
        if (m := HIDES.match(page, i)) and (end := ends[m[1].lower()](close[1])):
            out.append(" ")
            at = end[1]
        elif TAG.match(page, i):
            out.append("\n" if BREAK.match(page, i) else "")
            at = close[1]
        else:
            out.append("<")
            at = i + 1
    return "".join(out) + page[at:]


def unescaped(text: str) -> str:
    """Character references resolved; numbers beyond all characters are shortened first, as they may have any number of digits."""
    return html.unescape(re.sub(r"&#0*([0-9]{8})[0-9]*", r"&#\1", text))


def text_of(page: str) -> str:
    """The text of a page: a line per block, runs of blanks as one, no empty lines."""
    lines = (" ".join(x.split()) for x in unescaped(visible(page)).split("\n"))
    return "\n".join(x for x in lines if x)


def title_of(page: str) -> str | None:
    start = TITLE.search(page)
    close = page.find(">", start.end()) if start else -1
    end = TITLE_END.search(page, close + 1) if close >= 0 else None
    return page[close + 1 : end.start()] if end else None


def language_of(page: str) -> str | None:
    start = HTML.search(page)
    found = LANG.search(page, start.end(), max(page.find(">", start.end()), start.end())) if start else None
    return found[1].lower() if found else None


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and body of an HTTP response; all body if there is no head."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, _, body = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("utf-8", "replace").split(CRLF)
    return status, [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines)], body


def one_line(x: str) -> str:
    return " ".join(x.split())


def derive_one(r: dict) -> list[dict]:
    """The derivatives of one record."""
    if r["type"] != "response":
        return []
    status, headers, body = split_http(r["block"] or b"")
    found = CHARSET.search(next((v for k, v in headers if k.lower() == "content-type"), "").encode()) or CHARSET.search(body[:1024])
    try:
        page = body.decode(found[1].decode() if found else "utf-8", "replace")
    except LookupError:
        page = body.decode("utf-8", "replace")
    title, lang = title_of(page), language_of(page)
    payload = r["payload_digest"] or digest(body)
    source = r["block_digest"] or digest(r["block"] or b"")
    fields = [("source-status", status), *[(f"source-header-{k.lower()}", v) for k, v in headers], ("source-block-digest", source), ("source-payload-digest", payload), ("source-payload-length", str(len(body)))]
    fields += [("title", one_line(unescaped(title)))] if title is not None else []
    fields += [("language", lang)] if lang else []
    meta = "".join(f"{k}: {one_line(v)}{CRLF}" for k, v in fields).encode()
    text = text_of(page).encode("utf-8", "replace")
    out = []
    for kind, content_type, block in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain; charset=utf-8", text)):
        own = record_id(r["record_id"], kind)
        lines = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", r["date"]), ("WARC-Target-URI", r["target_uri"]), ("WARC-Refers-To", r["record_id"]), ("WARC-Refers-To-Target-URI", r["target_uri"]), ("WARC-Refers-To-Date", r["date"])]
        lines += [("WARC-Payload-Digest", payload)] if kind == "metadata" else []
        # fields of our own, which the format allows
        lines += [("WARC-Source-Block-Digest", source), ("WARC-Source-Payload-Digest", payload), *[(f"WARC-Source-Header-{k}", v) for k, v in headers if re.fullmatch("[A-Za-z0-9-]+", k)]]
        lines += [("WARC-Block-Digest", digest(block)), ("Content-Type", content_type), ("Content-Length", str(len(block)))]
        out.append({
            "key": r["key"], "record_id": own, "type": kind, "target_uri": r["target_uri"], "date": r["date"], "content_type": content_type, "refers_to": r["record_id"], "payload_digest": payload,
            "block_digest": digest(block), "content_length": len(block), "headers": "".join(f"{k}: {one_line(v)}{CRLF}" for k, v in lines if v is not None), "block": block,
        })
    return out


def serialise(headers: str, block: bytes) -> bytes:
    """A record as it stands in a WARC file."""
    return b"WARC/1.1\r\n" + headers.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """Headers and block of the records of a WARC file."""
    out, at = [], 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            raise ValueError(f"a WARC record's headers don't end after byte {at}")
        version, *lines = data[at:end].decode().split(CRLF)
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines)
        n = int(headers["Content-Length"])
        out.append((headers, data[end + 4 : end + 4 + n]))
        at = end + 4 + n + 4
    return out


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all WARC files under ``path``, columns as in RECORD. A file (2 GB at most) is in a worker's memory; its records leave one by one."""

    def rows(batches):
        for batch in batches:
            for data in batch.column(0):
                data = data.as_py()
                for h, block in parse(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                    row = {
                        "record_id": h.get("WARC-Record-ID"), "type": h.get("WARC-Type"), "target_uri": h.get("WARC-Target-URI"), "date": h.get("WARC-Date"), "content_type": h.get("Content-Type"),
                        "refers_to": h.get("WARC-Refers-To"), "payload_digest": h.get("WARC-Payload-Digest"), "block_digest": h.get("WARC-Block-Digest"), "content_length": len(block),
                        "headers": "".join(f"{k}: {v}{CRLF}" for k, v in h.items()), "block": block,
                    }
                    yield pa.RecordBatch.from_pylist([row], schema=_RECORD)

    make_importable(spark)
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(lean_map(rows), RECORD)


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """WARC files of ``records`` (headers, block) under ``path``, one a partition, committed by Spark's own writer."""
    empty = F.lit("").cast("binary")
    whole = F.concat(F.lit("WARC/1.1\r\n").cast("binary"), F.col("headers").cast("binary"), F.lit("\r\n").cast("binary"), F.coalesce(F.col("block"), empty), F.lit("\r\n\r").cast("binary"))
    # the text writer puts bytes as they are, and the last line feed of each record
    records.select(whole.cast("string").alias("value")).write.option("lineSep", "\n").option("compression", compression).text(path)


def derive(records: DataFrame) -> DataFrame:
    """The derivative records of ``records``, columns of both as in RECORD. A map: nothing is shuffled, a page at a time is in memory."""

    def rows(batches):
        for batch in batches:
            out: list[dict] = []
            weight = 0
            for i in range(batch.num_rows):
                for r in derive_one({c: batch.column(c)[i].as_py() for c in ("key", "record_id", "type", "target_uri", "date", "payload_digest", "block_digest", "block")}):
                    out.append(r)
                    weight += len(r["block"])
                if weight > 4 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema=_RECORD)
                    out, weight = [], 0
            yield pa.RecordBatch.from_pylist(out, schema=_RECORD)

    make_importable(records.sparkSession)
    small_batches(records.sparkSession)
    return records.select("key", "record_id", "type", "target_uri", "date", "payload_digest", "block_digest", "block").mapInArrow(lean_map(rows), RECORD)


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of a table of pages (page_id, url, html)."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    name = F.md5(F.concat_ws("|", F.col("page_id").cast("string"), F.coalesce(F.col("url"), F.lit(""))).cast("binary"))
    dashed = F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))
    block = F.concat(head.cast("binary"), body)
    line = lambda k, v: F.coalesce(F.concat(F.lit(f"{k}: "), v, F.lit(CRLF)), F.lit(""))
    url = F.regexp_replace("url", r"\s+", " ")
    headers = [("WARC-Type", F.lit("response")), ("WARC-Record-ID", dashed), ("WARC-Date", F.lit(date)), ("WARC-Target-URI", url), ("Content-Type", F.lit("application/http; msgtype=response"))]
    headers = F.concat(*[line(k, v) for k, v in headers], line("Content-Length", F.octet_length(block).cast("string")))
    return pages.select(
        F.col("page_id").cast("long").alias("key"), dashed.alias("record_id"), F.lit("response").alias("type"), F.col("url").alias("target_uri"), F.lit(date).alias("date"),
        F.lit(None).cast("string").alias("payload_digest"), F.lit(None).cast("string").alias("block_digest"), block.alias("block"), headers.alias("headers"),
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata and conversion records of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return derive(responses(pages)).select(F.col("key").alias("page_id"), "type", "record_id", "refers_to", "target_uri", "date", "content_type", "content_length", "payload_digest", "block_digest", "headers", F.col("block").cast("string").alias("block"))
