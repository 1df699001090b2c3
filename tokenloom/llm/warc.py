"""WARC derivatives: metadata and plain-text conversion records of response records.

Every response gives two records that refer to it: `metadata` (application/warc-fields with the
title, the language and the links of the page) and `conversion` (its text as UTF-8). Both carry
WARC-Refers-To, the response's target URI and date, and the response's payload digest as
WARC-Source-Payload-Digest; the source's own extra header lines are kept as they are. Record ids are
UUIDs made from the response's id and the record type, so building twice gives the same
records. Nothing is shuffled: pages are read where they stand, records are column expressions.

Plain text, in one pass from left to right: a comment or a script, style, noscript or template
element goes as a whole if it is closed; a tag (`<` and a letter, `/`, `!` or `?`, up to the next `>`) of a block element or
line break becomes a line end, any other tag nothing; references by any name of HTML's table and
all numeric ones are decoded once if they end with a semicolon; runs of blanks become one, blank
lines go. What is known to be absent in the rest of a page is not looked for again, so time grows in proportion to the page
whatever its tags.

Defined cases: a null body is an empty payload and still gives both records (an empty conversion);
a null URI or date leaves its header lines out; a null record id is derived from the empty string;
repeated responses give repeated records; an empty table gives none. A record is a string, so one page
and its text must fit in 2 GB.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.common import python_tasks
from tokenloom.llm.words import small_batches

# Fixed values of the format.
VERSION = "WARC/1.1"
LINE = "\r\n"
# Fixed tag names: elements that start a line of text, and those whose content is no text.
BLOCKS = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main nav ol p pre section table tbody td tfoot th thead title tr ul".split()
)
HIDDEN = frozenset(["script", "style", "noscript", "template"])
# HTML's names of characters that end with a semicolon, without it.
NAMES = {name[:-1]: char for name, char in html5.items() if name.endswith(";")}

_TAG = re.compile(r"<(?:(/?)([a-zA-Z][a-zA-Z0-9_]*)|[/!?])", re.ASCII)
_CLOSING = {name: re.compile(rf"</{name}[ \t\n\r\f\x0B]*>", re.IGNORECASE) for name in HIDDEN}
_REFERENCE = re.compile(r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{0,39});")
_BLANKS = re.compile("[ \t\r\f\x0B\xA0]+")
_LINES = re.compile(" ?\n[ \n]*")
_TITLE = re.compile(r"<title\b[^>]*>", re.IGNORECASE | re.ASCII)
_TITLE_END = re.compile("</title", re.IGNORECASE)
_HTML = re.compile(r"<html\b", re.IGNORECASE | re.ASCII)
_ANCHOR = re.compile(r"<a\b", re.IGNORECASE | re.ASCII)
_LANG = re.compile(r'\blang="(?=([^"]*)")', re.IGNORECASE | re.ASCII)
_HREF = re.compile(r'\bhref="(?=([^"\r\n]*)")', re.IGNORECASE | re.ASCII)


# Pages.


def _character(reference: re.Match) -> str:
    name = reference[1]
    if name[0] != "#":
        return NAMES.get(name, reference[0])
    code = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
    return "\ufffd" if code == 0 or code > 0x10FFFF or 0xD800 <= code <= 0xDFFF else chr(code)


def decode_references(text: str) -> str:
    """Each character reference once: what decoding yields is not decoded again."""
    return _REFERENCE.sub(_character, text) if "&" in text else text


def squeeze(text: str) -> str:
    return _LINES.sub("\n", _BLANKS.sub(" ", text)).strip(" \n")


def plain_text(html: str) -> str:
    out: list[str] = []
    absent: set[str] = set()  # closings that do not come again
    at = 0
    while (start := html.find("<", at)) >= 0:
        tag = _TAG.match(html, start)
        if not tag:
            out.append(html[at : start + 1])
            at = start + 1
            continue
        name = (tag[2] or "").lower()
        end = html.find(">", start)
        if html.startswith("<!--", start) and "-->" not in absent:
            close = html.find("-->", start + 4)
            if close >= 0:
                out.append(html[at:start])
                at = close + 3
                continue
            absent.add("-->")
        if end < 0:  # no tag ends any more
            break
        out.append(html[at:start])
        at = end + 1
        if name in HIDDEN and not tag[1] and name not in absent:
            close = _CLOSING[name].search(html, at)
            if close:
                at = close.end()
                continue
            absent.add(name)
        if name in BLOCKS:
            out.append("\n")
    out.append(html[at:])
    return squeeze(decode_references("".join(out)))


def title_of(html: str) -> str:
    start = _TITLE.search(html)
    end = start and _TITLE_END.search(html, start.end())
    return squeeze(decode_references(html[start.end() : end.start()])).replace("\n", " ") if end else ""


def _attributes(html: str, tags: re.Pattern, values: re.Pattern) -> Iterator[str]:
    """For each tag its last attribute that `values` finds; what has been read is not read again."""
    found = [(m.start(), m.end(), m[1]) for m in values.finditer(html)]
    places = [f[0] for f in found]
    at, end = 0, -1
    while found and (tag := tags.search(html, at)):
        if end < tag.end():
            end = html.find(">", tag.end())
            end = len(html) if end < 0 else end
        k = bisect_right(places, end) - 1
        if k >= bisect_left(places, tag.end()):
            yield found[k][2]
            at = found[k][1] + len(found[k][2]) + 1
        else:
            at = tag.start() + 1


def language_of(html: str) -> str:
    return next(_attributes(html, _HTML, _LANG), "")


def links_of(html: str) -> list[str]:
    return list(_attributes(html, _ANCHOR, _HREF))


READ = {"plain": pa.string(), "title": pa.string(), "language": pa.string(), "links": pa.list_(pa.string())}


def _read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small_batches(batches, "body"):
        pages = b["body"].to_pylist()
        found = [[f(p) for p in pages] for f in (plain_text, title_of, language_of, links_of)]
        kept = [c for c in b.schema.names if c != "body"]
        columns = [b[c] for c in kept] + [pa.array(v, k) for v, k in zip(found, READ.values())]
        yield pa.record_batch(columns, [*kept, *READ])


# Records.


def uuid_of(name: Column) -> Column:
    """A record id from a name, by MD5."""
    h = F.md5(F.coalesce(name, F.lit("")).cast("binary"))
    groups = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *groups), F.lit(">"))


def digest_of(data: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(data.cast("binary"), 256))


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header or field lines; a null value leaves its line out."""
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v, F.lit(LINE))) for k, v in pairs]
    return F.concat_ws("", *lines)


def _record(kind: str, content_type: str, block: Column) -> Column:
    record_id, digest = F.col(f"{kind}_id"), F.col(f"{kind}_digest")
    length = F.octet_length(block).cast("bigint")
    header = _lines(
        ("WARC-Type", F.lit(kind)),
        ("WARC-Record-ID", record_id),
        ("WARC-Date", F.col("warc_date")),
        ("WARC-Target-URI", F.col("target_uri")),
        ("WARC-Refers-To", F.col("record_id")),
        ("WARC-Refers-To-Target-URI", F.col("target_uri")),
        ("WARC-Refers-To-Date", F.col("warc_date")),
        ("WARC-Source-Payload-Digest", F.col("payload_digest")),
        ("WARC-Block-Digest", digest),
        ("Content-Type", F.lit(content_type)),
        ("Content-Length", length.cast("string")),
    )
    return F.struct(
        F.lit(kind).alias("record_type"),
        record_id.alias("derived_id"),
        F.lit(content_type).alias("content_type"),
        length.alias("content_length"),
        digest.alias("block_digest"),
        F.concat(F.lit(VERSION + LINE), header, F.coalesce("source_headers", F.lit("")), F.lit(LINE), block).alias(
            "record"
        ),
    )


def build_derivatives(responses: DataFrame, *carried: str) -> DataFrame:
    """The two derived records of every response, with the columns `carried` kept in front.

    `responses` has record_id, target_uri, warc_date, source_headers (lines with their ends, or
    null), body and, where the source states it, payload_digest.
    """
    python_tasks(responses.sparkSession)
    body = F.coalesce("body", F.lit(""))
    digest = digest_of(body)
    if "payload_digest" in responses.columns:
        digest = F.coalesce("payload_digest", digest)
    named = responses.select(
        *[F.col(c).alias(f"carried_{i}") for i, c in enumerate(carried)],
        "record_id",
        "target_uri",
        "warc_date",
        "source_headers",
        digest.alias("payload_digest"),
        body.alias("body"),
    )
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema if f.name != "body")
    read = named.mapInArrow(_read_pages, f"{kinds}, plain string, title string, language string, links array<string>")
    links = F.array_join(F.transform("links", lambda x: F.concat(F.lit("outlink: "), x, F.lit(LINE))), "")
    fields = F.concat(
        _lines(
            ("title", F.when(F.col("title") != "", F.col("title"))),
            ("language", F.when(F.col("language") != "", F.col("language"))),
            ("outlinks", F.size("links").cast("string")),
        ),
        links,
    )
    blocked = read.withColumn("fields", fields).withColumns(
        {f"{kind}_id": uuid_of(F.concat(F.col("record_id"), F.lit(f":{kind}"))) for kind in ("metadata", "conversion")}
        | {"metadata_digest": digest_of(F.col("fields")), "conversion_digest": digest_of(F.col("plain"))}
    )
    both = F.array(
        _record("metadata", "application/warc-fields", F.col("fields")),
        _record("conversion", "text/plain; charset=utf-8", F.col("plain")),
    )
    names = [F.col(f"carried_{i}").alias(c) for i, c in enumerate(carried)]
    return blocked.select(
        *names,
        F.col("record_id").alias("refers_to"),
        "target_uri",
        "payload_digest",
        F.explode(both).alias("r"),
    ).select(*carried, "refers_to", "target_uri", "payload_digest", "r.*")


def page_responses(pages: DataFrame) -> DataFrame:
    """Response records of (page_id, url, html) rows; pages have no crawl date."""
    named = F.concat_ws(" ", F.col("page_id").cast("string"), "url", "html")
    return pages.select(
        "page_id",
        uuid_of(named).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit("1970-01-01T00:00:00Z").alias("warc_date"),
        F.lit("WARC-Identified-Payload-Type: text/html" + LINE).alias("source_headers"),
        F.col("html").alias("body"),
    )


def write_warc(records: DataFrame, folder: str, compression: str = "gzip") -> str:
    """WARC files of the `record` column: a record ends with two line ends."""
    records.select("record").write.option("lineSep", LINE * 2).option("compression", compression).text(folder)
    return folder


# Reading.

# Header lines that derived records write anew.
REWRITTEN = frozenset(
    "warc-type warc-record-id warc-date warc-target-uri warc-payload-digest warc-block-digest content-type content-length".split()
)
RECORDS = "warc_type string, record_id string, target_uri string, warc_date string, payload_digest string, headers string, block binary"


def _members(content: bytes) -> Iterator[bytes]:
    """The plain bytes of a file, by gzip member where it is compressed."""
    if content[:2] != b"\x1f\x8b":
        yield content
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        yield member.decompress(content) + member.flush()
        if not member.eof:
            raise ValueError("a gzip member of a WARC file is cut short")
        content = member.unused_data.lstrip(b"\x00")


def parse_records(content: bytes) -> Iterator[tuple]:
    """The records of a WARC file, in the order of RECORDS; records may span gzip members."""
    rest = b""
    for member in _members(content):
        rest += member
        at = 0
        while (at := _skip_line_ends(rest, at)) < len(rest):
            end = rest.find(b"\r\n\r\n", at)
            if end < 0:
                break
            lines = rest[at:end].decode("utf-8", "replace").split(LINE)
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"no WARC record: {lines[0][:40]!r}")
            fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
            stop = end + 4 + int(fields["content-length"])
            if stop > len(rest):
                break
            kept = [line for line in lines[1:] if line.partition(":")[0].strip().lower() not in REWRITTEN]
            names = ("warc-type", "warc-record-id", "warc-target-uri", "warc-date", "warc-payload-digest")
            yield (*map(fields.get, names), "".join(line + LINE for line in kept), rest[end + 4 : stop])
            at = stop
        rest = rest[at:]
    if rest.strip(b"\r\n"):
        raise ValueError("a WARC file ends inside a record")


def _skip_line_ends(data: bytes, at: int) -> int:
    while data[at : at + 1] in (b"\r", b"\n"):
        at += 1
    return at


def _parse_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in RECORDS.split(", ")]
    kinds = [pa.string()] * 6 + [pa.binary()]
    for b in batches:
        for content in b["content"]:
            for record in parse_records(content.as_buffer().to_pybytes()):
                yield pa.record_batch([pa.array([v], k) for v, k in zip(record, kinds)], names)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records (RECORDS) of the WARC files, plain or gzipped, below `path`.

    A file is read by one task and held there, so files should be of ordinary size (about 1 GB at most).
    """
    python_tasks(spark)
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_parse_files, RECORDS)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """The HTTP responses among the records, as `build_derivatives` takes them.

    The body is decoded by the charset of its Content-Type (UTF-8 where none is named or known); bytes that are
    not valid become U+FFFD. Header lines that derived records do not write themselves are kept.
    """

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [http_body(block.as_py()) for block in b["block"]]
            yield pa.record_batch([*b.columns[:-1], pa.array(texts, pa.string())], [*b.schema.names[:-1], "body"])

    kinds = "record_id string, target_uri string, warc_date string, payload_digest string, source_headers string"
    responses = read_records(spark, path).filter("warc_type = 'response'").withColumnRenamed("headers", "source_headers")
    names = [k.split()[0] for k in kinds.split(", ")]
    return responses.select(*names, "block").mapInArrow(bodies, f"{kinds}, body string")


def http_body(message: bytes) -> str:
    head, _, body = message.partition(b"\r\n\r\n")
    charset = re.search(rb"(?im)^content-type:.*?charset=[\"']?([a-z0-9_.:-]+)", head)
    try:
        return body.decode(charset[1].decode() if charset else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")
