"""WARC derivatives: response records become linked metadata and plain-text conversion records.

``responses`` wraps pages as response records, ``derive`` makes the two derivatives of each response, and
``write_records`` and ``read_records`` move records to and from WARC/1.1 files. A record is a row: record_id,
warc_type, target_uri, warc_date, refers_to, content_type, payload_digest, block_digest, headers (further named header
lines of the record, name to value) and block. Record ids are made from type and content, so a rerun gives the same.

Defined results: null html is an empty payload; a null url gives a record without a target; repeated rows give repeated
records; very long pages are converted whole; of several titles the first counts; an empty table gives an empty result;
further columns of the input, whatever their names, are ignored. A response whose block has no empty line after its head
is taken as a payload without headers.
"""

from __future__ import annotations

import gzip
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The date of records whose source has none.
UNDATED = "1970-01-01T00:00:00Z"
CRLF = "\r\n"
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"
RECORD = "record_id string, warc_type string, target_uri string, warc_date string, refers_to string, content_type string, payload_digest string, block_digest string, headers map<string,string>, block string"
COLUMNS = [x.split()[0] for x in RECORD.split(", ")]
#: Elements that break a line in the plain text, and the entities that are written out (fixed values of HTML).
BLOCKS = "address|article|aside|blockquote|br|dd|div|dl|dt|footer|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def record_id(kind: str, *parts: Column) -> Column:
    """A name-like id: the same kind and parts give the same."""
    h = F.sha2(F.concat_ws("\n", F.lit(kind), *(F.coalesce(p, F.lit("")) for p in parts)).cast("binary"), 256)
    cut = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), cut[0], F.lit("-"), cut[1], F.lit("-5"), cut[2], F.lit("-8"), cut[3], F.lit("-"), cut[4])


def plain_text(html: Column) -> Column:
    """Text of a page: comments, scripts and styles go, block elements break lines, entities are written out."""
    out = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?is)<script\b.*?</script\s*>", " ")
    out = F.regexp_replace(out, r"(?is)<style\b.*?</style\s*>", " ")
    out = F.regexp_replace(out, rf"(?is)</?(?:{BLOCKS})\b[^>]*>", "\n")
    out = F.regexp_replace(out, r"(?s)<[a-zA-Z/!?][^>]*>", "")
    for entity, char in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    out = F.regexp_replace(out, r"[ \t\r\f\x0B]+", " ")
    out = F.regexp_replace(out, r" ?\n[ \n]*", "\n")
    return F.regexp_replace(out, r"^[ \n]+|[ \n]+$", "")


def _record(kind: str, payload: Column, content_type: str, refers_to: Column, headers: Column) -> list[Column]:
    block = F.col("__block")
    return [
        record_id(kind, F.col("target_uri"), F.col("warc_date"), refers_to, block).alias("record_id"),
        F.lit(kind).alias("warc_type"),
        F.col("target_uri"),
        F.col("warc_date"),
        refers_to.alias("refers_to"),
        F.lit(content_type).alias("content_type"),
        digest(payload).alias("payload_digest"),
        digest(block).alias("block_digest"),
        headers.cast("map<string,string>").alias("headers"),
        block.alias("block"),
    ]


def responses(pages: DataFrame, date: str = UNDATED) -> DataFrame:
    """A response record, with an HTTP head, of each page (url, html)."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("url").alias("target_uri"), F.lit(date).alias("warc_date"), html.alias("__html"), F.concat(F.lit(HTTP_HEAD), html).alias("__block"))
    return rows.select(*_record("response", F.col("__html"), "application/http; msgtype=response", F.lit(None).cast("string"), F.create_map()))


def derive(records: DataFrame) -> DataFrame:
    """For each response record a metadata record (its HTTP head and digests, as fields) and a conversion record (its
    text). Both refer to the response, keep its target and date, and carry its digests in their headers."""
    gap = F.instr("block", CRLF * 2)
    rows = records.where("warc_type = 'response'").select(
        "target_uri",
        "warc_date",
        F.col("record_id").alias("__source"),
        F.col("payload_digest").alias("__payload_digest"),
        F.col("block_digest").alias("__block_digest"),
        F.when(gap > 0, F.substring(F.col("block"), F.lit(1), gap - 1)).otherwise("").alias("__head"),
        F.when(gap > 0, F.substring(F.col("block"), gap + 4, F.length("block"))).otherwise(F.col("block")).alias("__payload"),
    )
    head = F.replace(F.col("__head"), F.lit(CRLF), F.lit("\n"))
    headers = F.create_map(F.lit("X-Source-Payload-Digest"), F.col("__payload_digest"), F.lit("X-Source-Block-Digest"), F.col("__block_digest"))
    rows = rows.withColumn("__text", plain_text(F.col("__payload")))
    fields = F.concat(
        F.lit("http-status: "), F.regexp_extract(head, r"^HTTP/[0-9.]+ ([0-9]+)", 1), F.lit(CRLF),
        F.array_join(F.transform(F.filter(F.split(head, "\n"), lambda x, i: (i > 0) & (x != "")), lambda x: F.concat(F.lit("http-header-"), F.lower(F.substring_index(x, ":", 1)), F.lit(":"), F.substring(x, F.instr(x, ":") + 1, F.length(x)), F.lit(CRLF))), ""),
        F.lit("payload-characters: "), F.length("__payload").cast("string"), F.lit(CRLF),
        F.lit("text-characters: "), F.length("__text").cast("string"), F.lit(CRLF),
        F.lit("title: "), F.trim(F.regexp_replace(F.regexp_extract("__payload", r"(?is)<title[^>]*>(.*?)</title", 1), r"\s+", " ")), F.lit(CRLF),
    )
    made = rows.withColumn("__kind", F.explode(F.array(F.lit("metadata"), F.lit("conversion"))))
    made = made.withColumn("__block", F.when(F.col("__kind") == "metadata", fields).otherwise(F.col("__text")))
    both = []
    for kind, content_type in (("metadata", "application/warc-fields"), ("conversion", "text/plain; charset=utf-8")):
        both.append(F.struct(*_record(kind, F.col("__block"), content_type, F.col("__source"), headers)))
    return made.select(F.when(F.col("__kind") == "metadata", both[0]).otherwise(both[1]).alias("r")).select("r.*")


def as_text(records: DataFrame) -> Column:
    """A record as it stands in a file, but for the two line ends after it."""
    c = F.col
    line = lambda name, value: F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(CRLF)), F.lit(""))
    angle = lambda x: F.concat(F.lit("<"), x, F.lit(">"))
    more = F.array_join(F.transform(F.map_entries(F.coalesce(c("headers"), F.create_map().cast("map<string,string>"))), lambda e: F.concat(e["key"], F.lit(": "), e["value"], F.lit(CRLF))), "")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", c("warc_type")), line("WARC-Record-ID", angle(c("record_id"))), line("WARC-Date", c("warc_date")), line("WARC-Target-URI", c("target_uri")),
        line("WARC-Refers-To", angle(c("refers_to"))), line("WARC-Payload-Digest", c("payload_digest")), line("WARC-Block-Digest", c("block_digest")), line("Content-Type", c("content_type")), more,
        line("Content-Length", F.octet_length("block").cast("string")), F.lit(CRLF), c("block"),
    )


def write_records(records: DataFrame, path: str, compression: str = "gzip", per_file: int = 50_000) -> None:
    """WARC files of at most so many records each, written by Spark."""
    records.select(as_text(records).alias("value")).write.option("lineSep", CRLF * 2).option("compression", compression).option("maxRecordsPerFile", per_file).text(path)


_KNOWN = {"warc-record-id": "record_id", "warc-type": "warc_type", "warc-target-uri": "target_uri", "warc-date": "warc_date", "warc-refers-to": "refers_to", "content-type": "content_type", "warc-payload-digest": "payload_digest", "warc-block-digest": "block_digest"}


def parse(stream):
    """Records of an open WARC file, by their lengths; a broken tail ends the file."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue
        row: dict = dict.fromkeys(COLUMNS) | {"headers": []}
        length = 0
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            name, value = name.strip(), value.strip()
            if name.lower() == "content-length":
                length = int(value)
            elif field := _KNOWN.get(name.lower()):
                row[field] = value.strip("<>") if field in ("record_id", "refers_to") else value
            else:
                row["headers"].append((name, value))
        block = stream.read(length)
        if len(block) < length:
            return
        row["block"] = block.decode("utf-8", "replace")
        yield row


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files, plain or in gzip members."""
    kinds = [pa.string()] * 8 + [pa.map_(pa.string(), pa.string()), pa.string()]

    def parsed(batches):
        for batch in batches:
            for content in batch.column("content").to_pylist():
                stream = io.BytesIO(content)
                opened = io.BufferedReader(gzip.GzipFile(fileobj=stream)) if content[:2] == b"\x1f\x8b" else stream
                rows: list[dict] = []
                for row in parse(opened):
                    rows.append(row)
                    if len(rows) == 1000:
                        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in zip(COLUMNS, kinds, strict=True)], COLUMNS)
                        rows = []
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in zip(COLUMNS, kinds, strict=True)], COLUMNS)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parsed, RECORD)
