"""WARC archives written and read by Spark: segments, revisits, chunked transfer coding.

Writing needs no Python: a page becomes a response record whose block is an HTTP response in chunked transfer
coding; a block of more than ``SEGMENT`` code points is cut into a first record (WARC-Segment-Number 1) and
continuation records that name its id as origin, the last with the total length. Of pages with equal
payloads of at least 1000 bytes, the one with the largest id is the response and the others are revisit
records without payload. Records are written by Spark's text writer, so files lie wherever Spark can write,
at most ``FILE_RECORDS`` records in each, compressed as a whole.

Reading parses files whole (they are bounded by the writer; an archive from elsewhere must have files that fit
in a task) by the records' lengths, groups continuation records by origin, orders them by segment number,
checks that none is missing and that the total length is right, undoes chunked (and gzip or deflate) coding
and computes digests of the payload. A record that is damaged gets a ``problem`` instead of a payload.

Defined cases: a null html is an empty payload, a null url an empty target; a null page id is written as
``null`` and read back as null, and ranks below all others as response; rows that repeat an id are records
of their own (of equal ids with equal payloads one is the response). An empty table gives an archive without
records. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom import scale

SEGMENT, CHUNK, FILE_RECORDS = 32_768, 8_192, 2_048
REVISIT_BYTES = 1_000
# The revisit profile and the digest's name in WARC 1.1.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"


def _lines(*lines: tuple[str, Column]) -> Column:
    """``Name: value`` lines; a null value leaves its line out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")) for name, value in lines])


def _cut(column: Column, size: int) -> Column:
    """A string as an array of parts of ``size`` code points; at least one part."""
    count = F.greatest(F.lit(1), F.ceil(F.char_length(column) / F.lit(size))).cast("int")
    return F.transform(F.sequence(F.lit(1), count), lambda i: F.substring(column, (i - 1) * size + 1, F.lit(size)))


def _bytes(column: Column) -> Column:
    return F.octet_length(column).cast("string")


def with_originals(pages: DataFrame) -> DataFrame:
    """Pages with digest, payload length, a record id, and for revisits the record and page they refer to."""
    rows = pages.select(F.col("page_id").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("size", F.octet_length("html").cast("bigint"))
    name = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(":"),
                    F.lower(F.hex(F.monotonically_increasing_id())))
    rows = scale.stage(rows.withColumn("record", name), "pages")
    large = rows.filter(F.col("size") >= REVISIT_BYTES)
    first = F.max(F.struct("page_id", "record"))
    shared = (large.groupBy("digest").agg(first.alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1")
              .select("digest", "head"))
    # Only rows of shared payloads go through the join, without their html.
    marked = large.select("record", "digest").join(shared, "digest").filter(F.col("record") != F.col("head.record"))
    refers = scale.stage(marked.select("record", F.col("head.record").alias("refers_record")), "revisits")
    if refers.isEmpty():
        return rows.withColumn("refers_record", F.lit(None).cast("string"))
    return rows.join(refers, "record", "left")


def records(pages: DataFrame) -> DataFrame:
    """``value``: the text of every record of the archive, without its last line feed."""
    rows = with_originals(pages)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Transfer-Encoding: chunked\r\n\r\n"))
    body = F.array_join(F.transform(
        F.filter(_cut(F.col("html"), CHUNK), lambda c: c != ""),
        lambda c: F.concat(F.lower(F.hex(F.octet_length(c))), F.lit(CRLF), c, F.lit(CRLF))), "")
    revisit = F.col("refers_record").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, body, F.lit("0\r\n\r\n")))
    rows = rows.withColumn("block", block)
    parts = rows.select("record", "url", "digest", "refers_record", F.octet_length("block").alias("total"),
                        _cut(F.col("block"), SEGMENT).alias("parts"))
    one = parts.select("*", F.size("parts").alias("count"), F.posexplode("parts").alias("at", "part"))
    several, first = F.col("count") > 1, F.col("at") == 0
    last = F.col("at") == F.col("count") - 1
    revisits = F.col("refers_record").isNotNull()
    angle = F.concat(F.lit("<"), F.col("record"), F.lit(">"))
    head = F.concat(F.lit("WARC/1.1\r\n"), _lines(
        ("WARC-Type", F.when(~first, "continuation").when(revisits, "revisit").otherwise("response")),
        ("WARC-Record-ID", F.when(first, angle).otherwise(F.concat(F.lit("<"), F.col("record"), F.lit(":"), F.col("at") + 1, F.lit(">")))),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Target-URI", F.when(first & (F.col("url") != ""), F.regexp_replace("url", r"[\r\n]", " "))),
        ("Content-Type", F.when(first, F.lit("application/http; msgtype=response"))),
        ("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("digest")))),
        ("WARC-Profile", F.when(first & revisits, F.lit(PROFILE))),
        ("WARC-Refers-To", F.when(first & revisits, F.concat(F.lit("<"), F.col("refers_record"), F.lit(">")))),
        ("WARC-Segment-Number", F.when(several, (F.col("at") + 1).cast("string"))),
        ("WARC-Segment-Origin-ID", F.when(several & ~first, angle)),
        ("WARC-Segment-Total-Length", F.when(several & last, F.col("total").cast("string"))),
        ("Content-Length", _bytes(F.col("part")))), F.lit(CRLF))
    # The writer adds the last line feed of the two line ends after a block.
    return one.select(F.concat(head, F.col("part"), F.lit("\r\n\r")).alias("value"))


def write(pages: DataFrame, path: str) -> None:
    """Write the archive of a table of pages as a folder of files."""
    (records(pages).write.option("lineSep", "\n").option("maxRecordsPerFile", FILE_RECORDS)
     .option("compression", "gzip").text(path))


HEADER = re.compile(rb"([!-9;-~]+):[ \t]*([^\r\n]*)\r?\n")


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of every record of an archive file."""
    if data[:2] == b"\x1f\x8b":
        data = _members(data)
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        start = data.index(b"\n", at) + 1
        headers = {m[1].decode("latin-1").lower(): m[2].decode("utf-8", "replace").strip()
                   for m in HEADER.finditer(data, start, end + 2)}
        length = headers.get("content-length", "")
        if not length.isdigit():
            at = end
            continue
        block = data[end + 4:end + 4 + int(length)]
        yield headers, block
        at = end + 4 + int(length)


def _members(data: bytes) -> bytes:
    out = []
    while data[:2] == b"\x1f\x8b":
        decoder = zlib.decompressobj(31)
        out.append(decoder.decompress(data) + decoder.flush())
        data = decoder.unused_data
    return b"".join(out)


def dechunk(body: bytes) -> bytes:
    """Undo chunked transfer coding; raises ValueError when it is damaged."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size missing")
        size = int(body[at:end].split(b";")[0].strip(), 16)
        if size == 0:
            return b"".join(out)
        at = end + 2
        if len(body) < at + size + 2 or body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk cut off")
        out.append(body[at:at + size])
        at += size + 2


def payload(block: bytes) -> bytes:
    """The payload of an HTTP response."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("HTTP header cut off")
    headers = {m[1].decode("latin-1").lower(): m[2].strip().lower() for m in HEADER.finditer(head + b"\r\n")}
    if b"chunked" in headers.get("transfer-encoding", b""):
        body = dechunk(body)
    coding = headers.get("content-encoding", b"")
    if coding in (b"gzip", b"deflate"):
        body = zlib.decompress(body, 47)
    return body


COLUMNS = "record string, type string, url string, digest string, refers_record string, payload binary, problem string"


def _payload_row(record: dict, block: bytes | None, problem: str | None) -> dict:
    """A finished record; ``digest`` is that of the payload, or for a revisit the one it states."""
    out = {**record, "payload": None, "problem": problem}
    if problem is None and record["type"] == "response":
        try:
            out["payload"] = payload(block)
        except (ValueError, zlib.error) as error:
            out["problem"] = str(error)
        else:
            found = hashlib.sha1(out["payload"]).hexdigest()
            if record["digest"] and record["digest"] != found:
                out["problem"], out["payload"] = "payload digest differs", None
            out["digest"] = found
    return out


def _record(headers: dict[str, str]) -> dict:
    return {"record": headers.get("warc-record-id", "").strip("<>"), "type": headers.get("warc-type", ""),
            "url": headers.get("warc-target-uri", ""),
            "digest": headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "refers_record": headers.get("warc-refers-to", "").strip("<>") or None}


PARTS = ("origin string, number int, total bigint, block binary, record string, type string, url string, "
         "digest string, refers_record string")


def _parse_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in PARTS.split(", ")]
    for frame in frames:
        for content in frame["content"]:
            rows = []
            for headers, block in parse(content):
                made = _record(headers)
                number, total = headers.get("warc-segment-number"), headers.get("warc-segment-total-length")
                origin = headers.get("warc-segment-origin-id", "").strip("<>") or made["record"]
                if made["type"] in ("response", "revisit", "continuation"):
                    rows.append({**made, "origin": origin, "number": int(number) if number else None,
                                 "total": int(total) if total else None, "block": block})
            if not rows:
                continue
            out = pd.DataFrame(rows, columns=columns)
            yield out.astype({"number": "Int32", "total": "Int64"})


def _whole_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for r in frame.itertuples(index=False):
            record = {"record": r.record, "type": r.type, "url": r.url, "digest": r.digest, "refers_record": r.refers_record}
            rows.append(_payload_row(record, r.block, r.problem))
        if rows:
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in COLUMNS.split(", ")])


def read(spark: SparkSession, path: str) -> DataFrame:
    """Responses and revisits of all archive files in a folder, reassembled: ``record``, ``type``, ``url``,
    ``digest``, ``refers_record``, ``payload`` (null for revisits), ``problem``."""
    files = spark.read.format("binaryFile").load(path).select("content")
    parts = files.mapInPandas(_parse_rows, PARTS)
    whole = parts.filter("number is null").withColumn("problem", F.lit(None).cast("string"))
    # A group holds the segments of one record.
    piece = F.struct("number", "block", "total")
    grouped = parts.filter("number is not null").groupBy("origin").agg(
        F.array_sort(F.collect_list(piece)).alias("pieces"),
        *[F.max(F.when(F.col("number") == 1, F.col(c))).alias(c) for c in ("record", "type", "url", "digest", "refers_record")])
    size, last = F.size("pieces"), F.element_at("pieces", -1)
    joined = F.aggregate("pieces", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["block"]))
    ordered = F.transform("pieces", lambda p: p["number"]) == F.sequence(F.lit(1), size)
    problem = (F.when(~ordered, "segment missing or repeated").when(last["total"].isNull(), "last segment missing")
               .when(F.octet_length("block") != last["total"], "total length differs"))
    grouped = grouped.withColumn("block", joined).withColumn("problem", problem)
    grouped = grouped.withColumn("record", F.coalesce("record", "origin")).withColumn("type", F.coalesce("type", F.lit("response")))
    columns = ["record", "type", "url", "digest", "refers_record", "block", "problem"]
    return whole.select(*columns).union(grouped.select(*columns)).mapInPandas(_whole_rows, COLUMNS)


def page_of(record: Column) -> Column:
    """The page id in a record id that ``records`` made."""
    return F.regexp_extract(record, "^urn:page:(-?[0-9]+):", 1).try_cast("bigint")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the archive of the pages, read it back: one row per page with its payload's length and digest."""
    spark = pages.sparkSession
    path = f"{scale.shared_folder(spark)}/labelloom/warc-{uuid.uuid4().hex}"
    write(pages, path)
    found = read(spark, path).select(
        "record", "type", "digest", "refers_record", "problem", F.octet_length("payload").cast("bigint").alias("size"))
    found = scale.stage(found, "archive")
    # A revisit has the length of the response that it refers to.
    heads = found.filter("type = 'response'").join(
        found.filter("type = 'revisit'").select(F.col("refers_record").alias("record")).distinct(), "record", "left_semi")
    lengths = heads.select(F.col("record").alias("refers_record"), F.col("size").alias("of_head"))
    revisits = found.filter("type = 'revisit'").join(lengths, "refers_record", "left")
    both = found.filter("type = 'response'").withColumn("of_head", F.lit(None).cast("bigint")).unionByName(revisits)
    return both.select(
        page_of(F.col("record")).alias("page_id"), F.coalesce("size", "of_head").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
        page_of(F.col("refers_record")).alias("refers_to"), "problem")
