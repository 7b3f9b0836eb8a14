"""Operator 5, WARC: archives are written, and read back by reassembling segments.

Writing: each page is a record whose block is an HTTP message with its payload in chunked transfer framing.
Of records with equal payloads of at least `least` bytes, that with the largest page_id is the response and
the others revisit it. A block longer than `segment_bytes` is cut: the first part is the record itself, the
others are continuation records, all naming the origin record, their number and, in the last, the total
length. Spark's text writer puts the records, ended by two line ends, into gzip files of a bounded number of records in the
shared folder.

Reading: each archive is unpacked as a stream and walked by Content-Length, a record at a time. Whole records are decoded at once; segments are grouped by
origin identifier, ordered by number, checked against the total length and the payload digest, and then
decoded. Only segments move between tasks, and a group is one page's block.

Null html is an empty payload; a null page_id stays null. Rows that repeat a page_id are records of their
own; among equal payloads all rows with the largest page_id are responses. Nulls never equal each other.
"""

from __future__ import annotations

import hashlib
import io

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import sketch
from factloom.llm.common import materialise, scratch_path, slices

END = b"\r\n"
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def chunked(payload: bytes, size: int) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        line = body.index(END, at)
        n = int(body[at:line].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        if body[line + 2 + n : line + 4 + n] != END:
            raise ValueError("a chunk has another length than it says")
        out.append(body[line + 2 : line + 2 + n])
        at = line + 4 + n


def headers(block: bytes) -> tuple[bytes, dict[str, str], int]:
    """First line, fields by lower-case name, and where the body starts."""
    stop = block.index(END + END)
    first, *rest = block[:stop].split(END)
    fields = (x.decode().split(":", 1) for x in rest)
    return first, {k.lower(): v.strip() for k, v in fields}, stop + 4


def record(fields: dict[str, object], block: bytes) -> bytes:
    """A record without the two line ends after its block."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block


def walk(archive):
    """(fields, block) of each record of a stream, which is read one record at a time."""
    while True:
        first = archive.readline()
        if not first:
            return
        if first != b"WARC/1.1\r\n":
            raise ValueError("no record starts where one should")
        fields = {}
        while (line := archive.readline()) != END:
            if not line.endswith(END):
                raise ValueError("an archive ends within a record's fields")
            name, value = line.decode().split(":", 1)
            fields[name.lower()] = value.strip()
        block = archive.read(int(fields["content-length"]))
        if archive.read(4) != END + END:
            raise ValueError("a record has another length than it says")
        yield fields, block


def page_records(page_id, url, payload: bytes, digest: str, target, record_id: str, segment_bytes: int, chunk_bytes: int) -> list[bytes]:
    common = {"WARC-Record-ID": record_id, "WARC-Date": "2024-01-01T00:00:00Z", "WARC-Target-URI": " ".join((url or "").split()), "WARC-Payload-Digest": f"sha1:{digest}", "X-Page-ID": page_id, "Content-Type": "application/http;msgtype=response"}
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if target is not None:
        block = head + b"Content-Length: %d\r\n\r\n" % len(payload)
        return [record({"WARC-Type": "revisit", **common, "WARC-Refers-To": f"page:{target}", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}, block)]
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        return [record({"WARC-Type": "response", **common}, block)]
    out = [record({"WARC-Type": "response", **common, "WARC-Segment-Number": 1}, parts[0])]
    for i, part in enumerate(parts[1:], 2):
        fields = {"WARC-Type": "continuation", "WARC-Record-ID": f"{record_id}/{i}", "WARC-Date": common["WARC-Date"], "WARC-Segment-Origin-ID": record_id, "WARC-Segment-Number": i}
        out.append(record(fields | ({"WARC-Segment-Total-Length": len(block)} if i == len(parts) else {}), part))
    return out


def finish(fields: dict[str, str], block: bytes) -> tuple:
    """A result row from a record's own fields and its whole block."""
    _, http, start = headers(block)
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    page = int(fields["x-page-id"]) if "x-page-id" in fields else None
    if fields["warc-type"] == "revisit":
        return page, int(http["content-length"]), digest, "revisit", int(fields["warc-refers-to"].removeprefix("page:"))
    payload = unchunked(block[start:])
    if hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"the payload of page {page} has another digest")
    return page, len(payload), digest, "response", None


def write_archives(pages: DataFrame, path: str, least: int = 1000, segment_bytes: int = 16_384, chunk_bytes: int = 4096, file_records: int = 10_000) -> None:
    """Write pages(page_id, url, html) as gzip WARC files of at most file_records records.

    Pages that surely revisit none stay where they are; only the others are joined with what they may refer to.
    """
    body = F.coalesce("html", F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", body.alias("payload"))
    body = F.col("payload")
    keyed = pages.select("page_id", F.sha1(body).alias("digest"), F.octet_length(body).alias("size")).where((F.col("size") >= least) & F.col("page_id").isNotNull())
    copies = keyed.groupBy("digest", "size").agg(F.max("page_id").alias("target"), F.min("page_id").alias("least_id")).where("target <> least_id").drop("least_id")
    revisits = materialise(keyed.join(copies, ["digest", "size"]).where("page_id <> target").select("page_id", "digest", "target").distinct(), "revisits")
    ids = revisits.select("page_id").distinct()
    some, rest = sketch.parted(pages, "page_id", ids, ids.count())
    marked = some.withColumn("digest", F.sha1(body)).join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "payload", "digest", "target")
    if rest is not None:
        marked = marked.unionByName(rest.select("page_id", "url", "payload", F.sha1(body).alias("digest"), F.lit(None).cast("long").alias("target")))

    def build(batches):
        part, row = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "payload"):
            out = []
            for r in batch.to_pylist():
                out += page_records(r["page_id"], r["url"], r["payload"], r["digest"], r["target"], f"urn:page:{part}:{row}", segment_bytes, chunk_bytes)
                row += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    records = marked.mapInArrow(build, "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", file_records).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page in the archives of a folder."""
    import gzip

    def split(batches):
        names = ["origin", "number", "total", "fields", "block", "whole"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.bool_()]
        for batch in batches:
            for content in batch["content"]:
                rows: list[tuple] = []
                size = 0
                for fields, block in walk(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))):
                    number = int(fields.get("warc-segment-number", 0))
                    origin = fields.get("warc-segment-origin-id", fields["warc-record-id"])
                    total = fields.get("warc-segment-total-length")
                    kept = "\n".join(f"{k}:{v}" for k, v in fields.items() if fields["warc-type"] != "continuation")
                    rows.append((origin, number, total and int(total), kept, block, number == 0))
                    size += len(block)
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def decode(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                parts = sorted(r["parts"], key=lambda p: p["number"])
                block = b"".join(p["block"] for p in parts)
                if len(parts) > 1:
                    if [p["number"] for p in parts] != list(range(1, len(parts) + 1)) or parts[-1]["total"] != len(block):
                        raise ValueError(f"segments of {r['origin']} are missing")
                rows.append(finish(dict(x.split(":", 1) for x in parts[0]["fields"].split("\n")), block))
            cols = zip(*rows, strict=True) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    found = files.mapInArrow(split, "origin string, number long, total long, fields string, block binary, whole boolean")
    part = F.struct("number", "total", "fields", "block")
    # One walk over the archives feeds both kinds: a record without segments is a group of its own, so only
    # segments take part in the shuffle.
    found = materialise(found, "warc-records")
    alone = found.where("whole").select("origin", F.array(part).alias("parts"))
    joined = found.where("NOT whole").groupBy("origin").agg(F.collect_list(part).alias("parts"))
    return alone.unionByName(joined).mapInArrow(decode, RESULT)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, **options)
    return read_archives(spark, path)
