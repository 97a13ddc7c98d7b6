"""WARC archives: written with revisits and segments, read back by reassembly.

Writing: a page's payload goes into an HTTP response with chunked framing. Of equal
payloads of a least size one is a response and the others are revisits of it. A block
longer than a segment is spread over a first record and continuation records. Spark's
text writer puts the records into gzip files of a bounded number of records, on any file
system it can reach.

Reading: files are parsed by their records' content lengths. Continuations are grouped
by the record they continue, ordered by segment number and checked against the total
length; then the chunked framing is decoded. Records that are not segmented are not
shuffled.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import settle

SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4096
FILE_RECORDS = 1000
REVISIT_BYTES = 1000
END = "\r\n\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

_PARSED = ("record_id string, record_type string, origin string, number int, total long, "
           "refers_to string, target string, declared_digest string, block binary")


def payload_digest(html: Column) -> Column:
    return F.sha1(F.coalesce(html, F.lit("")).cast("binary"))


def write_archive(pages: DataFrame, path: str, date: str, least: int = REVISIT_BYTES,
                  segment: int = SEGMENT_BYTES) -> None:
    """Write one record per page (``page_id, url, html``), with continuations, below ``path``.

    Of rows with equal payloads of at least ``least`` bytes, the one with the largest id is
    the response. A null payload is empty. Rows without an id are responses among
    themselves and revisits of a copy that has one. Rows that repeat an id and a payload
    are all written. Other columns are not read. An empty table writes no record.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", body.alias("html"), payload_digest(F.col("html")).alias("digest"))
    large = F.octet_length("html") >= least
    # the key of small payloads is unlike any other, so they do not meet in one task
    rows = rows.withColumn("key", F.when(large, F.col("digest")).otherwise(
        F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.col("digest")))))
    copies = rows.where(large).groupBy("key").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
    copies = settle(copies.where("n > 1 and kept is not null").select(F.col("key").alias("copy_key"), "kept"), "copies")
    rows = rows.join(copies, F.col("key") == F.col("copy_key"), "left")
    revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    rows = rows.select("page_id", "url", "html", "digest", F.when(revisit, F.col("kept")).alias("kept"),
                       F.monotonically_increasing_id().alias("row"))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page in batch.to_pylist():
                out.extend(_records(page, date, segment))
            yield pa.record_batch([pa.array(out, pa.binary()).cast(pa.string())], names=["record"])

    (rows.mapInArrow(records, "record string").write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))


def _records(page: dict, date: str, segment: int) -> list[bytes]:
    own = _record_id(page["page_id"], page["row"])
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", page["url"] or "") or "urn:none"
    shared = [("WARC-Date", date), ("WARC-Target-URI", target)]
    http = [("Content-Type", "application/http; msgtype=response")]
    digest = [("WARC-Payload-Digest", f"sha1:{page['digest']}")]
    if page["kept"] is not None:
        refers = [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{page['kept']}>")]
        return [_record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *shared, *digest, *refers, *http], HTTP_HEAD)]
    parts = list(_cuts(HTTP_HEAD + _chunked(page["html"].encode()), segment))
    total = sum(map(len, parts))
    out = []
    for k, part in enumerate(parts, 1):
        number = [("WARC-Segment-Number", str(k))] if len(parts) > 1 else []
        if k == 1:
            head = [("WARC-Type", "response"), ("WARC-Record-ID", own), *shared, *digest, *number, *http]
        else:
            head = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{k}>"), *shared, *number,
                    ("WARC-Segment-Origin-ID", own)]
            if k == len(parts):
                head.append(("WARC-Segment-Total-Length", str(total)))
        out.append(_record(head, part))
    return out


def _record_id(page_id: int | None, row: int) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{row}>"


def _record(head: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*head, ("Content-Length", str(len(block)))])
    return b"WARC/1.0\r\n" + lines.encode() + b"\r\n" + block


def _cuts(data: bytes, size: int) -> Iterator[bytes]:
    """Parts of about ``size`` bytes that do not cut a character."""
    begin = 0
    while begin < len(data) or begin == 0:
        end = min(begin + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        yield data[begin:end]
        begin = max(end, 1)


def _chunked(payload: bytes) -> bytes:
    chunks = [b"%x\r\n%b\r\n" % (len(c), c) for c in _cuts(payload, CHUNK_BYTES) if c]
    return b"".join(chunks) + b"0\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names lower-cased) and block of each record of an unpacked archive."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        begin = stop + 4
        end = begin + int(head["content-length"])
        yield head, data[begin:end]
        at = end + 4


def unpack(content: bytes) -> bytes:
    """The bytes of a file of one or several gzip members; other files as they are."""
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content:
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        content = member.unused_data
    return b"".join(out)


def decode_block(block: bytes) -> tuple[bytes | None, str | None]:
    """Payload of an HTTP response block, and what is wrong with it if anything is."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return None, "no HTTP head"
    if not re.search(rb"(?im)^transfer-encoding:[ \t]*chunked", head):
        return body, None
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        try:
            size = int(body[at:line].split(b";")[0], 16) if line >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            return None, "bad chunk size"
        if size == 0:
            return b"".join(out), None
        begin = line + 2
        if body[begin + size:begin + size + 2] != b"\r\n":
            return None, "chunk cut short"
        out.append(body[begin:begin + size])
        at = begin + size + 2


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``record_id, record_type, refers_to, target, declared_digest, payload, problem`` per capture.

    A payload is null where ``problem`` says why: a missing or repeated segment, a total length
    that differs, or broken framing. Revisits have an empty payload of their own. A file is
    read whole by one task, a capture's segments meet in one; neither grows with the archive.
    """
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _PARSED.split(", ")]
        kinds = [pa.string()] * 3 + [pa.int32(), pa.int64()] + [pa.string()] * 3 + [pa.binary()]
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for head, block in parse_records(unpack(content.as_py())):
                    number, total = head.get("warc-segment-number"), head.get("warc-segment-total-length")
                    rows.append((head.get("warc-record-id"), head.get("warc-type"), head.get("warc-segment-origin-id"),
                                 int(number) if number else None, int(total) if total else None,
                                 head.get("warc-refers-to"), head.get("warc-target-uri"),
                                 (head.get("warc-payload-digest") or "").removeprefix("sha1:") or None, block))
                columns = zip(*rows) if rows else [[]] * len(names)
                yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    parsed = files.mapInArrow(parse, _PARSED)
    named = ["record_id", "record_type", "refers_to", "target", "declared_digest"]
    whole = parsed.where("number is null").select(*named, F.array("block").alias("blocks"), F.lit(None).cast("string").alias("problem"))
    pieces = parsed.where("number is not null").withColumn("capture", F.coalesce("origin", "record_id"))
    first = [F.max(F.when(F.col("origin").isNull(), F.col(c))).alias(c) for c in named]
    gathered = pieces.groupBy("capture").agg(
        *first, F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"))
    order = F.transform("parts", lambda p: p["number"])
    total = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p["block"]))
    joined = gathered.select(
        *named, F.transform("parts", lambda p: p["block"]).alias("blocks"),
        F.when(F.col("record_id").isNull(), "no first segment")
        .when(F.col("total").isNull() | (order != F.sequence(F.lit(1), F.size("parts"))), "segment missing or repeated")
        .when(total != F.col("total"), "total length differs").alias("problem"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a capture's segments are joined once, here
            found = [(None, p) if p else (b"", None) if kind == "revisit" else decode_block(b"".join(b.as_py()))
                     for b, p, kind in zip(*(batch.column("blocks"), *(batch.column(c).to_pylist() for c in ("problem", "record_type"))))]
            yield pa.record_batch([*[batch.column(c) for c in named], pa.array([f[0] for f in found], pa.binary()),
                                   pa.array([f[1] for f in found], pa.string())], names=[*named, "payload", "problem"])

    return whole.union(joined).mapInArrow(decode, ", ".join(f"{c} string" for c in named) + ", payload binary, problem string")


def page_id_of(record_id: Column) -> Column:
    """The page id that ``write_archive`` puts into record ids."""
    return F.nullif(F.regexp_extract(record_id, r"^<urn:page:(-?\d*)", 1), F.lit("")).cast("long")
