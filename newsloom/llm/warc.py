"""WARC archives: writing records in segments and reading them back.

Writing: payloads become HTTP responses in chunked transfer framing; blocks
longer than a segment are cut into a first record and ``continuation``
records. Reading: continuation records are grouped by their origin's id,
ordered by segment number, checked against the stated total length, and the
chunked framing is decoded. Records in one segment are never shuffled.

Files are written by Spark's text sink with the record terminator as its
line separator, so they are committed like any other Spark output and reach
any file system that Spark does. A file holds a bounded number of bounded
records, hence reading one whole file into a row is bounded too.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import materialise
from newsloom.session import ensure_checkpoint_dir

SEGMENT_BYTES = 64 * 1024
CHUNK_BYTES = 16 * 1024
RECORDS_PER_FILE = 1000
MIN_REVISIT_BYTES = 1000
END = b"\r\n\r\n"
#: Fixed record date, so that a rerun writes the same bytes.
DATE = "2024-01-01T00:00:00Z"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- which records repeat another one's payload ----------------------------

def revisits(pages: DataFrame, id_col: str = "page_id", uri: str = "url", payload: str = "html",
             min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, uri, payload`` (binary), ``digest`` (hex SHA-1) and
    ``refers`` (id of the response, null for a response) of all ``pages``.

    Equal payloads of at least ``min_bytes`` have one response, the largest
    id; smaller ones take no part in the join, so a hot short payload moves
    nowhere. Counting is partial before the shuffle, and a hot digest is a
    plain join key that adaptive execution splits.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(uri).cast("string").alias("uri"),
                        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload")) \
                .withColumn("digest", F.sha1("payload"))
    long_ones = F.octet_length("payload") >= min_bytes
    keep = (rows.filter(long_ones).groupBy(F.col("digest").alias("_d"))
            .agg(F.max("page_id").alias("_keep"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"))
    paired = rows.filter(long_ones).join(keep, F.col("digest") == F.col("_d"), "left").drop("_d")
    short = rows.filter(~long_ones).withColumn("_keep", F.lit(None).cast(rows.schema["page_id"].dataType))
    return paired.unionByName(short).withColumn(
        "refers", F.when(~F.col("page_id").eqNullSafe(F.col("_keep")), F.col("_keep"))).drop("_keep")


# --- writing ----------------------------------------------------------------

def record_id(key) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{key}')}>"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join(parts) + b"0\r\n\r\n"


def _head(kind: str, rid: str, length: int, fields: list[tuple[str, str]]) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}", f"WARC-Date: {DATE}",
             *[f"{k}: {v}" for k, v in fields], f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + END


def records_of(key, uri: str | None, payload: bytes, digest: str, refers, segment_bytes: int) -> list[bytes]:
    """The record or records of one page, without the closing blank lines."""
    rid = record_id(key)
    uri = "".join(c for c in (uri or "") if c > " ")
    about = [*([("WARC-Target-URI", uri)] if uri else []), ("WARC-Page-ID", "" if key is None else str(key)),
             ("WARC-Payload-Digest", f"sha1:{digest}")]
    kind = ("Content-Type", "application/http; msgtype=response")
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers is not None:
        block = head + b"Content-Length: %d\r\n\r\n" % len(payload)
        return [_head("revisit", rid, len(block), [
            *about, ("WARC-Profile", IDENTICAL), ("WARC-Refers-To", record_id(refers)),
            ("WARC-Refers-To-Page-ID", str(refers)), kind]) + block]
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment_bytes:
        return [_head("response", rid, len(block), [*about, kind]) + block]
    cuts = range(0, len(block), segment_bytes)
    out = []
    for n, at in enumerate(cuts, 1):
        part = block[at:at + segment_bytes]
        number = ("WARC-Segment-Number", str(n))
        if n == 1:
            out.append(_head("response", rid, len(part), [*about, kind, number]) + part)
            continue
        own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{key}:{n}')}>"
        total = [("WARC-Segment-Total-Length", str(len(block)))] if n == len(cuts) else []
        out.append(_head("continuation", own, len(part), [
            *about[:-2], ("WARC-Segment-Origin-ID", rid), number, *total]) + part)
    return out


def _write_batches(segment_bytes: int):
    def run(batches):
        for batch in batches:
            keys, uris, digests, refers = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            out, size = [], 0
            for i, payload in enumerate(batch.column(2)):
                for rec in records_of(keys[i], uris[i], payload.as_py(), digests[i], refers[i], segment_bytes):
                    out.append(rec)
                    size += len(rec)
                    if size > 4 << 20:
                        yield pa.record_batch({"r": pa.array(out, pa.binary())})
                        out, size = [], 0
            if out:
                yield pa.record_batch({"r": pa.array(out, pa.binary())})
    return run


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", uri: str = "url", payload: str = "html",
                   segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write ``pages`` as gzip-compressed WARC files under ``path``."""
    rows = revisits(pages, id_col, uri, payload)
    records = rows.select("page_id", "uri", "payload", "digest", "refers").mapInArrow(
        _write_batches(segment_bytes), "r binary")
    (records.select(F.col("r").cast("string").alias("value")).write.mode("error")
     .option("lineSep", END.decode()).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


# --- reading ----------------------------------------------------------------

_FIELDS = ("type", "record_id", "origin_id", "segment", "total", "length", "uri", "page_id", "digest", "refers_to")
RECORD = ("warc_type string, record_id string, origin_id string, segment int, total long, length long, uri string, "
          "page_id string, digest string, refers_to string, block binary")
_SCHEMA = pa.schema([
    ("warc_type", pa.string()), ("record_id", pa.string()), ("origin_id", pa.string()), ("segment", pa.int32()),
    ("total", pa.int64()), ("length", pa.int64()), ("uri", pa.string()), ("page_id", pa.string()),
    ("digest", pa.string()), ("refers_to", pa.string()), ("block", pa.binary())])


def inflate(data: bytes) -> bytes:
    """Content of a file of gzip members, or the bytes themselves."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data) + member.flush())
        data = member.unused_data
    return b"".join(out) if out else data


def parse_records(data: bytes):
    """Records of one archive, by their stated lengths."""
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        stop = data.find(END, at)
        if stop < 0:
            return
        fields = {}
        for line in data[at:stop].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields.get("content-length", 0))
        start = stop + 4
        yield fields, data[start:start + length]
        at = start + length


def _read_batches(batches):
    whole = lambda x: int(x) if x else None
    for batch in batches:
        for content in batch.column(0):
            rows, size = [], 0
            for f, block in parse_records(inflate(content.as_py())):
                digest = f.get("warc-payload-digest", "")
                rows.append({
                    "warc_type": f.get("warc-type"), "record_id": f.get("warc-record-id"),
                    "origin_id": f.get("warc-segment-origin-id"), "segment": whole(f.get("warc-segment-number")),
                    "total": whole(f.get("warc-segment-total-length")), "length": int(f.get("content-length", 0)),
                    "uri": f.get("warc-target-uri"), "page_id": f.get("warc-page-id"),
                    "digest": digest.partition(":")[2] or None, "refers_to": f.get("warc-refers-to-page-id"),
                    "block": block})
                size += len(block)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def read_records(spark, path: str) -> DataFrame:
    """The raw records of the archives under ``path``, segments apart."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(_read_batches, RECORD)


def dechunk(body: bytes) -> bytes | None:
    """Payload of a chunked body; None where the framing is broken or cut."""
    parts, at = [], 0
    while True:
        stop = body.find(b"\r\n", at)
        if stop < 0:
            return None
        try:
            size = int(body[at:stop].split(b";")[0], 16)
        except ValueError:
            return None
        at = stop + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size:at + size + 2] != b"\r\n":
            return None
        parts.append(body[at:at + size])
        at += size + 2


def _decode(batches):
    for batch in batches:
        cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        size, sha, body = [], [], []
        for blocks, complete, kind in zip(cols["blocks"], cols["complete"].to_pylist(),
                                          cols["warc_type"].to_pylist(), strict=True):
            head, _, rest = b"".join(b or b"" for b in blocks.as_py()).partition(END)
            lines = head.lower().split(b"\r\n")
            payload = None
            if kind == "revisit":
                n = next((int(x.split(b":")[1]) for x in lines if x.startswith(b"content-length:")), None)
                size.append(n)
                sha.append(None)
                body.append(None)
                continue
            if complete:
                payload = dechunk(rest) if any(x.replace(b" ", b"") == b"transfer-encoding:chunked" for x in lines) else rest
            size.append(None if payload is None else len(payload))
            sha.append(None if payload is None else hashlib.sha1(payload).hexdigest())
            body.append(payload)
        out = {n: c for n, c in cols.items() if n != "blocks"}
        yield pa.record_batch(out | {"payload": pa.array(body, pa.binary()), "payload_bytes": pa.array(size, pa.int64()),
                                     "payload_digest": pa.array(sha, pa.string())})


def reassemble(records: DataFrame) -> DataFrame:
    """One row per response or revisit: ``warc_type, record_id, uri, page_id,
    digest, refers_to, complete, payload, payload_bytes, payload_digest``.

    Only segmented records shuffle: by origin id, ordered by segment number,
    joined where the numbers run from 1 without a gap and the last one's
    total length is that of the joined block; otherwise the row stays with
    ``complete`` false and a null payload. A repeated segment counts once. A
    revisit has the length and digest its record states.
    """
    head = ["warc_type", "record_id", "uri", "page_id", "digest", "refers_to"]
    alone = records.filter("segment is null").select(
        *head, (F.octet_length("block") == F.col("length")).alias("complete"), F.array("block").alias("blocks"))
    segmented = records.filter("segment is not null")
    parts = segmented.groupBy(F.coalesce("origin_id", "record_id").alias("record_id")).agg(
        *[F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in head if c != "record_id"],
        F.max("total").alias("total"),
        F.array_sort(F.collect_set(F.struct("segment", "block"))).alias("parts"))
    # The blocks are joined once, where they are decoded.
    joined = parts.select(
        *head, ((F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p["block"])) == F.col("total"))
                & (F.element_at("parts", -1)["segment"] == F.size("parts"))
                & (F.element_at("parts", 1)["segment"] == 1)).alias("complete"),
        F.col("parts")["block"].alias("blocks")).filter("warc_type is not null")
    return alone.unionByName(joined).mapInArrow(
        _decode, "warc_type string, record_id string, uri string, page_id string, digest string, refers_to string, "
                 "complete boolean, payload binary, payload_bytes long, payload_digest string")


def round_trip(pages: DataFrame, path: str | None = None, id_col: str = "page_id", uri: str = "url",
               payload: str = "html", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Write all ``pages`` to archives and read them back: ``page_id,
    payload_bytes, payload_digest, record_type, refers_to, complete``.

    A null payload is the empty one; null urls have no target; a null id
    comes back as null. Rows repeating an id are written as they are, so
    they should be made unique first. ``path`` defaults to a new folder
    below the shared checkpoint folder.
    """
    spark = pages.sparkSession
    if path is None:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, id_col, uri, payload, segment_bytes)
    kind = pages.schema[id_col].dataType
    records = materialise(reassemble(read_records(spark, path)).drop("payload"))
    own = lambda c: F.when(F.col(c) != "", F.col(c)).cast(kind)
    return records.select(
        own("page_id").alias("page_id"), "payload_bytes",
        F.coalesce("payload_digest", F.when(F.col("warc_type") == "revisit", F.col("digest"))).alias("payload_digest"),
        F.col("warc_type").alias("record_type"), own("refers_to").alias("refers_to"), "complete")
