"""Exact de-duplication by two-pass Bloom filtering.

Pass 1 builds a counting Bloom filter with saturating two-bit counters over
a hash of every normalised text; pass 2 tests every row. Only rows whose
counters say "maybe seen twice" are shuffled and grouped by their SHA-256;
all other rows pass straight through.

The filter has a documented bound (``max_filter_bits``): it grows with the
row count up to that bound. Beyond it more rows are sent through the exact
grouping, and the result stays the same.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import materialise, shuffle_partitions

BITS_PER_ROW = 16
#: Upper bound of the broadcast filter: 2**28 bits are 32 MB.
MAX_FILTER_BITS = 1 << 28
SEGMENT_BITS = 1 << 16
SPACE = b" \t\n\x0b\x0c\r"


def _places(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Per text: a 64-bit segment hash and four 16-bit places in the segment."""
    raw = b"".join(xxhash.xxh3_128_digest((t or b"").translate(None, SPACE)) for t in texts)
    halves = np.frombuffer(raw, dtype="<u8").reshape(-1, 2)
    return halves[:, 0], np.frombuffer(raw, dtype="<u2").reshape(-1, 8)[:, 4:]


def _marks(segments: int):
    """Pass 1, per task: places set once and places set by two rows."""
    def run(batches):
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            head, places = _places(batch.column(0).to_pylist())
            seg = (head % np.uint64(segments)).astype(np.int64)
            order = np.argsort(seg, kind="stable")
            cuts = np.flatnonzero(np.diff(seg[order])) + 1
            for rows in np.split(order, cuts):
                if not len(rows):
                    continue
                s = int(seg[rows[0]])
                bits, counts = np.unique(places[rows], return_counts=True)
                old = once.get(s)
                rep = bits[counts > 1]
                if old is not None:
                    rep = np.union1d(rep, np.intersect1d(bits, old, assume_unique=True))
                    bits = np.union1d(bits, old)
                once[s] = bits
                if len(rep):
                    twice[s] = np.union1d(rep, twice[s]) if s in twice else rep
        keys = list(once)
        for i in range(0, len(keys), 256):
            part = keys[i:i + 256]
            yield pa.record_batch({
                "segment": pa.array(part, pa.int32()),
                "once": pa.array([once[k].astype("<u2").tobytes() for k in part], pa.binary()),
                "twice": pa.array([twice[k].astype("<u2").tobytes() if k in twice else b"" for k in part],
                                  pa.binary())})
    return run


def _merge(batches):
    """Saturating sum of the tasks' marks by segment; 16 KB a segment."""
    acc: dict[int, np.ndarray] = {}
    for batch in batches:
        for s, once, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            seen = acc.setdefault(s, np.zeros((2, SEGMENT_BITS), dtype=bool))
            bits = np.frombuffer(once, dtype="<u2")
            seen[1, bits[seen[0, bits]]] = True
            seen[0, bits] = True
            seen[1, np.frombuffer(twice, dtype="<u2")] = True
    for s, seen in acc.items():
        if seen[1].any():
            yield pa.record_batch({"segment": pa.array([s], pa.int32()),
                                   "bits": pa.array([np.packbits(seen[1]).tobytes()], pa.binary())})


def repeat_filter(docs: DataFrame, text: str = "text", bits_per_row: int = BITS_PER_ROW,
                  max_filter_bits: int = MAX_FILTER_BITS):
    """Pass 1: a broadcast ``{segment: bitmap}`` of places that at least two
    rows share, and the number of segments."""
    rows = docs.count()
    segments = int(max(1, min(max_filter_bits, bits_per_row * rows) // SEGMENT_BITS))
    marks = docs.select(F.col(text).cast("binary").alias("t")).mapInArrow(
        _marks(segments), "segment int, once binary, twice binary")
    merged = marks.repartition(min(segments, shuffle_partitions(docs)), "segment").mapInArrow(
        _merge, "segment int, bits binary")
    # bounded by max_filter_bits / 8 bytes
    return docs.sparkSession.sparkContext.broadcast(
        {r["segment"]: bytes(r["bits"]) for r in merged.collect()}), segments


def _test(filter_, segments: int):
    """Pass 2: adds the SHA-256 of the normalised text and the flag."""
    def run(batches):
        bitmap = {s: np.unpackbits(np.frombuffer(b, dtype=np.uint8)).astype(bool)
                  for s, b in filter_.value.items()} if segments <= 512 else None
        raw = filter_.value
        for batch in batches:
            col = batch.schema.get_field_index("_t")
            texts = batch.column(col).to_pylist()
            norm = [(t or b"").translate(None, SPACE) for t in texts]
            head, places = _places(norm)
            seg = (head % np.uint64(segments)).tolist()
            maybe = []
            for s, p in zip(seg, places, strict=True):
                if bitmap is not None:
                    hit = bitmap.get(s)
                    maybe.append(hit is not None and bool(hit[p].all()))
                else:
                    b = raw.get(s)
                    maybe.append(b is not None and all(b[x >> 3] & (128 >> (x & 7)) for x in p.tolist()))
            out = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if i != col}
            out["_sha"] = pa.array([hashlib.sha256(t).digest() for t in norm], pa.binary())
            out["_maybe"] = pa.array(maybe, pa.bool_())
            yield pa.record_batch(out)
    return run


def _flagged(docs: DataFrame, id_col: str, text: str, bits_per_row: int, max_filter_bits: int) -> DataFrame:
    filter_, segments = repeat_filter(docs, text, bits_per_row, max_filter_bits)
    t = F.col(text)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("_id"), F.length(F.coalesce(t, F.lit(""))).cast("long").alias("_n"),
                       t.cast("binary").alias("_t")).mapInArrow(
        _test(filter_, segments), f"_id {kind}, _n long, _sha binary, _maybe boolean")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                 bits_per_row: int = BITS_PER_ROW, max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept,
    text_sha256``.

    Texts are equal when identical after deleting ASCII white space; a null
    text counts as empty, so null and blank texts form one group. Of a group
    the longest original text (code points), then the smallest id stays; a
    null id comes last, and a null id that stays marks its row as kept. Rows
    that repeat both id and text of the kept row are all marked as kept. An
    empty table gives an empty result; other columns are not read.
    """
    flagged = materialise(_flagged(docs, id_col, text, bits_per_row, max_filter_bits))
    alone = flagged.filter("not _maybe").select(
        "_id", F.col("_id").alias("_keep"), F.lit(1).cast("long").alias("_size"), "_sha")
    maybe = flagged.filter("_maybe")
    groups = maybe.groupBy("_sha").agg(
        F.count(F.lit(1)).alias("_size"),
        F.min(F.struct((-F.col("_n")).alias("n"), F.isnull("_id").alias("none"), F.col("_id").alias("id")))
         .alias("_first"))
    grouped = maybe.select("_id", "_sha").join(
        groups.select("_sha", "_size", F.col("_first.id").alias("_keep")), "_sha")
    return alone.unionByName(grouped).select(
        F.col("_id").alias("doc_id"), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                bits_per_row: int = BITS_PER_ROW, max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, in all their columns, one per group.

    Rows that can't have a copy never move. Of the others only the ids and
    hashes are grouped; the texts of the kept ones are fetched by (hash, id),
    and rows repeating both are reduced to one.
    """
    filter_, segments = repeat_filter(docs, text, bits_per_row, max_filter_bits)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                         F.col(text).cast("binary").alias("_t"))
    row_type = packed.schema["_row"].dataType.simpleString()
    tested = packed.mapInArrow(_test(filter_, segments), f"_row {row_type}, _sha binary, _maybe boolean")
    maybe = materialise(tested.filter("_maybe").select(
        "_row", "_sha", F.col("_row").getField(id_col).alias("_id")))
    keep = maybe.groupBy("_sha").agg(F.min(F.struct(
        (-F.length(F.coalesce(F.col("_row").getField(text), F.lit("")))).alias("n"),
        F.isnull("_id").alias("none"), F.col("_id").alias("id"))).alias("_first")).select(
        F.col("_sha").alias("_ks"), F.col("_first.id").alias("_kid"))
    kept = maybe.join(keep, (F.col("_sha") == F.col("_ks")) & F.col("_id").eqNullSafe(F.col("_kid")), "left_semi")
    one = kept.dropDuplicates(["_sha", "_id"]).select("_row.*")
    return tested.filter("not _maybe").select("_row.*").unionByName(one)
