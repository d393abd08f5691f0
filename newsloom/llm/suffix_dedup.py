"""Repeated passages by a sparse suffix array.

Suffixes are retained only where the content selects them: at the positions
that have the smallest hash among neighbouring word groups (minimisers), so
that equal passages retain the same suffixes. The retained suffixes of all
documents are range-sorted on their first words, and neighbours in that order
are compared, also across the borders of the sorted ranges: a suffix whose
common prefix with a neighbour has ``KEY`` words is a match. A passage that
very many documents share is a long run of matches, spread over as many ranges
as it needs. The matches are then extended to the left and right: every
stretch of ``LENGTH`` words that holds one is compared with all others, and
overlapping stretches grow together into maximal passages.

A stretch of ``LENGTH`` words always holds a retained suffix with its first
``KEY`` words inside, so no repeated stretch is missed. Documents with the same
words are compared once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import BROADCAST_IDS, materialise, rows_named, shared_table, shuffle_partitions

LENGTH = 50
KEY = 20
GROUP = 8
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Words:
    """Rolling hashes over the words of a text."""

    def __init__(self, text: bytes | None):
        words = (text or b"").split()
        self.n = len(words)
        self.h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, self.n)
        up = np.full(self.n + 1, _BASE)
        back = np.full(self.n + 1, _BACK)
        up[0] = back[0] = 1
        self.back = np.multiply.accumulate(back)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.h * np.multiply.accumulate(up)[:-1], dtype=np.uint64)])

    def grams(self, k: int) -> np.ndarray:
        """Hashes of the k words from every position on."""
        m = self.n - k + 1
        return _mix((self.sums[k:] - self.sums[:m]) * self.back[:m]) if m > 0 else np.empty(0, np.uint64)

    def selected(self, length: int, key: int) -> np.ndarray:
        """For every stretch of ``length`` words the position of its retained
        suffix: the smallest word group whose key lies inside the stretch."""
        m = self.n - length + 1
        if m <= 0:
            return np.empty(0, np.int64)
        width = length - key + 1
        groups = self.grams(min(GROUP, key))
        view = np.lib.stride_tricks.sliding_window_view(groups, width)[:m]
        return view.argmin(axis=1) + np.arange(m)


def _print(w: Words) -> int:
    return xxhash.xxh3_64_intdigest(w.h.tobytes(), seed=w.n) - (1 << 63)


def _prints(batches):
    """Number of words of each text and what tells it from others."""
    for batch in batches:
        found = [(w.n, _print(w)) for w in (Words(text.as_py()) for text in batch.column(1))]
        yield pa.record_batch({"id": batch.column(0), "print": pa.array([p for _, p in found], pa.int64()),
                               "n": pa.array([n for n, _ in found], pa.int64())})


def _suffixes(length: int, key: int):
    """The retained suffixes of each text, with their first ``key`` words."""
    def run(batches):
        for batch in batches:
            ids, prints, places, prefixes = [], [], [], []
            for doc, text, expected in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                data = text.as_py() or b""
                w = Words(data)
                if _print(w) != expected:  # another text under the same id
                    continue
                words = data.split()
                for at in np.unique(w.selected(length, key)).tolist():
                    ids.append(doc)
                    prints.append(expected)
                    places.append(at)
                    prefixes.append(b" ".join(words[at:at + key]))
                if len(places) > 20_000:
                    yield _suffix_batch(ids, prints, places, prefixes)
                    ids, prints, places, prefixes = [], [], [], []
            if places:
                yield _suffix_batch(ids, prints, places, prefixes)
    return run


def _suffix_batch(ids, prints, places, prefixes):
    return pa.record_batch({"id": pa.array(ids, pa.int64()), "print": pa.array(prints, pa.int64()),
                            "place": pa.array(places, pa.int32()), "prefix": pa.array(prefixes, pa.binary())})


FIRST, LAST = 1, 2


def _neighbours(batches):
    """Of a sorted range, the suffixes that have their first words in common
    with the one before or behind, and its first and last one with their
    words, which the ranges beside it decide. The last row of a batch waits
    for the next batch. A suffix that comes twice (a repeated row) is one."""
    held = None

    def out(rows, found, edge, prefix):
        return pa.record_batch({
            "id": rows["id"], "print": rows["print"], "place": rows["place"], "part": rows["part"],
            "found": pa.array(found, pa.bool_()), "edge": pa.array(edge, pa.int32()), "prefix": pa.array(prefix, pa.binary())})

    names = ("id", "print", "place", "part", "prefix")
    for batch in batches:
        rows = {n: batch.column(batch.schema.get_field_index(n)) for n in names}
        if held is not None:
            rows = {n: pa.concat_arrays([held[0][n], rows[n]]) for n in names}
        if not len(rows["id"]):
            continue
        doc, place = rows["id"].to_numpy(), rows["place"].to_numpy()
        new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])])
        rows = {n: c.filter(pa.array(new)) for n, c in rows.items()}
        n = len(rows["id"])
        # Equal first words: a common prefix of at least their number.
        same = np.asarray(pc.equal(rows["prefix"].slice(1), rows["prefix"].slice(0, n - 1)).to_numpy(zero_copy_only=False), bool)
        before = np.concatenate([[held[1] if held is not None else False], same])
        edge = np.zeros(n, np.int32)
        edge[0] = FIRST if held is None else held[2]
        found = before.copy()
        found[:-1] |= same
        keep = np.flatnonzero((found | (edge > 0))[:n - 1])
        if len(keep):
            taken = {c: rows[c].take(pa.array(keep)) for c in names}
            prefix = [p if e else None for p, e in zip(taken["prefix"].to_pylist(), edge[keep])]
            yield out(taken, found[keep], edge[keep], prefix)
        held = ({c: rows[c].slice(n - 1) for c in names}, bool(before[-1]), int(edge[-1]))
    if held is not None:
        rows, found, edge = held
        yield out(rows, [found], [edge | LAST], rows["prefix"].to_pylist())


def matches(suffixes: DataFrame) -> DataFrame:
    """``id, print, place`` of the suffixes (``id, print, place, prefix``)
    whose prefix a neighbour in suffix order has too. Equal prefixes are
    ordered by id and place, so that any number of them can be spread."""
    order = ["prefix", "id", "place"]
    ranged = (suffixes.repartitionByRange(shuffle_partitions(suffixes), *order).sortWithinPartitions(*order)
              .withColumn("part", F.spark_partition_id()).select("id", "print", "place", "part", "prefix"))
    flagged = shared_table(ranged.mapInArrow(
        _neighbours, "id long, print long, place int, part int, found boolean, edge int, prefix binary"))
    # Two rows a range at most: each looks at the row of the range beside it.
    line = Window.orderBy("part", "edge")
    first, last = F.col("edge").bitwiseAND(FIRST) > 0, F.col("edge").bitwiseAND(LAST) > 0
    met = (flagged.filter("edge > 0").withColumn("_before", F.lag("prefix").over(line)).withColumn("_behind", F.lead("prefix").over(line))
           .filter(F.col("found") | (first & (F.col("prefix") == F.col("_before"))) | (last & (F.col("prefix") == F.col("_behind")))))
    return flagged.filter("found AND edge = 0").select("id", "print", "place").unionByName(met.select("id", "print", "place"))


def _batch(gram, ids, starts, heads):
    return pa.record_batch({"gram": pa.array(np.concatenate(gram)), "id": pa.array(np.concatenate(ids)),
                            "start": pa.array(np.concatenate(starts)), "head": pa.array(np.concatenate(heads))})


def _heads(gram: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Whether a stretch stands at the first place of its words in the text;
    places that overlap the first one count with it."""
    _, at, back = np.unique(gram, return_index=True, return_inverse=True)
    return start < start[at][back] + length


def _stretches(length: int, key: int):
    def run(batches):
        for batch in batches:
            gram, ids, starts, heads, size = [], [], [], [], 0
            for doc, text, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                w = Words(text.as_py())
                start = np.flatnonzero(np.isin(w.selected(length, key), np.asarray(places.as_py())))
                gram.append(w.grams(length)[start].view(np.int64))
                ids.append(np.full(len(start), doc, np.int64))
                starts.append(start.astype(np.int32))
                heads.append(_heads(gram[-1], start, length))
                size += len(start)
                if size > 100_000:
                    yield _batch(gram, ids, starts, heads)
                    gram, ids, starts, heads, size = [], [], [], [], 0
            if size:
                yield _batch(gram, ids, starts, heads)
    return run


def _grown(length: int):
    """Starts of repeated stretches, grown together into passages. In a text
    that has whole copies every stretch is repeated, first unless told
    otherwise."""
    def run(batches):
        for batch in batches:
            out = {"print": [], "start_word": [], "end_word": [], "first": []}
            for print_, n, copies, starts in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
                rows = sorted((r["start"], r["first"]) for r in starts.as_py())
                s = np.array([r[0] for r in rows])
                f = np.array([r[1] for r in rows])
                if copies > 1:
                    every = np.ones(max(n - length, s[-1]) + 1, bool)
                    every[s] = f
                    s, f = np.arange(len(every)), every
                cuts = np.flatnonzero((np.diff(s) > length) | (np.diff(f.astype(int)) != 0)) + 1
                for part, own in zip(np.split(s, cuts), np.split(f, cuts), strict=True):
                    out["print"].append(print_)
                    out["start_word"].append(int(part[0]))
                    out["end_word"].append(int(part[-1]) + length)
                    out["first"].append(bool(own[0]))
            yield pa.record_batch({"print": pa.array(out["print"], pa.int64()),
                                   "start_word": pa.array(out["start_word"], pa.int64()),
                                   "end_word": pa.array(out["end_word"], pa.int64()),
                                   "first": pa.array(out["first"], pa.bool_())})
    return run


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH,
                      key: int = KEY) -> DataFrame:
    """One row per passage of at least ``length`` words that occurs more than
    once: ``doc_id, start_word, end_word, n_words, first``.

    Words are runs without ASCII white space, numbered from 0; the passage
    is [start_word, end_word) and can't be longer. ``first`` tells whether
    it stands at its first place (places overlapping it included) in the
    document with the smallest id that has it; where that changes, the
    passage is cut. A document whose words are those of one with a smaller
    id is one passage as a whole, not first; of the one with the smallest id
    all words are repeated, and those passages that stand in still smaller
    ids are not first. Texts of fewer words (null, empty) have none, and documents
    without a repeated passage have no row. Rows repeating an id are copies
    of each other if their texts are. Ids are integers; rows with a null id
    take no part. An empty table gives an empty result; other columns are
    not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("binary").alias("t")).filter("id is not null")
    kept = shared_table(rows.mapInArrow(_prints, "id long, print long, n long").filter(f"n >= {length}"))
    same = materialise(kept.groupBy("print").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("n").alias("n")))
    reps = same.select(F.col("rep").alias("id"), "print")
    # 16 bytes each: texts stay where they are as long as that many are broadcast.
    few = reps.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    named = rows.join(F.broadcast(reps) if few else reps, "id").select("id", "t", "print")
    found = matches(named.mapInArrow(_suffixes(length, key), "id long, print long, place int, prefix binary")) \
        .groupBy("print").agg(F.collect_set("place").alias("places"))
    found = materialise(found.join(same, "print").select(F.col("rep").alias("id"), "print", "places", "copies", "n"))
    texts = rows_named(rows, "id", found.select("id")).dropDuplicates(["id"])
    grams = shared_table(texts.join(found.select("id", "places"), "id").select("id", "t", "places").mapInArrow(
        _stretches(length, key), "gram long, id long, start int, head boolean"))
    # Written down, so that the join with a stretch that very many documents have can be split.
    repeated = shared_table(grams.groupBy("gram").agg(
        F.min("id").alias("lo"), F.max("id").alias("hi"), F.min("start").alias("from"), F.max("start").alias("to"))
        .filter("lo <> hi or from <> to").select("gram", "lo"))
    starts = grams.join(repeated, "gram").groupBy("id").agg(F.collect_list(F.struct(
        "start", ((F.col("id") == F.col("lo")) & F.col("head")).alias("first"))).alias("starts"))
    spans = starts.join(found.select("id", "print", "n", "copies"), "id").select("print", "n", "copies", "starts").mapInArrow(
        _grown(length), "print long, start_word long, end_word long, first boolean")
    info = kept.select("id", "print", "n").join(same.drop("n"), "print")
    whole = info.filter("id <> rep").select(
        F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("start_word"), F.col("n").alias("end_word"), F.lit(False).alias("first"))
    # a text with copies but no passage of its own is first as a whole
    part = info.filter("id = rep").join(spans, "print", "left").filter("copies > 1 or start_word is not null").select(
        F.col("id").alias("doc_id"), F.coalesce("start_word", F.lit(0).cast("long")).alias("start_word"),
        F.coalesce("end_word", "n").alias("end_word"), F.coalesce("first", F.lit(True)).alias("first"))
    return whole.unionByName(part).withColumn("n_words", F.col("end_word") - F.col("start_word")).select(
        "doc_id", "start_word", "end_word", "n_words", "first")


def _cut(batches):
    import re
    word = re.compile(rb"[^\x20\x09-\x0D]+")
    for batch in batches:
        out = []
        for text, spans in zip(batch.column(1), batch.column(2), strict=True):
            data = text.as_py()
            at = [m.span() for m in word.finditer(data or b"")]
            merged: list[list[int]] = []
            for start, end in sorted((s["start_word"], s["end_word"]) for s in spans.as_py() or []):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            for start, end in reversed(merged):
                stop = at[end][0] if end < len(at) else len(data)
                data = data[:at[start][0]] + data[stop:]
            out.append(None if data is None else data.decode())
        yield pa.record_batch({"doc_id": batch.column(0), "text": pa.array(out, pa.string())})


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH,
                   key: int = KEY) -> DataFrame:
    """``doc_id, text`` with every repeated passage left only where it is
    ``first``. Texts without such a passage pass unchanged."""
    gone = repeated_passages(docs, id_col, text, length, key).filter("not first")
    spans = materialise(gone.groupBy(F.col("doc_id").alias("_id")).agg(
        F.collect_set(F.struct("start_word", "end_word")).alias("_spans")))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("_t"))
    return rows.join(spans, rows["doc_id"] == spans["_id"], "left").select("doc_id", "_t", "_spans").mapInArrow(
        _cut, "doc_id long, text string")
