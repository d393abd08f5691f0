"""Near-duplicate detection by min-max hashing.

Every permutation of a document's shingle hashes gives two signature values,
its minimum and its maximum, so 64 permutations give 128 values. Bands of
four values propose candidates; every link is confirmed on the full shingle
sets.

Candidates are never all pairs of a bucket. A first round links each
document to one bucket representative, which joins groups of copies of any
size with one candidate a document. In buckets that still hold several
components, documents outside the largest one are compared with all others
by their signatures; components with a pair that may reach the threshold
form a family. The documents of a family meet in blocks of bounded size,
where every such pair between components is tested on the full sets; only
the links found leave the task. No candidate, bucket or family is capped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import WORD, components, materialise, rows_named, shared_table

SHINGLE = 5
THRESHOLD = 75  # per cent
PERMUTATIONS = 64
#: Signature values of a band. 32 bands of 4 miss a pair of large sets at the
#: threshold with probability (1 - 0.75**4)**32 = 5e-6. In small sets minimum
#: and maximum exclude each other: 2.0e-5 for 6 of 8 shingles, 1.0e-4 for 3 of 4.
BAND = 4
#: Rows of a side that meet in one task.
BLOCK = 256
#: Share of equal signature values from which a pair is tested (a pair at
#: the threshold is below with probability 4e-6).
MAYBE = 0.58

_RNG = np.random.Generator(np.random.PCG64(20240229))
_MULTIPLY = (_RNG.integers(0, 1 << 63, 256, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64)
_PLACE = (_RNG.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word shingles of a text (A-Z
    lower-cased); of all its words if there are fewer than k."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) < k:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=len(h))], np.uint64)
    n = len(h) - k + 1
    s = h[:n] * _PLACE[0]
    for i in range(1, k):
        s = s + h[i:i + n] * _PLACE[i % SHINGLE]
    return np.unique(_mix(s))


def signature(shingles: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """Minima and maxima, side by side, under ``permutations`` permutations."""
    a, b = _MULTIPLY[:permutations, None], _ADD[:permutations, None]
    low = np.full(permutations, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(permutations, np.uint64)
    for at in range(0, len(shingles), 4096):
        v = shingles[None, at:at + 4096] * a + b
        np.minimum(low, v.min(axis=1), out=low)
        np.maximum(high, v.max(axis=1), out=high)
    return np.stack([low, high], axis=1).ravel()


def _sign(permutations: int, k: int):
    def run(batches):
        for batch in batches:
            count, prints, bands, sketch = [], [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), k)
                count.append(len(s))
                if not len(s):
                    prints.append(None)
                    bands.append(None)
                    sketch.append(None)
                    continue
                sig = signature(s, permutations)
                prints.append(xxhash.xxh3_128_digest(s.tobytes()))
                bands.append(_mix(sig.reshape(-1, BAND) @ _PLACE[:BAND]).view(np.int64))
                sketch.append((_mix(sig) & np.uint64(0xFFFF)).astype("<u2").tobytes())
            yield pa.record_batch({
                "id": batch.column(0), "h": batch.column(2), "n": pa.array(count, pa.int64()), "print": pa.array(prints, pa.binary()),
                "bands": pa.array(bands, pa.list_(pa.int64())), "sketch": pa.array(sketch, pa.binary())})
    return run


def _confirm(threshold: int, k: int):
    """Pairs whose full sets reach the threshold. Pairs come ordered by ``a``,
    so the set of a repeated side is made once."""
    def run(batches):
        last, own = None, None
        for batch in batches:
            a, b = [], []
            for x, y, tx, ty in zip(*(c for c in batch.columns), strict=True):
                x, y = x.as_py(), y.as_py()
                if x != last:
                    last, own = x, shingle_set(tx.as_py(), k)
                other = shingle_set(ty.as_py(), k)
                both = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * both >= threshold * (len(own) + len(other) - both):
                    a.append(x)
                    b.append(y)
            yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


#: Signature comparisons made at once.
PAIRS = 50_000


def _alike(sketch, left, right) -> np.ndarray:
    """Share of equal signature values of the pairs (left, right)."""
    out = np.empty(len(left))
    for at in range(0, len(left), PAIRS):
        cut = slice(at, at + PAIRS)
        out[cut] = (sketch[left[cut]] == sketch[right[cut]]).mean(axis=1)
    return out


class _Sets:
    """Union-find over component numbers, as they come."""

    def __init__(self):
        self.up: dict = {}

    def root(self, c):
        while (nxt := self.up.get(c, c)) != c:
            c = nxt
        return c

    def join(self, x, y) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def _starts(t: pa.Table, keys) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for name in keys:
        v = t.column(name).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def _by_block(keys, work):
    """Apply ``work`` to the whole blocks of a partition that comes sorted by
    ``keys``; of every batch the last block waits for the next one. A block
    has 2 * BLOCK rows or so."""
    def run(batches):
        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
            if not t.num_rows:
                continue
            at = int(_starts(t, keys)[-1])
            if at:
                yield work(t.slice(0, at).combine_chunks())
            rest = t.slice(at)
        if rest is not None and rest.num_rows:
            yield work(rest.combine_chunks())
    return run


def _sketches(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("sketch").to_pylist()), "<u2").reshape(t.num_rows, -1)


def _close(threshold: int):
    """Components with a pair, left against right rows of a block, that may
    reach the threshold; as few links as join them."""
    keys = ("band", "hash", "i", "j")

    def work(t: pa.Table) -> pa.RecordBatch:
        component, size, side = (t.column(n).to_numpy() for n in ("component", "n", "side"))
        sketch, starts = _sketches(t), _starts(t, keys)
        stops = np.append(starts[1:], t.num_rows)
        left_n = np.add.reduceat(side == 0, starts)
        right_n = stops - starts - left_n
        pairs = left_n * right_n
        out: set = set()

        def take(first: int, last: int) -> None:
            ln, rn, n = left_n[first:last], right_n[first:last], pairs[first:last]
            block = np.repeat(np.arange(first, last), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            per = np.repeat(np.maximum(rn, 1), n)
            x, y = starts[block] + at // per, starts[block] + left_n[block] + at % per
            lo, hi = np.minimum(size[x], size[y]), np.maximum(size[x], size[y])
            ok = (component[x] != component[y]) & (100 * lo >= threshold * hi)
            x, y, block = x[ok], y[ok], block[ok]
            ok = _alike(sketch, x, y) >= MAYBE
            found = np.unique(np.stack([block[ok], component[x[ok]], component[y[ok]]], axis=1), axis=0)
            for g in np.split(found, np.flatnonzero(np.diff(found[:, 0])) + 1) if len(found) else []:
                sets = _Sets()
                out.update((min(p, q), max(p, q)) for _, p, q in g.tolist() if sets.join(p, q))

        first, load = 0, 0
        for g, more in enumerate(pairs.tolist()):
            load += more
            if load > 4 * PAIRS:
                take(first, g + 1)
                first, load = g + 1, 0
        if first < len(starts):
            take(first, len(starts))
        return pa.record_batch({"a": pa.array([p for p, _ in out], pa.int64()), "b": pa.array([q for _, q in out], pa.int64())})
    return _by_block(keys, work)


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def _test(threshold: int, k: int):
    """Links between components in the blocks of a family, on full sets; one
    for each two components they join in the block."""
    keys = ("family", "i", "j")

    def work(t: pa.Table) -> pa.RecordBatch:
        rep, component, size, side = (t.column(n).to_numpy() for n in ("rep", "component", "n", "side"))
        sketch, texts, starts = _sketches(t), t.column("t"), _starts(t, keys)
        out_a, out_b = [], []
        for lo, hi in zip(starts, np.append(starts[1:], t.num_rows), strict=True):
            mid = lo + int((side[lo:hi] == 0).sum())
            sets, full = _Sets(), {}

            def of(row, full=full):
                if row not in full:
                    full[row] = shingle_set(texts[row].as_py(), k)
                return full[row]
            for y in range(mid, hi):
                x = np.arange(lo, mid)
                x = x[(component[x] != component[y]) & (100 * np.minimum(size[x], size[y]) >= threshold * np.maximum(size[x], size[y]))]
                if not len(x):
                    continue
                alike = _alike(sketch, x, np.full(len(x), y))
                for at in np.argsort(-alike, kind="stable").tolist():
                    if alike[at] < MAYBE:
                        break
                    row = int(x[at])
                    if sets.root(component[row]) == sets.root(component[y]):
                        continue
                    both = _shared(of(row), of(y))
                    if 100 * both >= threshold * (int(size[row]) + int(size[y]) - both):
                        sets.join(component[row], component[y])
                        out_a.append(min(rep[row], rep[y]))
                        out_b.append(max(rep[row], rep[y]))
        return pa.record_batch({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})
    return _by_block(keys, work)


def _blocks(buckets: DataFrame, reps: DataFrame, labels: DataFrame, block: int) -> DataFrame:
    """Rows (bucket, i, j, side, rep, n, component, sketch) of the buckets
    that hold more than one component. Right sides are the rows outside the
    bucket's largest component, in blocks j; left sides are all rows, in
    blocks i (the largest component's first). A pair of two outside rows
    meets in one block pair, i >= j."""
    rows = buckets.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep"))
    sizes = rows.groupBy("band", "hash", "component").agg(F.count(F.lit(1)).alias("c"))
    split = (sizes.groupBy("band", "hash").agg(F.max(F.struct("c", "component")).alias("top"), F.sum("c").alias("all"))
             .filter(F.col("all") > F.col("top.c"))
             .select("band", "hash", "top", "all", F.col("top.component").alias("major"),
                     F.ceil(F.col("top.c") / block).cast("int").alias("ms"),
                     F.ceil((F.col("all") - F.col("top.c")) / block).cast("int").alias("ss")))
    rows = rows.join(split, ["band", "hash"])
    outside = F.col("component") != F.col("major")
    part = F.pmod(F.xxhash64("rep"), F.when(outside, F.col("ss")).otherwise(F.col("ms"))).cast("int")
    rows = rows.withColumn("i", F.when(outside, F.col("ms") + part).otherwise(part))
    # left: for an outside row only right blocks up to its own, so that each
    # pair of blocks meets once
    left = rows.filter(~outside | (F.col("all") - F.col("top.c") > 1)).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.when(outside, part).otherwise(F.col("ss") - 1)))).withColumn("side", F.lit(0))
    right = (rows.filter(outside).withColumn("j", part)
             .withColumn("i", F.explode(F.array_union(
                 F.sequence(F.lit(0), F.col("ms") - 1),
                 F.sequence(F.col("ms") + F.col("j"), F.col("ms") + F.col("ss") - 1))))
             .withColumn("side", F.lit(1)))
    cols = ["band", "hash", "i", "j", "side", "rep", "component"]
    return left.select(*cols).unionByName(right.select(*cols)).join(reps.select("rep", "n", "sketch"), "rep")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: int = THRESHOLD,
                    k: int = SHINGLE, permutations: int = PERMUTATIONS, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked where 100 * |intersection| >= threshold * |union| of
    their distinct k-word shingles; component_id is the smallest id
    reachable. Texts without words (null, empty, blank) have an empty set and
    no link. Rows with equal sets are one candidate. Rows that repeat an id
    with the same text are marked alike; with different texts each is linked
    and marked by its own text, and of linked ones one text is kept. Ids are
    integers; a row with a null id takes no part and comes back with a null
    component, not kept (``keep_one`` keeps it). An empty table gives an
    empty result; other columns are not read.
    """
    marks = _marked(docs, id_col, text, threshold, k, permutations, block, False)
    return marks.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("c").alias("component_id"),
                        (F.col("kept") & F.col("id").isNotNull()).alias("kept"))


def _hash(text: str):
    """What names a text: 64 bits of its bytes. Ids may be null or repeated."""
    return F.xxhash64(F.col(text).cast("binary"))


def _marked(docs, id_col, text, threshold, k, permutations, block, nulls) -> DataFrame:
    """One row per row of ``docs``: id, h (the text's hash), n, c (smallest id
    of the component), kept. The kept text of a component is that of its
    smallest id, the smallest hash among several. With ``nulls`` rows
    without id are linked too; without, they have no component."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("binary").alias("t"), _hash(text).alias("h"))
    signed = materialise(rows.mapInArrow(_sign(permutations, k),
                                         "id long, h long, n long, print binary, bands array<long>, sketch binary"))
    prints = signed.filter("print is not null" if nulls else "print is not null and id is not null")
    # rows without id come last
    low = F.min(F.struct(F.col("id").isNull().alias("null"), "id", "h")).alias("low")
    smallest = materialise(prints.groupBy("print").agg(low).select("print", "low", F.col("low.h").alias("rep")))
    # one row per distinct set; its bands come from the row that stands for it
    reps = materialise(prints.join(smallest.select(F.col("print").alias("_p"), "rep"),
                        (F.col("print") == F.col("_p")) & (F.col("h") == F.col("rep")), "left_semi")
            .dropDuplicates(["h"]).select(F.col("h").alias("rep"), "n", "bands", "sketch"))
    placed = reps.select("rep", F.posexplode("bands").alias("band", "hash"))
    shared = placed.groupBy("band", "hash").agg(F.min("rep").alias("center"), F.max("rep").alias("last")) \
                   .filter("center <> last").drop("last")
    buckets = materialise(placed.join(shared, ["band", "hash"]))
    edges = _first_links(docs, buckets, text, threshold, k)
    labels = components(edges)
    links = _family_links(docs, buckets.drop("center"), reps, labels, text, threshold, k, block)
    if links.limit(1).count():
        labels = components(edges.unionByName(links))
    placed = smallest.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left")
    lows = placed.filter("component is not null").groupBy("component").agg(F.min("low").alias("_all"))
    of_print = placed.join(lows, "component", "left").select(
        F.col("print").alias("_p"), F.coalesce("_all", "low").alias("_low"))
    joined = signed.filter("print is not null").select("id", "h", "n", "print").join(
        of_print, F.col("print") == F.col("_p"), "left").select(
        "id", "h", "n", F.when(F.col("id").isNotNull() | F.lit(nulls), F.col("_low.id")).alias("c"),
        F.coalesce(F.col("id").eqNullSafe(F.col("_low.id")) & (F.col("h") == F.col("_low.h")), F.lit(False)).alias("kept"))
    empty = signed.filter("print is null").select("id", "h", "n", F.col("id").alias("c"), F.lit(True).alias("kept"))
    return joined.unionByName(empty)


def _family_links(docs, buckets, reps, labels, text, threshold, k, block) -> DataFrame:
    """All links between ``labels`` components that share a bucket, as few as
    join them within each block."""
    key = ["band", "hash", "i", "j"]
    close = _blocks(buckets, reps, labels, block).repartition(*key).sortWithinPartitions(*key, "side").mapInArrow(
        _close(threshold), "a long, b long")
    close = materialise(close.distinct())
    if not close.limit(1).count():
        return close
    family = components(close).select(F.col("id").alias("component"), F.col("component").alias("family"))
    rows = (reps.select("rep", "n", "sketch").join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left")
            .withColumn("component", F.coalesce("component", "rep")).join(family, "component"))
    rows = materialise(rows)
    blocks = rows.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("nb"))
    texts = _texts(docs, rows.select(F.col("rep").alias("k")), text)
    placed = (rows.join(blocks, "family").join(texts.withColumnRenamed("k", "rep"), "rep")
              .withColumn("_p", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int")))
    last = F.col("nb") - 1
    left = placed.withColumn("i", F.col("_p")).withColumn("j", F.explode(F.sequence(F.col("_p"), last))).withColumn("side", F.lit(0))
    right = placed.withColumn("j", F.col("_p")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("_p")))).withColumn("side", F.lit(1))
    cols = ["family", "i", "j", "side", "rep", "component", "n", "sketch", "t"]
    spread = left.select(*cols).unionByName(right.select(*cols))
    return materialise(spread.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "side").mapInArrow(
        _test(threshold, k), "a long, b long"))


def _texts(docs, hashes, text) -> DataFrame:
    """(k, t) of the texts with the materialised ``hashes`` (k)."""
    rows = docs.select(_hash(text).alias("k"), F.col(text).cast("binary").alias("t"))
    return shared_table(rows_named(rows, "k", hashes).dropDuplicates(["k"]))


def _first_links(docs, buckets, text, threshold, k) -> DataFrame:
    """Each row of a bucket proposes the representative it shares most bands
    with; one candidate per document."""
    votes = buckets.filter("rep <> center").groupBy("rep", "center").agg(F.count(F.lit(1)).alias("v"))
    best = votes.groupBy("rep").agg(F.max(F.struct("v", (-F.col("center")).alias("c"))).alias("m"))
    pairs = materialise(best.select((-F.col("m.c")).alias("a"), F.col("rep").alias("b")))
    return _verified(docs, pairs, text, threshold, k)


def _verified(docs, pairs, text, threshold, k) -> DataFrame:
    """The pairs (a, b) whose texts hold. Only texts named in a pair move."""
    if not pairs.limit(1).count():
        return pairs
    named = materialise(pairs.select(F.col("a").alias("k")).union(pairs.select(F.col("b").alias("k"))).distinct())
    texts = _texts(docs, named, text)
    both = (pairs.join(texts.select(F.col("k").alias("b"), F.col("t").alias("tb")), "b")
                 .join(texts.select(F.col("k").alias("a"), F.col("t").alias("ta")), "a"))
    return materialise(both.select("a", "b", "ta", "tb").sortWithinPartitions("a").mapInArrow(
        _confirm(threshold, k), "a long, b long"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stand for their group; all columns. Rows
    without id are linked too; where a group has no others, one row of its
    smallest text hash stands for it. Texts without words all stay."""
    marks = materialise(_marked(docs, id_col, text, threshold, SHINGLE, PERMUTATIONS, BLOCK, True).filter("kept"))
    # id and text as one number; a row that stands for its group is never lost by an equal one
    name = lambda i, h: F.xxhash64(i, h)
    kept = materialise(marks.select(name(F.col("id"), F.col("h")).alias("_k")).distinct())
    i = F.col(id_col).cast("long")
    keyed = docs.select(name(i, _hash(text)).alias("_k"), (i.isNull() & F.coalesce(F.col(text).cast("string").rlike(WORD), F.lit(
        False))).alias("_bare"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    out = rows_named(keyed, "_k", kept)
    if marks.filter("id is null and n > 0").limit(1).count():
        out = out.filter(~F.col("_bare")).unionByName(out.filter("_bare").dropDuplicates(["_k"]))
    return out.select("_row.*")
