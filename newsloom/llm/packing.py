"""Best-fit packing of tokenised documents into fixed-size sequences.

Lengths take at most ``capacity`` different values, so the packing itself is
worked out on their histogram: documents above one third of the capacity are
matched greedily, at most two to a bin, then the smaller ones fill the
tightest gaps, longest first. The plan is a list of runs ("the next n pieces
of length l go to bins b.., q to a bin, from offset o"); pieces are numbered
within their length by a distributed running count and look up their run.
"""

from __future__ import annotations

import bisect
import re
import zlib
from array import array
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import materialise, prefix_sum, release_unused

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
#: Entries of a generation of a worker's cache of words and their pieces; two
#: generations are kept (about 45 MB), between tasks one.
CACHE_WORDS = 170_000

# --- tokens ---------------------------------------------------------------

_LETTERS = "a-zß-öø-ÿ"
#: Words this simple need no Unicode normalisation: ASCII and Latin-1 letters.
_SIMPLE = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9!-/:-@\[-`{-~]+")
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[!-/:-@\[-`{{-~]+")
#: Most words: one piece of letters, or one and a stop.
_PLAIN = re.compile(rf"([{_LETTERS}]+)([.,]?)")
#: First bytes of characters beyond Latin-1.
_WIDE = re.compile(rb"[\xc4-\xff]")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others
    are numbered from 256."""
    out, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out[b] = chr(b)
        else:
            out[b], extra = chr(256 + extra), extra + 1
    return out


class WordTokens(dict):
    """Ids of white-space separated words, cached. The tokenizer drops white
    space and never merges across it, so a text's ids are those of its words
    in turn. Simple words are split as the tokenizer's own pattern does and
    only their pieces go through the BPE model; all others (special tokens,
    scripts that need normalising) go through the whole tokenizer. Pieces are
    cached among the words: as a word, a piece is itself its only piece."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        special = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        self.special = re.compile("|".join(map(re.escape, sorted(special))) or "(?!)")
        self.special_bytes = re.compile(self.special.pattern.encode())
        self.none_plain = not any(re.fullmatch(r"[^\W\d_]*[.,]?", t) for t in special)
        letters = _byte_letters()
        self.letters = str.maketrans({chr(i): "".join(letters[b] for b in chr(i).encode()) for i in range(33, 256)})
        # The words of the generation before: what is still asked for moves
        # to the new one, the rest goes.
        self.old: dict[bytes, bytes] = {}

    def _model_ids(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _ids(self, text: str) -> bytes:
        plain = self.none_plain and _PLAIN.fullmatch(text)
        if plain:
            letters, stop = plain.groups()
            return self[letters.encode()] + self[stop.encode()] if stop else self._model_ids(letters)
        if not _SIMPLE.fullmatch(text) or self.special.search(text):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        pieces = _PIECE.findall(text.lower())
        return self._model_ids(text) if pieces == [text] else b"".join([self[p.encode()] for p in pieces])

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._ids(word.decode())
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        """The ids as native 32-bit integers."""
        # The tokenizer lower-cases. Done here, fewer words differ; but not
        # where it may compose letters before, or know a special token.
        if not _WIDE.search(text):
            lower = text.lower()
            if not self.special_bytes.search(lower):
                text = lower
        return b"".join(map(self.__getitem__, text.split()))


_loaded: dict[str, WordTokens] = {}


def words_of(path: str) -> WordTokens:
    """One tokenizer a worker process, kept between tasks."""
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]


def _pieces(path: str, capacity: int, id_type: pa.DataType):
    width = 4 * capacity
    end = array("I", [0]).tobytes()

    def run(batches):
        tokens = words_of(path)
        try:
            for batch in batches:
                ids, piece, start, length, crc = [], [], [], [], []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    data = tokens.encode(text.as_py() or b"") + end
                    for n, at in enumerate(range(0, len(data), width)):
                        part = data[at:at + width]
                        ids.append(doc)
                        piece.append(n)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(np.frombuffer(part, "=u4").astype("<u4").tobytes()))
                yield pa.record_batch({"doc_id": pa.array(ids, id_type), "piece": pa.array(piece, pa.int32()),
                                       "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                                       "ids_crc32": pa.array(crc, pa.int64())})
        finally:
            batch = text = None
            tokens.old = {}
            release_unused()
    return run


def token_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text",
                 capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: every document's ids plus
    the closing id 0, cut only where it is longer than ``capacity``."""
    from pyspark.sql.pandas.types import to_arrow_type
    kind = docs.schema[id_col].dataType
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("binary").alias("t")).mapInArrow(
        _pieces(path, capacity, to_arrow_type(kind)),
        f"doc_id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long")


# --- the plan ---------------------------------------------------------------

class Run(NamedTuple):
    """``count`` pieces of ``length``, from number ``first`` on: ``per_bin``
    to a bin, from bin ``bin`` on, the first of each at ``offset``."""
    length: int
    first: int
    count: int
    per_bin: int
    bin: int
    offset: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Pack ``{length: pieces}`` into bins. At most ``capacity`` lengths go
    in, and a run comes out per step, so the plan is small at any input size."""
    left = {n: c for n, c in histogram.items() if c > 0}
    used = dict.fromkeys(left, 0)
    runs: list[Run] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first bin, bins)
    bins = 0

    def put(length, count, per_bin, bin_, offset):
        runs.append(Run(length, used[length], count, per_bin, bin_, offset))
        used[length] += count
        left[length] -= count

    def free(gap, bin_, count):
        if gap > 0 and count > 0:
            gaps.setdefault(gap, []).append((bin_, count))

    # Large ones: each takes the largest partner that still fits.
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        if not left[n]:
            large.pop()
            continue
        at = bisect.bisect_right(large, capacity - n) - 1
        while at >= 0 and not left[large[at]]:
            large.pop(at)
            at -= 1
        if at < 0:
            count = left[n]
            put(n, count, 1, bins, 0)
            free(capacity - n, bins, count)
            bins += count
            continue
        m = large[at]
        count = min(left[n], left[m]) if m != n else left[n] // 2
        if not count:  # a single one left of the length that pairs with itself
            lower = at - 1
            while lower >= 0 and not left[large[lower]]:
                lower -= 1
            if lower < 0:
                put(n, 1, 1, bins, 0)
                free(capacity - n, bins, 1)
                bins += 1
                continue
            m, count = large[lower], 1
        put(n, count, 1, bins, 0)
        put(m, count, 1, bins, n)
        free(capacity - n - m, bins, count)
        bins += count

    # Small ones, longest first, each into the tightest gap that holds it.
    order = sorted(gaps)
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect.bisect_left(order, n)
            if at == len(order):  # open bins
                fit = capacity // n
                gap, bin_, count = capacity, bins, -(-left[n] // fit)
                bins += count
            else:
                gap = order[at]
                bin_, count = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    order.pop(at)
                fit = gap // n
            full = min(count, left[n] // fit)
            rest = min(left[n] - full * fit, fit - 1) if full < count else 0
            if full:
                put(n, full * fit, fit, bin_, capacity - gap)
            if rest:
                put(n, rest, rest, bin_ + full, capacity - gap)
            for g, b, c in ((gap - fit * n, bin_, full), (gap - rest * n, bin_ + full, 1 if rest else 0),
                            (gap, bin_ + full + (1 if rest else 0), count - full - (1 if rest else 0))):
                if g > 0 and c > 0 and g not in gaps:
                    bisect.insort(order, g)
                free(g, b, c)
    return runs


def _place(table):
    """Look up each piece's run: runs of a length are ordered by their first."""
    def run(batches):
        by_length = table.value
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            number = batch.column(batch.schema.get_field_index("_number")).to_numpy() - 1
            sequence = np.zeros(len(length), np.int64)
            offset = np.zeros(len(length), np.int64)
            for n in np.unique(length):
                rows = np.flatnonzero(length == n)
                own = by_length[int(n)]
                at = own[np.searchsorted(own[:, 0], number[rows], side="right") - 1]
                within = number[rows] - at[:, 0]
                sequence[rows] = at[:, 2] + within // at[:, 1]
                offset[rows] = at[:, 3] + within % at[:, 1] * n
            keep = [i for i, f in enumerate(batch.schema.names) if f != "_number"]
            yield pa.record_batch({batch.schema.names[i]: batch.column(i) for i in keep}
                                  | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)})
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ``pieces`` (doc_id, piece,
    start, length, ids_crc32). Only the histogram of lengths, at most
    ``capacity`` rows, reaches the driver; the plan made from it is
    broadcast."""
    pieces = materialise(pieces)
    runs = plan({r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()},
                capacity)
    table: dict[int, list] = {}
    for r in runs:
        table.setdefault(r.length, []).append((r.first, r.per_bin, r.bin, r.offset))
    shared = pieces.sparkSession.sparkContext.broadcast({n: np.array(v, np.int64) for n, v in table.items()})
    numbered = prefix_sum(pieces.withColumn("_one", F.lit(1).cast("long")),
                          ["doc_id", "piece", "ids_crc32"], "_one", by=["length"], out="_number").drop("_one")
    kind = pieces.schema["doc_id"].dataType.simpleString()
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "_number").mapInArrow(
        _place(shared), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, "
                        "sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text",
                   capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``.

    A null or empty text is the closing id alone, one piece of length 1. A
    repeated row is packed again. Null ids are kept. An empty table gives no
    rows. Other columns are not read. ``path`` is the tokenizer file
    (default: the public word-level BPE of the box).
    """
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(TOKENIZER)
    return pack(token_pieces(docs, path, id_col, text, capacity), capacity)
