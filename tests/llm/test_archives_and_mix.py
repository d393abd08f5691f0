"""WARC round trips, source mixing, packing, nearest neighbours."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from newsloom.llm import graph_ann, mixing, packing, warc
from tests.llm.helpers import awkward, docs_frame, empty_docs, words

PAGES = "page_id long, url string, html string, payload string, digest int"


def pages_frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], PAGES).repartition(3)


def page_rows(rng):
    big = "x" * 999 + "é"
    tricky = "WARC/1.1\r\n\r\n\r\n0\r\n\r\nContent-Length: 5\r\n" * 40
    return [(1, "http://a/ b", None), (2, None, ""), (3, "u", big), (4, "u", big), (5, "u", big), (6, "u", "short"),
            (7, "u", "short"), (8, "u", tricky), (9, "ü", " ".join(words(rng, 30_000))), (None, "u", "nobody"),
            (11, "u", "y" * 1000), (12, "u", "z" * 999), (13, "u", "z" * 999)]


@pytest.mark.parametrize("segment", [warc.SEGMENT_BYTES, 300])
def test_round_trip(spark, segment):
    rows = page_rows(random.Random(1))
    same = collections.defaultdict(list)
    for i, _, h in rows:
        same[h or ""].append(i)
    expected = []
    for i, _, h in rows:
        b = (h or "").encode()
        keep = max(same[h or ""]) if len(b) >= 1000 else i
        expected.append((i, len(b), hashlib.sha1(b).hexdigest(), "response" if i == keep else "revisit",
                         None if i == keep else keep, True if i == keep else None))
    got = warc.round_trip(pages_frame(spark, rows), segment_bytes=segment)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete"]
    found = [(*r[:5], r["complete"] if r["record_type"] == "response" else None) for r in got.collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_round_trip_of_nothing(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_payloads_come_back_whole(spark, scratch):
    rows = page_rows(random.Random(2))
    warc.write_archives(pages_frame(spark, rows), f"{scratch}/w", segment_bytes=500, records_per_file=7)
    raw = warc.read_records(spark, f"{scratch}/w")
    assert raw.filter("warc_type = 'continuation'").count() > 300
    assert raw.filter("length > 500").count() == 0
    back = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.reassemble(raw).collect() if r["warc_type"] == "response"}
    for i, _, h in rows:
        if i not in (3, 4):
            assert back["" if i is None else str(i)] == (h or "")


def test_broken_segments_are_reported(spark, scratch):
    warc.write_archives(pages_frame(spark, [(1, "u", "a" * 3000), (2, "u", "b" * 3000)]), f"{scratch}/w", segment_bytes=1000)
    raw = warc.read_records(spark, f"{scratch}/w")
    cut = raw.filter("not (segment = 2 and origin_id = '%s')" % warc.record_id(1))
    got = {r["page_id"]: (r["complete"], r["payload_bytes"]) for r in warc.reassemble(cut.unionByName(cut)).collect()}
    assert got == {"1": (False, None), "2": (True, 3000)}


def test_chunked_framing():
    for data in (b"", b"a", b"x" * 40_000, b"0\r\n\r\n" * 9):
        assert warc.dechunk(warc.chunked(data, 1000)) == data
    assert warc.dechunk(b"5\r\nabc") is None
    assert warc.dechunk(b"zz\r\nabc") is None


def shares(sizes):
    """Targets by the contract's own steps."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, target, open_ = sum(sizes.values()), {}, set(order)
    while open_:
        left = total - sum(target.values())
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w > 3 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / w for s in open_}
        target |= {s: 3 * sizes[s] for s in over}
        open_ -= over
    return target


def test_mix(spark):
    rng = random.Random(3)
    rows = awkward(rng) + [(100 + i, " ".join(words(rng, rng.randrange(1, 60))), rng.choice(["a"] * 12 + ["b", "c", "d", "e", None]))
                           for i in range(1500)]
    docs = docs_frame(spark, rows)
    got = mixing.fair_mix(docs).collect()
    assert len(got) == len(rows)
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += len((t or "").encode().split())
    target = shares(size)
    taken = collections.Counter()
    for r in got:
        assert r["source_size"] == size[r["source"]]
        assert math.isclose(r["target"], target[r["source"]], rel_tol=1e-9)
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[r["source"]] += r["taken"]
    longest = max(r["size"] for r in got)
    assert sum(size.values()) - longest <= sum(taken.values()) <= sum(size.values())
    for s in size:
        biggest = max(r["size"] for r in got if r["source"] == s)
        assert abs(taken[s] - target[s]) <= longest + biggest
    again = mixing.fair_mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_mixed_rows(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(words(rng, 20)), "a" if i % 5 else "b") for i in range(200)] + [(7, "again the same id", "a")]
    docs = docs_frame(spark, rows)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    copies = collections.Counter(r["doc_id"] for r in out.collect())
    decided = collections.Counter()
    for r in mixing.fair_mix(docs).collect():
        decided[r["doc_id"]] += r["copies"]
    assert copies == +decided
    assert mixing.mix(empty_docs(spark)).count() == 0 and mixing.fair_mix(empty_docs(spark)).count() == 0


def test_mixed_rows_of_ids_in_two_sources(spark):
    """Every source's rows in the mix are what the mix takes of it."""
    rng = random.Random(5)
    rows = [(i % 100, " ".join(words(rng, 5 + i % 9)), "a" if i < 100 else "b") for i in range(200)] + \
        [(3, "one two three", "a")] * 40 + [(None, "null id here", "b")] * 3
    docs = docs_frame(spark, rows)
    taken = collections.Counter()
    for r in mixing.fair_mix(docs).collect():
        taken[r["source"]] += r["taken"]
    mixed = collections.Counter()
    for r in mixing.mix(docs).collect():
        mixed[r["source"]] += len(r["text"].split())
    assert mixed == +taken


def pack_checks(rows, capacity):
    bins = collections.defaultdict(list)
    for r in rows:
        assert 1 <= r["length"] <= capacity
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_against_the_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    rng = random.Random(5)
    rows = awkward(rng) + [(100 + i, " ".join(words(rng, rng.randrange(400))), "s") for i in range(80)] + [
        (300, "It's <|endoftext|> x<|startoftext|>y don't été   \x1c   İI Σσς ﬁ 中文 123 ²½", "s")]
    got = packing.pack_documents(docs_frame(spark, rows)).collect()
    assert len({tuple(r) for r in got}) == len(got)
    found = collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    expected = collections.Counter()
    for i, t, _ in rows:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at:at + 2048], "<u4")
            expected[(i, n, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert found == expected
    used = pack_checks(got, 2048)
    assert used <= math.ceil(sum(r["length"] for r in got) / 2048) + 2
    assert packing.pack_documents(empty_docs(spark)).count() == 0


def test_words_are_cached_by_their_small_letters(monkeypatch):
    import public_tokenizers
    from array import array
    path = public_tokenizers.path(packing.TOKENIZER)
    tokens = packing.WordTokens(path)
    texts = ["Foo foo FOO foo. Foo, It's it's", "<|ENDOFTEXT|> foo <|endoftext|> FOO", "H\u0331 h\u0331 I\u0307 Foo", "Éte été. Ångström! ß5a µ",
             "a" * 70 + ". " + "É" * 40 + ",x 中文Foo", ""]
    for t in texts:
        assert array("I", tokens.encode(t.encode())).tolist() == tokens.whole.encode(t, add_special_tokens=False).ids, t
    tokens.clear()
    tokens.encode(texts[0].encode())
    assert set(tokens) == {b"foo", b"foo.", b".", b"foo,", b",", b"it's", b"it", b"'s"}
    # Between generations nothing is lost; after a task one of them stays.
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)
    many = [f"{t} w{i}" for i, t in enumerate(texts * 3)]
    for t in many:
        assert array("I", tokens.encode(t.encode())).tolist() == tokens.whole.encode(t, add_special_tokens=False).ids, t
        assert len(tokens) <= 8 and len(tokens.old) <= 8
    import pyarrow as pa
    batch = pa.record_batch({"d": pa.array(range(len(many)), pa.int64()), "t": pa.array([t.encode() for t in many])})
    assert sum(b.num_rows for b in packing._pieces(path, 2048, pa.int64())([batch])) == len(many)
    assert packing.words_of(path).old == {}


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 2048])
    histogram = {n: rng.randrange(1, 50) for n in rng.sample(range(1, capacity + 1), min(capacity, 60))}
    pieces, taken = [], collections.Counter()
    for run in packing.plan(dict(histogram), capacity):
        assert run.first == taken[run.length]
        taken[run.length] += run.count
        for k in range(run.count):
            pieces.append({"sequence_id": run.bin + k // run.per_bin, "offset": run.offset + k % run.per_bin * run.length,
                           "length": run.length})
    assert dict(taken) == histogram
    used = pack_checks(pieces, capacity)
    large = collections.Counter(p["sequence_id"] for p in pieces if 3 * p["length"] > capacity)
    assert max(large.values(), default=0) <= 2
    total = sum(n * c for n, c in histogram.items())
    bound = max(math.ceil(total / capacity), sum(c for n, c in histogram.items() if 2 * n > capacity))
    assert used <= 1.25 * bound + 1


def brute(vectors, k, every=100):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in vectors
          if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    out = {}
    for i, v in ok:
        if i % every == 0:
            near = {}
            for j, u in ok:
                if j != i and len(u) == len(v):
                    d = math.sqrt(((u - v) ** 2).sum())
                    near[j] = min(d, near.get(j, d))
            out.setdefault(i, sorted((d, j) for j, d in near.items())[:k])
    return out


def vector_rows(rng, n):
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(n)]
    common = rng.normal(size=16).astype(np.float32).tolist()
    rows += [(5000 + i, common) for i in range(300)]  # one very common vector
    rows += [(9000, None), (9100, [0.0] * 16), (9200, [float("nan")] * 16), (9300, [float("inf")] + [1.0] * 15),
             (9400, [None] + [1.0] * 15), (None, common), (9500, [1.0, 2.0]), (9501, [1.0, 3.0]), (0, rows[0][1])]
    return rows


@pytest.mark.parametrize("shard_rows", [100_000, 300])
def test_nearest_neighbours(spark, shard_rows):
    rows = vector_rows(np.random.default_rng(1), 2500)
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int").repartition(4)
    got = collections.defaultdict(list)
    for r in graph_ann.search_all(table, shard_rows=shard_rows).collect():
        got[r["query_id"]].append((r["rank"], r["score"], r["vec_id"]))
    expected = brute(rows, 10)
    assert set(got) == set(expected)
    hits = total = 0
    for q, near in expected.items():
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, len(near) + 1))
        assert [(s, v) for _, s, v in found] == sorted((s, v) for _, s, v in found)
        assert all(math.isclose(s, dict((j, d) for d, j in brute_all(rows, q))[v], rel_tol=1e-12) for _, s, v in found[:2])
        hits += len({v for _, _, v in found} & {j for _, j in near})
        total += len(near)
    assert hits / total >= 0.9
    assert [v for _, _, v in sorted(got[5000])] == list(range(5001, 5011))  # ties by id
    assert [v for _, _, v in sorted(got[9500])] == [9501]


def brute_all(rows, q):
    return brute([r for r in rows if r[0] is not None], 10 ** 6, 1 if q % 100 else 100)[q]


@pytest.mark.parametrize("top", [1.0, 1e60, 1e200])
def test_scores_of_double_vectors(spark, top):
    """Scores are those of the original numbers, also beyond single
    precision's digits and range."""
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=8) * top).tolist()) for i in range(400)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = graph_ann.search_all(table).collect()
    exact = {q: {j: top * math.dist([c / top for c in dict(rows)[q]], [c / top for c in v]) for j, v in rows if j != q} for q in (0, 100, 200, 300)}
    assert len(got) == 40
    assert all(math.isclose(r["score"], exact[r["query_id"]][r["vec_id"]], rel_tol=1e-12) for r in got)
    hits = sum(r["vec_id"] in sorted(exact[r["query_id"]], key=exact[r["query_id"]].get)[:10] for r in got)
    assert hits >= 36


def test_nearest_of_nothing(spark):
    assert graph_ann.search_all(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_pruned_edges_are_diverse():
    x = np.random.default_rng(2).normal(size=(400, 8)).astype(np.float32)
    g = graph_ann.Graph(x)
    cand = np.tile(np.arange(1, 65, dtype=np.int32), (1, 1))
    kept = [i for i in g.prune(np.array([0]), cand)[0] if i >= 0]
    d = lambda a, b: ((x[a] - x[b]) ** 2).sum()
    for n, i in enumerate(kept):
        assert all(graph_ann.ALPHA ** 2 * d(j, i) > d(0, i) * (1 - 1e-4) for j in kept[:n])
