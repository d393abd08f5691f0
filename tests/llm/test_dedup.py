"""Exact, near and passage de-duplication against brute force."""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from newsloom.llm import bloom_dedup, common, minmax_dedup, suffix_dedup
from tests.llm.helpers import awkward, docs_frame, empty_docs, words

SPACE = re.compile("[\x20\x09-\x0d]")


def exact_expected(rows):
    groups = collections.defaultdict(list)
    for i, t, _ in rows:
        groups[SPACE.sub("", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t, _ in rows:
        key = SPACE.sub("", t or "")
        keep = min(groups[key])[3]
        out.append((i, keep, len(groups[key]), i == keep, hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [1 << 16, 1 << 28])
def test_exact_groups(spark, bits):
    rng = random.Random(1)
    rows = awkward(rng) + [(100 + i, " ".join(words(rng, 3, 6)), "s") for i in range(300)]
    got = bloom_dedup.exact_groups(docs_frame(spark, rows), max_filter_bits=bits)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == exact_expected(rows)
    assert bloom_dedup.exact_groups(empty_docs(spark)).count() == 0


def test_exact_stage_keeps_one_row_and_all_columns(spark):
    rng = random.Random(2)
    rows = awkward(rng) + [(100 + i, " ".join(words(rng, 3, 6)), "s") for i in range(300)]
    docs = docs_frame(spark, rows)
    out = bloom_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    expected = {r[1] for r in exact_expected(rows)}
    got = [r["doc_id"] for r in out.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert bloom_dedup.deduplicate(empty_docs(spark)).count() == 0


def test_unique_rows_do_not_shuffle(spark):
    """Rows the filter clears are not in the grouped side."""
    docs = docs_frame(spark, [(i, f"text {i} of its own", "s") for i in range(500)])
    flagged = bloom_dedup._flagged(docs, "doc_id", "text", 16, 1 << 28)
    assert flagged.filter("_maybe").count() == 0


def near_expected(rows, threshold=75):
    sets, ids = {}, collections.defaultdict(list)
    for i, t, _ in rows:
        if i is None:
            continue
        w = (t or "").encode().lower().split()
        s = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
        sets[i] = s
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    keys = list(sets)
    for a in range(len(keys)):
        for b in range(a):
            x, y = sets[keys[a]], sets[keys[b]]
            if x and y and 100 * len(x & y) >= threshold * len(x | y):
                up[max(root(keys[a]), root(keys[b]))] = min(root(keys[a]), root(keys[b]))
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def families(rng, n_families, size, edits):
    """Texts that drift: each copies an earlier one of its family with some
    words changed, so chains and star-like groups arise."""
    rows, i = [], 10
    for _ in range(n_families):
        members = [words(rng, rng.randrange(40, 160))]
        for _ in range(size):
            base = list(rng.choice(members))
            for _ in range(rng.choice(edits)):
                base[rng.randrange(len(base))] = f"x{rng.randrange(10 ** 6)}"
            members.append(base)
        for m in members:
            rows.append((i, " ".join(m), "s"))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [256, 8])
def test_near_duplicates_match_brute_force(spark, block):
    rng = random.Random(3)
    rows = awkward(rng) + families(rng, 12, 25, [0, 1, 2, 3, 5, 8])
    got = minmax_dedup.near_duplicates(docs_frame(spark, rows), block=block)
    expected = near_expected(rows)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    seen = got.collect()
    assert len(seen) == len(rows)
    for r in seen:
        if r["doc_id"] is None:
            assert r["component_id"] is None and not r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == expected[r["doc_id"]], r


def test_near_duplicates_of_nothing(spark):
    assert minmax_dedup.near_duplicates(empty_docs(spark)).count() == 0
    docs = docs_frame(spark, [(1, None, "a"), (2, "", "a")])
    assert {tuple(r) for r in minmax_dedup.near_duplicates(docs).collect()} == {(1, 0, 1, True), (2, 0, 2, True)}


def test_keep_one_has_one_row_a_group(spark):
    rng = random.Random(4)
    rows = families(rng, 6, 10, [0, 1, 2])
    docs = docs_frame(spark, rows)
    out = minmax_dedup.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(i for i, v in near_expected(rows).items() if v[2])


def test_keep_one_with_null_and_repeated_ids(spark):
    rng = random.Random(10)
    base, other, lone, bare = (words(rng, 60) for _ in range(4))
    near = [*base[:-1], "x"]
    rows = [(1, " ".join(base), "a"), (None, " ".join(near), "b"),          # linked to 1: gone
            (None, " ".join(lone), "c"), (None, " ".join(lone), "d"),       # one of both
            (None, " ".join([*lone[:-1], "y"]), "e"),                       # linked to them
            (None, " ".join(bare), "f"),                                    # alone
            (None, None, "g"), (None, " ", "h"),                            # no words, no link
            (5, " ".join(other), "i"), (5, " ".join(words(rng, 60)), "j"),  # one id, two texts
            (5, " ".join([*other[:-1], "z"]), "k"),                         # linked to the first
            (6, " ".join([*other[:-2], "z", "z"]), "l"),                    # linked to 5
            (5, " ".join([*base[:-2], "v", "v"]), "m")]                     # linked to 1
    docs = docs_frame(spark, rows)
    out = minmax_dedup.keep_one(docs)
    assert out.columns == docs.columns
    got = [r["source"] for r in out.collect()]
    assert len(got) == len(set(got))
    assert {"a", "f", "g", "h", "j"} <= set(got) and not set(got) & set("blm")
    assert len(set(got) & set("cde")) == 1 and len(set(got) & set("ik")) == 1 and len(got) == 7
    marks = collections.Counter((r["doc_id"], r["component_id"], r["kept"]) for r in minmax_dedup.near_duplicates(docs).collect())
    assert marks == {(1, 1, True): 1, (None, None, False): 7, (5, 5, True): 2, (5, 5, False): 1, (5, 1, False): 1, (6, 5, False): 1}


def test_min_and_max_estimate_the_similarity():
    rng = random.Random(5)
    import numpy as np
    a = " ".join(words(rng, 400)).encode()
    b = a.split()
    b[100:140] = words(rng, 40)
    b = b" ".join(x if isinstance(x, bytes) else x.encode() for x in b)
    x, y = minmax_dedup.shingle_set(a), minmax_dedup.shingle_set(b)
    true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    s, t = minmax_dedup.signature(x, 256), minmax_dedup.signature(y, 256)
    assert len(s) == 512
    assert abs((s == t).mean() - true) < 0.08


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    hub = spark.range(1000, 1500).select(F.lit(999).cast("long").alias("a"), F.col("id").alias("b"))
    got = {r["id"]: r["component"] for r in common.components(edges.union(hub)).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 999 for i in range(999, 1500)}


def passages(rows, length=50):
    count, by = collections.Counter(), {}
    for n, (i, t, _) in enumerate(rows):
        if i is None:
            continue
        w = (t or "").encode().split()
        by[n] = (i, w)
        count.update(tuple(w[k:k + length]) for k in range(len(w) - length + 1))
    out = collections.defaultdict(set)
    for i, w in by.values():
        for k in range(len(w) - length + 1):
            if count[tuple(w[k:k + length])] > 1:
                out[i].update(range(k, k + length))
    return dict(out)


def passage_rows(rng):
    shared = [words(rng, n) for n in (49, 50, 51, 80, 200)]
    rows = []
    for i in range(60):
        text = words(rng, rng.randrange(0, 300))
        for _ in range(rng.randrange(3)):
            p = rng.choice(shared)
            at = rng.randrange(len(text) + 1)
            cut = rng.randrange(0, 20)
            text[at:at] = p[cut:]
        rows.append((10 + i, " ".join(text), "s"))
    rows.append((200, rows[0][1] + "\n", "s"))
    rows.append((201, " ".join(shared[3] + words(rng, 30) + shared[3]), "s"))
    return rows


def test_passages_match_brute_force(spark):
    rng = random.Random(6)
    rows = awkward(rng) + passage_rows(rng)
    got = collections.defaultdict(set)
    for r in suffix_dedup.repeated_passages(docs_frame(spark, rows)).collect():
        assert r["n_words"] == r["end_word"] - r["start_word"] >= 50
        got[r["doc_id"]].update(range(r["start_word"], r["end_word"]))
    assert dict(got) == passages(rows)
    assert suffix_dedup.repeated_passages(empty_docs(spark)).count() == 0


def test_removing_repeats_leaves_one_copy(spark):
    rng = random.Random(7)
    p = words(rng, 70)
    rows = [(i, " ".join(words(rng, 60) + p + words(rng, 60)), "s") for i in range(1, 6)] + [(9, None, "s")]
    out = {r["doc_id"]: r["text"] for r in suffix_dedup.remove_repeats(docs_frame(spark, rows)).collect()}
    assert out[1] == rows[0][1] and out[9] is None
    for i in range(2, 6):
        assert out[i].split() == rows[i - 1][1].split()[:60] + rows[i - 1][1].split()[130:]


def test_first_is_one_place_with_copies_and_repeats_inside(spark):
    rng = random.Random(9)
    p, q = words(rng, 70), words(rng, 60)
    own = {i: (words(rng, 60), words(rng, 60)) for i in (1, 5, 7, 9, 11)}
    text = {i: a + p + b for i, (a, b) in own.items()}
    text[1] = own[1][0] + p + own[1][1] + p  # twice in the first document
    text[9] = own[9][0]                      # copies without a passage
    text[11] = ["-"] * 300                   # overlaps itself
    text[12] = q + ["-"] * 200
    text |= {6: text[5], 8: text[7], 10: text[9]}
    docs = docs_frame(spark, [(i, " ".join(t), "s") for i, t in text.items()])
    rows = collections.defaultdict(list)
    for r in suffix_dedup.repeated_passages(docs).collect():
        rows[r["doc_id"]].append((r["start_word"], r["end_word"], r["first"]))
    assert sorted(rows[1]) == [(60, 130, True), (190, 260, False)]
    for i in (5, 7):
        assert sorted(rows[i]) == [(0, 109, True), (60, 130, False), (81, 190, True)]
        assert rows[i + 1] == [(0, 190, False)]
    assert rows[9] == [(0, 60, True)] and rows[10] == [(0, 60, False)]
    out = {r["doc_id"]: r["text"].split() for r in suffix_dedup.remove_repeats(docs).collect()}
    assert out[1] == own[1][0] + p + own[1][1]
    assert out[5] == own[5][0] + own[5][1] and out[7] == own[7][0] + own[7][1] and out[9] == own[9][0]
    assert out[6] == out[8] == out[10] == []
    assert out[11] == ["-"] * 50 and out[12] == q


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_neighbours_in_suffix_order(spark, ranges):
    """Matches are the suffixes whose first words another one has, wherever
    the borders of the sorted ranges fall; a repeated row is no match."""
    rng = random.Random(ranges)
    prefixes = [b"hot words"] * 150 + [b"two", b"two", b"one"] + [f"p{rng.randrange(60)}".encode() for _ in range(60)] + \
        [f"single {i}".encode() for i in range(40)]
    rows = [(i // 3, -i // 3, i, p) for i, p in enumerate(prefixes)]
    df = spark.createDataFrame(rows + rows[150:], "id long, print long, place int, prefix binary").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        got = sorted((r["id"], r["print"], r["place"]) for r in suffix_dedup.matches(df).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == sorted(r[:3] for r in rows if prefixes.count(r[3]) > 1)
    assert suffix_dedup.matches(df.limit(0)).count() == 0


def test_every_stretch_holds_a_retained_suffix():
    rng = random.Random(8)
    w = suffix_dedup.Words(" ".join(words(rng, 500, 30)).encode())
    at = w.selected(50, 20)
    assert len(at) == 451
    assert all(p <= m and m + 20 <= p + 50 for p, m in enumerate(at))
