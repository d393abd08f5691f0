"""Embedding whitening, quality rules and conversation repair against plain
re-implementations."""

import hashlib
import heapq
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import dialogue_repair as DR
from newsloom.llm import quality_rules as QR
from newsloom.llm import whitening as WH
from tests.llm.helpers import awkward, docs_frame, empty_docs

# --- whitening -----------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int, component string, n string, x int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "c", "n", 1) for i, v in rows], VECTORS).repartition(3)


def exact(rows, k=16):
    """Whole-number vectors that take part, and the whitening of their
    distinct ones in Python integers and numpy."""
    ok = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows
          if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    unique = np.array(sorted({tuple(x) for _, x in ok}), object)
    n, sums = len(unique), unique.sum(0)
    v = (n * (unique.T @ unique) - np.outer(sums, sums)).astype(float) / n / n
    e, axes = np.linalg.eigh(v)
    return ok, n, sums, e[::-1][:k], axes[:, ::-1][:, :k], np.trace(v)


def test_whitening_against_exact_arithmetic(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), (rng.normal(size=5) * [9, 1, .2, 40, 3]).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]                        # one vector many times
    rows += [(2000, None), (2001, [1.0, None, 1.0, 1.0, 1.0]), (2002, [math.nan] * 5), (2003, [math.inf] * 5),
             (2004, [1.0]), (2005, []), (None, [0.5] * 5), (3, [-0.01] * 5), (2006, [1e300] * 5)]
    taking = [r for r in rows if r[1] is None or len(r[1]) == 5 and r[0] != 2006]
    ok, n, sums, e, axes, trace = exact(taking)
    got = WH.whiten_table(vectors(spark, rows)).collect()
    assert len(got) == 5 * len(ok) and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9
    off = [(i, [n * c - int(s) for c, s in zip(x, sums)]) for i, x in ok]
    assert sorted((r.vec_id or -1, r.deviation) for r in got if r.component == 1) == \
        sorted((i or -1, sum(c * c for c in o)) for i, o in off)
    want = {i: (np.array(o, float) / n) @ axes / np.sqrt(e) for i, o in off if i not in (3, None)}
    sign = {}
    for r in got:
        if r.vec_id in want:
            w = want[r.vec_id][r.component - 1]
            sign.setdefault(r.component, 1 if w * r.whitened > 0 else -1)
            assert abs(r.whitened * sign[r.component] - w) < 1e-9
        assert abs(r.explained - e[r.component - 1] / trace) < 1e-12


def test_whitening_of_long_ranges_and_of_nothing(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1e15, 1e15), rng.uniform(-1, 1)]) for i in range(40)]
    got = WH.whiten_table(vectors(spark, rows)).collect()
    assert {r.component for r in got} == {1} and max(r.identity_error for r in got) < 1e-9  # the other is no share of it
    rows = [(i, [rng.uniform(-1e15, 1e15), rng.uniform(-1e15, 1e15)]) for i in range(40)]
    ok, n, sums, *_ = exact(rows)
    got = WH.whiten_table(vectors(spark, rows)).collect()
    assert len(got) == 80 and {r.deviation for r in got} == {None}
    assert max(r.identity_error for r in got) < 1e-9
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        out = WH.whiten_table(vectors(spark, rows))
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert out.count() == 0


@pytest.mark.parametrize("low,high", [(0, 1), (-5, 90), (-2 ** 62, 2 ** 62)])
def test_bit_sliced_products(low, high):
    import pyarrow as pa
    rng = random.Random(9)
    x = [[rng.randint(low, high) for _ in range(3)] for _ in range(131)]
    bits = max(1, (high - low).bit_length())
    batches = [pa.RecordBatch.from_pydict({"x": pa.array(part, pa.list_(pa.int64()))}) for part in (x[:50], x[50:])]
    (out,) = WH.scatter(iter(batches), np.array([low] * 3, np.int64), bits)
    sums = {}
    for r in out.to_pylist():
        sums[r["i"], r["j"]] = sums.get((r["i"], r["j"]), 0) + (r["value"] << (16 * r["limb"]))
    u = [[c - low for c in row] for row in x]
    for i in range(3):
        assert sums[i, -1] == sum(row[i] for row in u)
        for j in range(i, 3):
            assert sums[i, j] == sum(row[i] * row[j] for row in u)


# --- quality rules -------------------------------------------------------------------------------

def measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {p + d for at in places.values() if len(at) > 1 for p in at for d in range(8)}
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def quality_texts(rng):
    prose = "the house of the river and a stone in it was on the hill with that tree to be seen from this side".split()
    mixed = [rng.choice(prose) + str(rng.randrange(50)) * (rng.random() < .6) for _ in range(400)]
    loop = " ".join(mixed[:9] * 30)
    return [(i, t, "a") for i, t in enumerate([
        " ".join(mixed), " ".join(mixed) + "\n" + " ".join(mixed[100:115]), loop, " ".join(mixed[:19]), " ".join(mixed[:20]),
        "\n".join(["the same line of text"] * 30), " | ".join(mixed[:90]), "a " * 5000, "\n".join("- " + w for w in mixed[:60]),
        "\n".join(w + " and the..." for w in mixed[:60]), "é\U0001f600 " * 40, "x\x0by\x0cz\x85w \r\n" * 9])]


def test_quality_measures_and_rules(spark):
    rows = [*awkward(random.Random(1)), *[(100 + i, t, s) for i, t, s in quality_texts(random.Random(2))]]
    got = QR.judge(docs_frame(spark, rows)).collect()
    seen = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert seen == sorted((str(i), *measured(t)) for i, t, _ in rows)
    for r in got:
        base = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == base and r.kept == (not r.broken) and not (base and r.kept)
    broken = {r.doc_id: set(r.broken) for r in got}
    assert not broken[100] and not broken[101] and not broken[104]
    assert broken[103] == {"too_few_words"} and "repeated_stretches" in broken[102]
    assert "repeated_lines" in broken[105] and "symbols" in broken[106] and "bullet_lines" in broken[108]
    assert "cut_lines" in broken[109] and "stop_words" in broken[110]


def test_quality_tables_and_filter(spark):
    docs = docs_frame(spark, quality_texts(random.Random(2)))
    kept = QR.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in QR.judge(docs).filter("kept").collect()}
    one = (QR.Rule("too_few_words", "n_words", "one", 2100, None),)
    assert {r.doc_id for r in QR.judge(docs, one).filter("base_failed").collect()} == {3, 4}
    assert QR.judge(docs, ()).filter("NOT kept").count() == 0
    with pytest.raises(ValueError):
        QR.compile_rules(F.col("m"), rules=(QR.Rule("x", "nothing", "one", 1, 2),))
    assert QR.judge(empty_docs(spark)).count() == 0 and QR.keep_good(empty_docs(spark)).count() == 0
    other = spark.createDataFrame([(1, "no language column here")], "doc_id long, text string")
    assert QR.judge(other).first().kept is False


def test_quality_is_one_stage_of_built_in_expressions(spark):
    plan = QR.judge(docs_frame(spark, quality_texts(random.Random(2))).coalesce(1))._jdf.queryExecution().executedPlan().toString()
    tail = plan.split("Coalesce")[0]
    assert "Exchange" not in tail and "Python" not in tail and "Join" not in tail


# --- conversation repair -------------------------------------------------------------------------

def cheapest(rows):
    """Cost, edits and lines of the best repair: states leave the queue in
    order of cost, then edits."""
    seen, fault = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    turn = {"": "u", "s": "u", "u": "a", "a": "u"}
    queue, done = [(0, "", 0, "", ())], set()
    while True:
        cost, edits, i, state, out = heapq.heappop(queue)
        if i == len(rows) and state in ("", "a"):
            return fault, cost, edits, out
        if (i, state) in done:
            continue
        done.add((i, state))
        role = {"u": "user", "a": "assistant"}[turn[state]]
        heapq.heappush(queue, (cost + 5, edits + "I", i, turn[state], (*out, role + ":")))
        if i < len(rows):
            _, own, text = rows[i]
            heapq.heappush(queue, (cost + 2, edits + "D", i + 1, state, out))
            if fault[i] not in ("b", "d"):
                more = 5 * (fault[i] == "t")
                if own[:1] == turn[state] or own[:1] == "s" and state == "":
                    heapq.heappush(queue, (cost + more, edits + "K", i + 1, own[:1], (*out, f"{own}:{text}")))
                heapq.heappush(queue, (cost + more + 1, edits + "R", i + 1, turn[state], (*out, f"{role}:{text}")))


def audited(rows):
    convs = {}
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        pick = zlib.crc32(key.encode()) % 20
        text = "" if pick == 1 else re.sub("[.!?]", "", text) if pick == 2 else text
        convs.setdefault(conv, []).extend([] if pick == 0 else [(turn, "user" if pick == 4 else role, text)] * (1 + (pick == 3)))
    out = {}
    for conv, found in convs.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        fault, cost, edits, lines = cheapest(found)
        turns = [t for t, _, _ in found if t is not None]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, fault.count("b"), fault.count("d"), fault.count("t"),
                     sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:])), cost, edits,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


CONVS = "conv_id long, turn long, role string, text string, part string, times int, block string"


def convs_frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 9, "b") for r in rows], CONVS).repartition(3)


def assert_audit(spark, rows):
    got = {r.conv_id: tuple(r)[1:] for r in DR.audit(convs_frame(spark, rows)).collect()}
    assert got == audited(rows)


def random_rows(rng, conv, n):
    return [(conv, rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
             rng.choice(["", None, " \n", "x" * 3000 + ".", *[f"text {rng.randrange(60)}{e}" for e in ".?!, "]])) for _ in range(n)]


def test_repair_against_search(spark):
    rng = random.Random(6)
    rows = [r for c in range(60) for r in random_rows(rng, c, rng.randrange(1, 12))]
    rows += random_rows(rng, None, 9) + [(900, None, "user", "only."), (901, 1, "system", "s.")]
    assert_audit(spark, rows)
    assert DR.audit(convs_frame(spark, [])).count() == 0


def test_hot_conversation_in_blocks(spark, monkeypatch):
    """A conversation over many blocks and parts, with ties and copies."""
    monkeypatch.setattr(DR, "BLOCK_ROWS", 7)
    rng = random.Random(8)
    hot = [(5, t, rng.choice(["user", "user", "assistant", "system"]), rng.choice([f"t{t}.", f"t{t}", "same.", ""]))
           for t in range(700)]
    rows = hot + [r for c in range(20) for r in random_rows(rng, c + 10, 5)] + [(6, 1, "user", "copy.")] * 500
    assert_audit(spark, rows)


def test_survivors_are_bounded_and_exact():
    """The tree holds the unresolved stretch only; edits come out in order."""
    rng = random.Random(11)
    for _ in range(200):
        symbols = "".join(rng.choice("suaoSUAOx") for _ in range(rng.randrange(1, 40)))
        path = []
        run = DR.run_block(symbols, DR.EMPTY, path.append)
        cost, _, state = min((c + DR.INSERT * DR.TO_END[s], r, s) for s, (c, r, _) in run.now.items())
        run.finish(state)
        assert len(path) == len(symbols) and run.held == 0
        rows = [(0, {"s": "system", "u": "user", "a": "assistant", "o": "other", "x": ""}[c.lower()],
                 "" if c == "x" else f"{i}" + "." * c.islower()) for i, c in enumerate(symbols)]
        _, want, edits, _ = cheapest(rows)
        assert cost == want and "".join(p[1] for p in path) + "I" * DR.TO_END[state] == edits
    run, held = DR.Survivors(DR.EMPTY), 0
    for i in range(5000):
        run.step(DR.STEPS["ua"[i % 2]])
        held = max(held, run.held)
    assert held < 100
