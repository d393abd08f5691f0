"""Licence rules, surrogates and toxicity grades."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import license_scan, surrogates, toxicity
from tests.llm.helpers import awkward, docs_frame, empty_docs, words

BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def base_expected(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    hits = [(i, label) for phrase, label in BASE.items() for i in range(len(w))
            if w[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in hits]
    return (len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits})))


LICENCES = [
    (20, "Released under the MIT License. Licensed under CC BY-NC 4.0.", "a"),
    (21, "UNDER\nTHE_MIT--LICENSE under the mit licenses; under theé mit license", "a"),
    (22, "Apache License, Version 2.0 and Apache License Version 20", "a"),
    (23, "cc by nc cc by nc sa cc-by-nc", "a"),
    (24, "GNU General Public License version 3 or any later version", "a"),
    (25, "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
         "General Public License as published by the Free Software Foundation", "a"),
    (26, "the licence of dogs, and nothing else", "a"),
    (27, "SPDX-License-Identifier: Apache-2.0", "a"),
]


def test_base_phrases(spark):
    rows = awkward(random.Random(1)) + LICENCES
    got = license_scan.scan(docs_frame(spark, rows))
    found = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
                    for r in got.collect()), key=repr)
    assert found == sorted(((i, *base_expected(t)) for i, t, _ in rows), key=repr)
    assert license_scan.scan(empty_docs(spark)).count() == 0


def test_labels_of_the_rules(spark):
    got = {r["doc_id"]: r for r in license_scan.scan(docs_frame(spark, LICENCES)).collect()}
    assert got[20]["labels"] == "cc-by-nc,cc-by-nc-4.0,mit"
    assert got[24]["labels"] == "gpl-3.0-or-later"  # the shorter names inside are suppressed
    assert "gpl" in got[25]["labels"].split(",") and got[25]["score"] == 1.0
    assert got[26]["labels"] == "" and got[26]["score"] == 0.0
    assert got[27]["labels"] == "apache-2.0"
    assert all(0 <= r["score"] <= 1 for r in got.values())


def sample_of(pattern: str) -> str:
    """A text the pattern matches: first alternatives, no optional parts."""
    p = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)\{[^}]*\}", r"\1", pattern).replace("[^ ]+", "word")
    while re.search(r"\(\?:[^()]*\)\??", p):
        p = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)(\??)", lambda m: "" if m[2] else m[1], p)
    p = re.sub(r"\[(.)[^]]*\]", r"\1", p)
    return re.sub(r"(.)\?", "", p).replace("  ", " ").strip()


def test_gate_and_keywords_let_every_rule_through():
    table = license_scan.rules()
    assert len(table) > 200
    for rule in table:
        text = sample_of(rule.pattern)
        assert re.fullmatch(rule.pattern, text), rule
        assert rule.keyword in text, rule
        assert re.search(license_scan.GATE, text), rule


PRIVATE = [
    (20, "Mail Jane.Doe+x@Site.example.org or jane.doe+x@site.example.org. Mr. John Smith met Mrs. Smith.", "a"),
    (21, "Mrs Smith called +1 (974) 555-3436, again +1-974-555-3436 and +1 (974) 555-3437.", "a"),
    (22, "card 4845 1681 1440 7329 is 4845168114407329; ip 97.51.17.173 and 97.51.17.174", "a"),
    (23, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and 97.51.17.173', "a"),
    (24, "version 1.2.3.4.5 of 2024-01-15 costs 1,000,000; see section 12", "a"),
    (25, "госпожа Петрова и господин Иван Петров", "a"),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def test_surrogates(spark):
    rows = awkward(random.Random(2)) + PRIVATE
    docs = docs_frame(spark, rows)
    got = surrogates.replace_private(docs, "key").collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    source = {i: t for i, t, _ in rows}
    for i in (1, 2, 3, 4, 6, 8, 9, 24):
        assert by[i]["text"] == source[i] and by[i]["n_entities"] == 0 and by[i]["kinds"] == "", i
    hidden = " ".join(by[i]["text"] for i in range(20, 26))
    for secret in ("Doe", "site.example", "Smith", "555-343", "4845", "97.51", "04dbebab", "Петров"):
        assert secret not in hidden, secret
    a, b = re.findall(r"\S+@\S+?(?=\.? )", by[20]["text"])[:2]
    assert a == b and re.fullmatch(r"[a-z]{4}\.[a-z]{3}\+[a-z]@[a-z]+\.example\.org", a)
    phones = re.findall(r"\+\d[ -]\(?\d{3}\)?[ -]\d{3}-\d{4}", by[21]["text"])
    digits = [re.sub(r"\D", "", p) for p in phones]
    assert len(phones) == 3 and digits[0] == digits[1] != digits[2]
    spaced, plain = re.search(r"card ([\d ]+) is (\d+);", by[22]["text"]).groups()
    assert spaced.replace(" ", "") == plain and len(plain) == 16 and luhn(plain)
    ips = re.findall(r"\d+\.\d+\.\d+\.\d+", by[22]["text"])
    assert ips[0] != ips[1] and ips[0] in by[23]["text"]
    assert re.fullmatch(r'token = "[0-9a-z]{40}" and \S+', by[23]["text"])
    surname = re.search(r"Mrs\. ([A-Z][a-z]+)", by[20]["text"])[1]
    assert by[21]["text"].startswith(f"Mrs {surname} called")
    given = re.search(r"Mr\. ([A-Z][a-z]+) ([A-Z][a-z]+) met", by[20]["text"])[1]
    assert given in surrogates.GIVEN["latin_m"]
    assert re.fullmatch(r"госпожа [А-Я][а-я]+ и господин [А-Я][а-я]+ [А-Я][а-я]+", by[25]["text"])
    again = {(r["doc_id"], r["text"]) for r in surrogates.replace_private(docs.repartition(5), "key").collect()}
    assert again == {(r["doc_id"], r["text"]) for r in got}
    other = {r["doc_id"]: r["text"] for r in surrogates.replace_private(docs, "other").collect()}
    assert other[20] != by[20]["text"]
    assert surrogates.replace_private(empty_docs(spark), "key").count() == 0


NEIGHBOURS = {
    30: ("+1 (826) 555-4081 190.137.223.204", ["+1 (826) 555-4081", "190.137.223.204"]),
    31: ("call +1 (826) 555-4081 2024 times", ["+1 (826) 555-4081"]),
    32: ("+1 (826) 555-4081 4111 1111 1111 1111", ["+1 (826) 555-4081", "4111 1111 1111 1111"]),
    33: ("+44 20 7946 0958 190.137.223.204", ["+44 20 7946 0958", "190.137.223.204"]),
    34: ("+442071838750 123-45-6789", ["+442071838750", "123-45-6789"]),
    35: ("ES91 2100 0418 4502 0005 1332 190.137.223.204", ["ES91 2100 0418 4502 0005 1332", "190.137.223.204"]),
    36: ("access_token = k3Jd93kLm2", ["k3Jd93kLm2"]),
    37: ("client_secret: 'q8Zr71bVx0'", ["q8Zr71bVx0"]),
    38: ("export DB_PASSWORD=hunter2hunter2", ["hunter2hunter2"]),
    39: ("myApiKey: a1b2c3d4e5 and DE89 3704 0044 0532 0130 00", ["a1b2c3d4e5", "DE89 3704 0044 0532 0130 00"]),
}


def test_neighbouring_numbers_and_prefixed_credentials(spark):
    docs = docs_frame(spark, [(i, t, "a") for i, (t, _) in NEIGHBOURS.items()])
    got = {r["doc_id"]: r for r in surrogates.replace_private(docs, "key").collect()}
    for i, (text, private) in NEIGHBOURS.items():
        gaps = re.split("|".join(map(re.escape, private)), text)
        assert got[i]["n_entities"] == len(private), (i, got[i])
        assert re.fullmatch("(.+)".join(map(re.escape, gaps)), got[i]["text"]), (i, got[i])
        assert not any(p in got[i]["text"] for p in private), (i, got[i])
    phones = [re.sub(r"\D", "", got[i]["entities"][0]["surrogate"]) for i in (30, 31, 32)]
    assert len(set(phones)) == 1
    assert got[30]["entities"][1]["surrogate"] == got[33]["entities"][1]["surrogate"] == got[35]["entities"][1]["surrogate"]


def test_surrogates_stay_distinct_when_the_space_is_small(spark):
    """All two-letter local parts of one site: drawn surrogates collide and
    hit existing addresses, and are drawn again until none does."""
    letters = "abcdefghij"
    mails = [f"{a}{b}@tiny.example.com" for a in letters for b in letters]
    ent = spark.createDataFrame([("email", m) for m in mails] * 2, "kind string, entity string")
    table = surrogates.surrogate_table(ent, "key").collect()
    drawn = [r["surrogate"] for r in table]
    assert len(drawn) == len(set(drawn)) == len(mails) and not set(drawn) & set(mails)


def test_surrogates_never_run_out(spark):
    """A third of a format's space is taken by entities; kinds that look alike
    and bearers of one surname stay apart as they are seen."""
    rows = [("phone", str(n)) for n in range(100, 400)] + [("ssn", str(n)) for n in range(350, 500)] + \
        [("person", f"{g}:Name{chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(200) for g in "mf"]
    table = surrogates.surrogate_table(spark.createDataFrame(rows, "kind string, entity string"), "key").collect()
    assert {(r["kind"], r["entity"]) for r in table} == set(rows) and len(table) == len(rows)
    seen = [r["surrogate"].split(":")[-1] for r in table]
    assert len(set(seen)) == len(seen) and not set(seen) & {e.split(":")[-1] for _, e in rows}
    assert all(r["surrogate"].isdigit() for r in table if r["kind"] != "person")


def test_longer_numbers_are_written_whole(spark):
    df = spark.createDataFrame([("phone", "+1 (22) 3", "98765"), ("iban", "DE12 34", "DEab1234")], "k string, f string, s string")
    got = [r["x"] for r in df.select(surrogates._render(F.col("k"), F.col("f"), F.col("s")).alias("x")).collect()]
    assert got == ["+9 (87) 65", "DEab 1234"]


def test_surrogate_plan_is_native(spark):
    plan = surrogates.replace_private(docs_frame(spark, PRIVATE), "key")._jdf.queryExecution().toString()
    plan += license_scan.scan(docs_frame(spark, LICENCES))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def toxic_rows(rng, n):
    bad = ["idiot", "moron", "scum", "loser"]
    rows, labels = [], []
    for i in range(n):
        text = words(rng, rng.randrange(30, 200), 2000)
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randrange(1, 12)):
                text.insert(rng.randrange(len(text)), rng.choice(bad).upper() + rng.choice(["", "!!", ","]))
        rows.append((i, " ".join(text), "s"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, labels = toxic_rows(random.Random(3), 600)
    docs = docs_frame(spark, rows)
    marked = spark.createDataFrame([*labels[:400], (None, 1), (399, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, marked)
    assert np.all(np.diff(model.thresholds) > 0)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    wrong = [i for i, y in labels[400:] if got[i]["toxic"] != bool(y)]
    assert len(wrong) <= 4
    mild = [got[i]["severity"] for i, y in labels[400:] if not y]
    bad = [got[i]["severity"] for i, y in labels[400:] if y]
    assert max(mild) < np.median(bad)
    stay = toxicity.reject_toxic(docs, model)
    assert stay.columns == docs.columns
    assert sorted(r["doc_id"] for r in stay.collect()) == sorted(i for i, r in got.items() if not r["toxic"])


def plain_terms(text):
    found = []
    for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
        found += [w, w[:5] + "*"] if len(w) > 5 else [w]
    return found


def plain_loss(x, grades, weights, thresholds, penalty):
    """Penalised negative log likelihood of the ordinal model, row by row."""
    total = 0.0
    for row, grade in zip(x, grades):
        eta = float(row @ weights)
        above = [1.0] + [1 / (1 + math.exp(-(eta - t))) for t in thresholds] + [0.0]
        total -= math.log(max(above[grade] - above[grade + 1], 1e-9))
    return total / len(x) + penalty * float(weights @ weights) / 2 / math.sqrt(len(x))


def test_fit_is_a_minimum_of_the_plain_loss():
    rng = np.random.default_rng(6)
    counts = rng.poisson(0.4, size=(160, 6))
    grades = np.clip(counts[:, :3].sum(axis=1) + rng.integers(-1, 2, 160), 0, 3)
    r, c = np.nonzero(counts)
    weights, thresholds = toxicity.fit(r, c, counts[r, c], grades, 6, rounds=3000)
    x = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0.0)
    best = plain_loss(x, grades, weights, thresholds, toxicity.PENALTY)
    assert np.all(np.diff(thresholds) > 0)
    for _ in range(60):
        near = plain_loss(x, grades, weights + rng.normal(0, 0.05, 6), thresholds + rng.normal(0, 0.05, 3), toxicity.PENALTY)
        assert near > best - 1e-5
    early, cuts = toxicity.fit(r, c, counts[r, c], grades, 6, rounds=5)
    assert best < plain_loss(x, grades, early, cuts, toxicity.PENALTY)


def test_markers_and_scores_against_plain_code(spark):
    rows, labels = toxic_rows(random.Random(8), 300)
    rows += [(900, None, "s"), (901, "", "s"), (902, "IDIOT idiots moronic " * 40, "s")]
    docs, toxic = docs_frame(spark, rows), dict(labels)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    # one row a text, as equal texts count once
    texts = {t: toxic[i] for i, t, _ in rows if i in toxic}
    n1, n0 = sum(texts.values()), len(texts) - sum(texts.values())
    t, c = collections.Counter(), collections.Counter()
    for text, bad in texts.items():
        (t if bad else c).update(set(plain_terms(text)))
    odds = lambda k, n: math.log((k + 0.5) / (n + 0.5 - k))
    z = {w: (odds(t[w], n1) - odds(c[w], n0)) / math.sqrt(1 / (t[w] + 0.5) + 1 / (c[w] + 0.5))
         for w in t if t[w] >= toxicity.MIN_TOXIC_DOCS}
    assert set(model.terms) == {w for w, v in z.items() if v >= toxicity.MIN_Z} and len(model.terms) <= toxicity.MAX_FEATURES
    text_of = {i: text for i, text, _ in rows}
    for r in toxicity.score(docs, model).collect():
        found = collections.Counter(w for w in plain_terms(text_of[r["doc_id"]]) if w in model.terms)
        eta = sum(model.weights[model.terms[w]] * (1 + math.log(n)) for w, n in found.items())
        p = [1 / (1 + math.exp(-max(-30, min(30, eta - cut)))) for cut in model.thresholds]
        levels = -np.diff([1.0, *p, 0.0])
        assert math.isclose(r["severity"], sum(p), abs_tol=1e-9) and math.isclose(r["p_toxic"], p[0], abs_tol=1e-12)
        assert r["grade"] == int(np.argmax(levels)) and r["toxic"] == (p[0] >= 0.5)


def test_toxicity_memory_of_a_task(spark):
    """The terms of a batch are made a slice at a time; a text goes to Python
    once."""
    import pyarrow as pa
    n = 3 * toxicity.TRAIN_ROWS + 1
    batch = pa.record_batch({"row": pa.array(range(n), pa.int64()), "toxic": pa.array([0] * n, pa.int32()),
                             "text": pa.array([None if i % 50 == 0 else f"word{i} other words" for i in range(n)]),
                             "weight": pa.array([1.0] * n)})
    out = list(toxicity._train_rows([batch]))
    assert [b.num_rows for b in out] == [toxicity.TRAIN_ROWS] * 3 + [1]
    assert pa.Table.from_batches(out).column("row").to_pylist() == list(range(n))
    model = toxicity.Model({"bad": 0}, np.array([9.0]), np.array([1.0]))
    docs = docs_frame(spark, [(1, "a bad day", "s"), (2, "a day", None), (None, "", "s"), (4, None, "s"), (5, "BAD", "t")])
    stay = toxicity.reject_toxic(docs, model)
    assert "_text" not in stay._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, stay.collect()), key=str) == sorted(map(tuple, docs.filter("doc_id IS NULL OR doc_id IN (2, 4)").collect()), key=str)


def test_toxicity_odd_inputs(spark):
    docs = docs_frame(spark, awkward(random.Random(4)))
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs, none)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 12 and not any(r["toxic"] for r in got)
    one_class = toxicity.train(docs, spark.createDataFrame([(4, 1), (6, 1)], "doc_id long, toxic int"))
    assert not one_class.terms
    assert toxicity.score(empty_docs(spark), model).count() == 0


def test_training_sample_is_bounded(spark):
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("int").alias("toxic"))
    sizes = {r["_toxic"]: r["count"] for r in toxicity.sample_labels(labels, 1000).groupBy("_toxic").count().collect()}
    assert sum(sizes.values()) < 1200 and abs(sizes[1] - 500) < 120


def test_sampled_classes_decide_alike(spark):
    """A tenth is toxic; one strong marker, and a weak one that a third of
    its documents justify: the decision doesn't depend on the sample."""
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(4000):
        text, toxic = words(rng, 20, 400), i % 10 == 0
        if rng.random() < (0.6 if toxic else 0.15):
            text.append("dubious")
        if toxic and rng.random() < 0.6:
            text += ["moron"] * rng.randrange(1, 12)
        rows.append((i, " ".join(text), "s"))
        labels.append((i, int(toxic)))
    docs, marked = docs_frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    weak = {i for i, t, _ in rows if "dubious" in t and "moron" not in t}
    strong = {i for i, t, _ in rows if "moron" in t}
    for max_rows in (10_000, 800):
        model = toxicity.train(docs, marked, max_rows=max_rows)
        bad = {i for i, t, _ in rows if toxicity.severity(model, t)[2] >= 0.5}
        assert len(bad & weak) <= 0.05 * len(weak) and len(bad & strong) >= 0.95 * len(strong), max_rows
        assert len(bad - weak - strong) <= 20


def test_shared_weights_order_the_grades():
    grades = np.array([0] * 50 + [1] * 20 + [2] * 20 + [3] * 20)
    rows = list(range(50, 110))
    w, cut = toxicity.fit(rows, [0] * 60, [1] * 20 + [4] * 20 + [20] * 20, grades, 1)
    assert w[0] > 0 and np.all(np.diff(cut) > 0)
    model = toxicity.Model({"bad": 0}, w, cut)
    grade = [toxicity.severity(model, " ".join(["bad"] * n))[0] for n in (0, 1, 4, 20)]
    assert grade == sorted(grade)


@pytest.mark.parametrize("text", [None, "", " \n"])
def test_severity_of_nothing(text):
    model = toxicity.Model({"bad": 0}, np.array([5.0]), np.array([3.0, 4.0]))
    assert toxicity.severity(model, text)[1] == 0
