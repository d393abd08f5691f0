"""Toxicity grades by cumulative-link ordinal regression.

One weight vector over sparse text features is shared by all thresholds:
P(grade > j) = sigmoid(w.x - theta_j) with theta_0 < theta_1 < ... The
expected severity is the sum of these probabilities over j.

The label table knows toxic or not. Grades of the training documents come
from that and from how often a document uses marker terms, those far more
frequent in toxic training documents than in others: 0 not toxic; 1 toxic;
2 and 3 toxic with at least ``GRADE_STEPS`` marker occurrences.

Features are the selected marker terms, whole lower-cased words and word
beginnings of five letters, present or not and how often (logarithm of the
count). The model is fitted on at most ``MAX_TRAIN`` labelled documents; a
sampled class is weighted by its inverse sampling rate, so that the decision
is that of the natural share of toxic documents. Every document is scored on
its whole text.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import materialise, release_unused

#: Documented bound of the training sample, half of it for either class.
MAX_TRAIN = 20_000
MAX_FEATURES = 4096
#: A marker occurs in so many toxic training documents at least, and its
#: log odds differ from the others' by so many standard errors.
MIN_TOXIC_DOCS = 3
MIN_Z = 2.3
GRADE_STEPS = (3, 8)
PREFIX = 5
ROUNDS = 400
PENALTY = 0.002
#: Training documents whose terms a task holds at once.
TRAIN_ROWS = 256
_WORD = re.compile(r"[^\W\d_]+")


class Model(NamedTuple):
    """Feature number by term (``*`` ends a word beginning), weights, and the
    increasing thresholds."""
    terms: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray


def term_counts(text: str | None) -> dict[str, int]:
    """Occurrences of every word and word beginning."""
    out: dict[str, int] = {}
    for w in _WORD.findall((text or "").lower()):
        out[w] = out.get(w, 0) + 1
        if len(w) > PREFIX:
            p = w[:PREFIX] + "*"
            out[p] = out.get(p, 0) + 1
    return out


def _strength(count):
    return 1.0 + np.log(count)


def fit(rows, cols, counts, grades: np.ndarray, features: int,
        rounds: int = ROUNDS, penalty: float = PENALTY, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by gradient descent (Adam) on the penalised
    log likelihood, in which every row counts ``weight`` (1). Thresholds are
    a first one and positive steps."""
    n, levels = len(grades), int(grades.max()) if len(grades) else 0
    if not n or not levels:
        return np.zeros(features), np.full(1, 6.0)
    r, c = np.asarray(rows, np.int64), np.asarray(cols, np.int64)
    x = _strength(np.asarray(counts, float)) if len(r) else np.zeros(0)
    above = np.stack([grades > j for j in range(levels)], axis=1)
    scale = np.ones(n) if weight is None else np.asarray(weight, float) * (n / np.sum(weight))
    share = (above * scale[:, None]).mean(axis=0).clip(1e-3, 1 - 1e-3)
    first = -np.log(share / (1 - share))
    theta = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 0.1))])
    params = np.concatenate([np.zeros(features), theta])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        w, t = params[:features], params[features:]
        gaps = np.exp(t[1:])
        cut = np.concatenate([t[:1], t[0] + np.cumsum(gaps)])
        eta = np.bincount(r, weights=w[c] * x, minlength=n)
        p = 1 / (1 + np.exp(-(eta[:, None] - cut).clip(-30, 30)))  # P(grade > j)
        edge = np.concatenate([np.ones((n, 1)), p, np.zeros((n, 1))], axis=1)
        upper, lower = edge[np.arange(n), grades], edge[np.arange(n), grades + 1]
        prob = np.maximum(upper - lower, 1e-9)
        du = scale * np.where(grades > 0, upper * (1 - upper), 0) / prob
        dl = scale * np.where(grades < levels, lower * (1 - lower), 0) / prob
        gw = -np.bincount(c, weights=(du - dl)[r] * x, minlength=features) / n + penalty * w / math.sqrt(n)
        gc = np.zeros(levels)
        np.add.at(gc, grades[grades > 0] - 1, du[grades > 0])
        np.add.at(gc, grades[grades < levels], -dl[grades < levels])
        gt = np.concatenate([[gc.sum()], gaps * np.cumsum(gc[::-1])[::-1][1:]]) / n
        g = np.concatenate([gw, gt])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        params = params - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    t = params[features:]
    return params[:features], np.concatenate([t[:1], t[0] + np.cumsum(np.exp(t[1:]))])


def _train_rows(batches):
    for batch in (b.slice(at, TRAIN_ROWS) for b in batches for at in range(0, b.num_rows, TRAIN_ROWS)):
        terms, counts = [], []
        for text in batch.column(2):
            found = term_counts(text.as_py())
            terms.append(list(found))
            counts.append(list(found.values()))
        yield pa.record_batch({"row": batch.column(0), "toxic": batch.column(1), "weight": batch.column(3),
                               "terms": pa.array(terms, pa.list_(pa.string())), "counts": pa.array(counts, pa.list_(pa.int32()))})
    release_unused()


def _columns(df: DataFrame) -> dict[str, np.ndarray]:
    table = df.toArrow()
    return {n: table.column(n).to_numpy() for n in table.column_names}


def sample_labels(labels: DataFrame, max_rows: int, id_col: str = "doc_id", toxic: str = "toxic") -> DataFrame:
    """At most about ``max_rows`` labelled ids, half of them of either class,
    chosen by a hash of the id; ``_weight`` is the inverse sampling rate of
    the class. Rows without id or label are left out; a repeated id counts
    as toxic if any of its rows is."""
    one = labels.filter(F.col(id_col).isNotNull() & F.col(toxic).isNotNull()).groupBy(
        F.col(id_col).alias("_id")).agg(F.max((F.col(toxic).cast("int") > 0).cast("int")).alias("_toxic"))
    one = materialise(one)
    sizes = {r["_toxic"]: r["n"] for r in one.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    if total <= max_rows:
        return one.withColumn("_weight", F.lit(1.0))
    toxic_rows = min(sizes.get(1, 0), max_rows // 2)
    share = {1: toxic_rows / max(1, sizes.get(1, 0)), 0: min(1.0, (max_rows - toxic_rows) / max(1, sizes.get(0, 0)))}
    place = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) / float(1 << 30)
    rate = F.when(F.col("_toxic") == 1, share[1]).otherwise(share[0])
    return one.filter(place < rate).withColumn("_weight", 1 / rate)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", toxic: str = "toxic",
          max_rows: int = MAX_TRAIN, max_features: int = MAX_FEATURES) -> Model:
    """Fit the model on labelled rows of ``docs``. Equal texts count once.
    Only the bounded sample's ids are broadcast, and only its occurrences of
    at most ``max_features`` markers reach the driver. Without labels, or
    with one class only, the model calls nothing toxic."""
    sample = sample_labels(labels, max_rows, id_col, toxic)
    # the sample is bounded by max_rows
    joined = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(sample), "_id")
    unique = joined.groupBy(F.xxhash64("_text").alias("_h")).agg(
        F.max("_toxic").alias("_toxic"), F.first("_text").alias("_text"), F.max_by("_weight", "_toxic").alias("_weight"))
    rows = materialise(unique.select("_h", "_toxic", "_text", "_weight").mapInArrow(
        _train_rows, "row long, toxic int, weight double, terms array<string>, counts array<int>"))
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Model({}, np.zeros(0), np.full(1, 6.0))
    seen = rows.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    odds = lambda x, n: F.log((F.col(x) + 0.5) / (F.lit(n + 0.5) - F.col(x)))
    z = (odds("t", n1) - odds("c", n0)) / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    chosen = [r["term"] for r in seen.filter(F.col("t") >= MIN_TOXIC_DOCS).withColumn("z", z)
              .filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "term").limit(max_features).collect()]
    terms = {t: i for i, t in enumerate(chosen)}
    if not terms:
        return Model({}, np.zeros(0), np.full(1, 6.0))
    pairs = F.arrays_zip("terms", "counts")
    known = rows.sparkSession.createDataFrame([(t, i) for t, i in terms.items()], "term string, number int")
    hits = (rows.select("row", "toxic", F.explode_outer(pairs).alias("p"))
            .select("row", "toxic", F.col("p.terms").alias("term"), F.col("p.counts").alias("n"))
            .join(F.broadcast(known), "term", "left").filter("number is not null")
            .select("row", "number", "n", (~F.col("term").endswith("*")).alias("word")))
    # columns of numbers, in a fixed order: a few bytes for each occurrence
    at = _columns(rows.select("row", "toxic", "weight"))
    order = np.argsort(at["row"])
    names, toxic_rows, weight = at["row"][order], at["toxic"][order], at["weight"][order]
    hit = _columns(hits)
    place = np.searchsorted(names, hit["row"])
    order = np.lexsort((hit["number"], place))
    place, number, count, word = place[order], hit["number"][order], hit["n"][order], hit["word"][order]
    markers = np.bincount(place, weights=np.where(word, count, 0), minlength=len(names))
    grades = np.where(toxic_rows > 0, 1 + sum((markers >= s).astype(int) for s in GRADE_STEPS), 0)
    weights, thresholds = fit(place, number, count, grades, len(terms), weight=weight)
    return Model(terms, weights, thresholds)


def severity(model: Model, text: str | None) -> tuple[float, int, float]:
    """Expected severity, most probable grade and P(toxic) of one text."""
    found: dict[int, int] = {}
    known = model.terms
    for w in _WORD.findall((text or "").lower()):
        k = known.get(w)
        if k is not None:
            found[k] = found.get(k, 0) + 1
        if len(w) > PREFIX:
            k = known.get(w[:PREFIX] + "*")
            if k is not None:
                found[k] = found.get(k, 0) + 1
    eta = sum(float(model.weights[k]) * (1.0 + math.log(n)) for k, n in sorted(found.items()))
    p = [1 / (1 + math.exp(-max(-30.0, min(30.0, eta - t)))) for t in model.thresholds.tolist()]
    edge = [1.0, *p, 0.0]
    levels = [edge[j] - edge[j + 1] for j in range(len(p) + 1)]
    return sum(p), max(range(len(levels)), key=levels.__getitem__), p[0]


def _score(shared, field: int | None = None):
    """``field``: place of the text in the rows, when it is no column."""
    def run(batches):
        model = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("_text")) if field is None else batch.column(0).field(field)
            out = [severity(model, t.as_py()) for t in texts]
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if n != "_text"}
            yield pa.record_batch(cols | {
                "severity": pa.array([x[0] for x in out], pa.float64()), "grade": pa.array([x[1] for x in out], pa.int32()),
                "p_toxic": pa.array([x[2] for x in out], pa.float64()), "toxic": pa.array([x[2] >= 0.5 for x in out], pa.bool_())})
        release_unused()
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, severity, grade, p_toxic,
    toxic``. A null or empty text has no features and gets the model's
    baseline; repeated rows are scored alike; an empty table gives an empty
    result; other columns are not read. Rows don't shuffle. The labels know
    two grades only: what ``severity`` and ``grade`` tell apart among toxic
    texts is how often they use the terms that are the model's features."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("_text")).mapInArrow(
        _score(shared), f"doc_id {kind}, severity double, grade int, p_toxic double, toxic boolean")


def reject_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are more probably not toxic, all columns.
    The text goes to Python once, in its row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    kind = packed.schema["_row"].dataType.simpleString()
    return packed.mapInArrow(_score(shared, docs.columns.index(text)), f"_row {kind}, severity double, grade int, p_toxic double, toxic boolean") \
                 .filter("not toxic").select("_row.*")
