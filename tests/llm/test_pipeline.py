"""The pipeline against a brute-force version, and the registered queries
that have SQL against DuckDB."""

import collections

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from newsloom.llm import registered, toxicity
from newsloom.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.test_archives_and_mix import pack_checks, shares
from tests.llm.test_dedup import exact_expected, near_expected
from tools.compare import canon, duck


def test_ten_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", [k for k, (_, s) in registered.QUERIES.items() if s])
def test_queries_match_sql(spark, name):
    df = registered.QUERIES[name][0](spark, SF_SMALL)
    cur = duck(SF_SMALL).execute(registered.QUERIES[name][1])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon([d[0] for d in cur.description], cur.fetchall())


def test_stages_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)

    model = toxicity.train(docs, table(spark, SF_SMALL, "labels"))
    out = stages["toxicity"](spark, docs, SF_SMALL)
    assert out.columns == columns
    clean = sorted(i for i, t, _ in rows if toxicity.severity(model, t)[2] < 0.5)
    assert sorted(r["doc_id"] for r in out.collect()) == clean
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF_SMALL, "labels").collect()}
    assert all(i in clean for i, y in labels.items() if y == 0)

    docs = spark.createDataFrame(out.collect(), out.schema)
    rows = [r for r in rows if r[0] in set(clean)]
    out = stages["exact_dedup"](spark, docs, SF_SMALL)
    assert out.columns == columns
    kept = {r[1] for r in exact_expected(rows)}
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(kept)

    docs = spark.createDataFrame(out.collect(), out.schema)
    rows = [r for r in rows if r[0] in kept]
    out = stages["near_dedup"](spark, docs, SF_SMALL)
    assert out.columns == columns
    kept = {i for i, v in near_expected(rows).items() if v[2]}
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(kept)

    docs = spark.createDataFrame(out.collect(), out.schema)
    rows = [r for r in rows if r[0] in kept]
    out = stages["mixing"](spark, docs, SF_SMALL)
    assert out.columns == columns
    copies = collections.Counter(r["doc_id"] for r in out.collect())
    assert max(copies.values()) <= 3 and set(copies) <= kept
    n = {i: len((t or "").encode().split()) for i, t, _ in rows}
    size = collections.Counter()
    for i, _, s in rows:
        size[s] += n[i]
    taken = collections.Counter()
    for i, _, s in rows:
        taken[s] += copies[i] * n[i]
    for s, goal in shares(size).items():
        assert abs(taken[s] - goal) <= 2 * max(n.values())

    docs = spark.createDataFrame(out.collect(), out.schema)
    packed = stages["packing"](spark, docs, SF_SMALL).collect()
    assert collections.Counter(r["doc_id"] for r in packed if r["piece"] == 0) == copies
    pack_checks(packed, 2048)


def test_run_is_its_stages(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert rows and pack_checks(rows, 2048) >= 1
    assert np.all([r["doc_id"] is not None for r in rows])
