"""Tag text, clean-up, topic tags and search patterns (FIXTURES section 8)."""

import datetime as dt

from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions.patterns import normalise_like
from newsloom.operators import search
from newsloom.schema import ARTICLE_SCHEMA


def _one(spark, col, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(col(F.col("v")).alias("o")).first().o


def test_split_tags(spark):
    assert _one(spark, X.split_tags, " AI,半導体 , , 　ソニー　,b") == ["AI", "半導体", "ソニー", "b"]
    assert _one(spark, X.split_tags, "a、b，c") == ["a、b，c"]
    assert _one(spark, X.split_tags, "a,a") == ["a", "a"]


def test_clean_tags(spark):
    got = _one(spark, X.clean_tags, ["2025年", "トヨタ自動車", "株式会社X", "自動車"], "array<string>")
    assert got == ["2025", "トヨタ", "X", "自動車"]


def test_topic_tag(spark):
    df = spark.createDataFrame([(["a"], "新しい半導体工場"), (["半導体"], "半導体"), (["b"], "none")],
                               "tags array<string>, text string")
    got = [r.t for r in df.select(X.topic_tags("tags", "text").alias("t")).collect()]
    assert got == [["a", "半導体"], ["半導体"], ["b"]]


def test_like_normalisation():
    assert normalise_like("%a\\b%") == "%ab%"
    assert normalise_like("%a\\%") == "%a\\%"
    assert normalise_like("100\\") == "100"


def _articles(spark, rows):
    base = {c: None for c in ARTICLE_SCHEMA.fieldNames()}
    data = []
    for i, r in enumerate(rows):
        d = dict(base, id=f"i{i}", url=f"u{i}", source="s", **r)
        data.append(tuple(d[c] for c in ARTICLE_SCHEMA.fieldNames()))
    return spark.createDataFrame(data, ARTICLE_SCHEMA)


def test_search_edge_cases(spark):
    a = _articles(spark, [dict(title="abc", tags=None), dict(title="100% sure", tags=["x"]),
                          dict(title="zzz", tags=None), dict(title="100 percent", tags=None)])
    ids = lambda df: sorted(r.id for r in df.collect())
    assert ids(search.search(a, q="a\\b")) == ["i0"]
    assert ids(search.search(a, q="100%")) == ["i1", "i3"]
    assert ids(search.search(a, q="100%", literal=True)) == ["i1"]
    assert ids(a.filter(~search.keyword("abc"))) == ["i1", "i2", "i3"]
    assert ids(search.search(a, q="", tag="", source=None, date="")) == ["i0", "i1", "i2", "i3"]
    day = dt.date(2024, 1, 1)
    assert ids(search.search(a, date=day)) == []
