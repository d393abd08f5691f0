"""Source maintenance: golden clean-up figures, documented normalisation
examples, idempotence."""

import datetime as dt

from pyspark.sql import functions as F

from newsloom.operators import rules as R
from newsloom.plans import maintenance

NOW = dt.datetime(2026, 12, 1)


def _table(spark, counts):
    rows = []
    for src, n in counts.items():
        rows += [(f"{src}-{i}", src, dt.datetime(2024, 1, 1)) for i in range(n)]
    return spark.createDataFrame(rows, "id string, source string, updated_at timestamp_ntz")


def test_cleanup_golden(spark):
    counts = {"ITmedia エグゼクティブ": 3, "ITmedia エンタープライズ": 4, "ITmedia ビジネスオンライン": 16,
              "ITmedia Mobile": 36, "ITmedia NEWS": 25, "ITmedia PC USER": 28, "ITmedia": 9, "GIGAZINE": 5}
    res = maintenance.cleanup(_table(spark, counts))
    assert res.preview_total == 112 and res.deleted == 112
    assert {r.source: r["count"] for r in res.after.collect()} == {"ITmedia": 9, "GIGAZINE": 5}
    again = maintenance.cleanup(res.table)
    assert again.preview_total == 0 and again.deleted == 0


def test_documented_normalisation_examples(spark):
    t = _table(spark, {"マイナビ Tech+ enterprise": 1, "ITmedia PC USER": 1, "日経クロステック（xTECH）": 1,
                       "GIGAZINE": 1, "マイナビニュース": 1})
    out, counts = maintenance.normalise(t, "default", NOW)
    got = {r.id.rsplit("-", 1)[0]: (r.source, r.updated_at) for r in out.collect()}
    assert got["マイナビ Tech+ enterprise"] == ("マイナビ Tech+", NOW)
    assert got["ITmedia PC USER"] == ("ITmedia", NOW)
    assert got["日経クロステック（xTECH）"] == ("日経XTECH", NOW)
    assert got["GIGAZINE"] == ("GIGAZINE", dt.datetime(2024, 1, 1))
    assert "マイナビニュース" not in got
    c = {(r.kind, r.match): r.rows for r in counts.collect()}
    assert c[("delete", "マイナビニュース")] == 1 and c[("rule", "ITmedia%")] == 1


def test_rules_twice_equal_once(spark):
    t = _table(spark, {"TECH+": 2, "ITmedia NEWS": 3, "日経x": 1, "other": 1})
    for name in ("default", "sql"):
        once, _ = maintenance.normalise(t, name, NOW)
        twice, counts = maintenance.normalise(once, name, NOW)
        assert sorted(map(tuple, once.select("id", "source").collect())) == \
            sorted(map(tuple, twice.select("id", "source").collect()))
        assert sum(r.rows for r in counts.collect()) == 0


def test_delete_null_predicate_keeps_row(spark):
    t = spark.createDataFrame([("a", None), ("b", "x")], "id string, source string")
    kept, counts = R.delete_where(t, F.col("source") == "x")
    assert [r.id for r in kept.collect()] == ["a"]
    assert counts.first().deleted == 1
