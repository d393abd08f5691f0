"""Ordered results come out in order (the value comparison sorts rows)."""

from newsloom import registry
from newsloom.registered.base import with_articles
from tests.conftest import SF_SMALL
from tools.compare import duck


def _order(spark, name):
    return [tuple(r) for r in registry.queries()[name](spark, SF_SMALL).collect()]


def test_facets_and_counts_are_sorted(spark):
    desc = _order(spark, "a1_source_counts_desc")
    assert desc == sorted(desc, key=lambda r: (-r[1], r[0]))
    by_name = _order(spark, "a2_source_counts")
    assert by_name == sorted(by_name)
    names = _order(spark, "a5_sources")
    assert names == sorted(names)
    tags = [t for (t,) in _order(spark, "a6_tags")]
    assert [t for t in tags if t is not None] == sorted(t for t in tags if t is not None)
    assert None not in tags[:-1]


def test_worklist_is_newest_first(spark):
    got = [r[0] for r in _order(spark, "t2_worklist")]
    want = duck(SF_SMALL).execute(with_articles(
        "SELECT id FROM articles WHERE metadata_generated = FALSE ORDER BY created_at DESC NULLS FIRST, id")).fetchall()
    assert got == [i for (i,) in want]
