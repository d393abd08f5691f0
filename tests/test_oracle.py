"""Every registered query against its DuckDB oracle (small scale), and the
driver entry point."""

import pytest

from tests.conftest import SF_SMALL


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns[-1] == "pos"
    assert len(rows) >= 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_all_registered_queries_match_oracle(spark):
    from tools.compare import compare
    res = compare(spark, SF_SMALL, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "ROWS")}
    assert not bad, bad


@pytest.mark.parametrize("name", ["c3_search_page", "t4_keyset_page", "c1_collect_rows",
                                  "c2_enrich_rows", "x21_keyword_terms"])
def test_key_queries_mid_scale(spark, name):
    from tools.compare import compare
    from tests.conftest import SF_MID
    res = compare(spark, SF_MID, names={name}, verbose=False)
    assert res[name][0] == "OK", res[name]
