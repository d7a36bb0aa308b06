"""Every registered query against its DuckDB oracle on the smallest driver tables,
plus the driver's smoke contract for ``entry``."""

import os

import pytest

from oracle_check import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_all_registered_queries_match_oracle(spark):
    from skyledger.plans.catalog import QUERIES
    import __spark_entry__  # noqa: F401  (registers all parts)
    results = compare(spark, SF, sorted(QUERIES), verbose=False)
    bad = {k: v for k, v in results.items() if not (v.startswith("ok") or v.startswith("rows-only"))}
    assert not bad, bad


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].rows_count > 0
    assert set(E.oracle_sql()) <= set(E.queries())
