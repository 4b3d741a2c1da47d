"""Every registered query against its DuckDB SQL (sf0.001), plus the entry point."""
import pytest

from tests.oracle_check import compare


def test_entry(spark):
    import __spark_entry__ as E
    rows = E.entry(spark).collect()
    assert len(rows) > 0


def test_all_queries_match_sql(spark):
    out = compare(spark, "/root/testdata/sf0.001", verbose=False)
    bad = {k: v for k, v in out.items() if v != "OK" and not v.startswith("rows-only")}
    assert not bad, bad
