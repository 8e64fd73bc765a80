"""Every registered query against its DuckDB oracle on the driver's tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL, SMOKE
from tests.oracle_check import duck, rows_of

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()
# a cheap set that is also run at sf0.01, where every branch of the fills occurs
AT_SMALL = ["q01_completeness_daily", "q12_linear_fill", "q65_temporal_fill_linear", "q18_first_non_null",
            "q30_sliding_in_day", "q40_spatial_fill_local"]


def _check(spark, base, name):
    got = QUERIES[name](spark, base).toPandas()
    want = duck(base).execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle_smoke(spark, name):
    _check(spark, SMOKE, name)


@pytest.mark.parametrize("name", AT_SMALL)
def test_query_matches_oracle_small(spark, name):
    _check(spark, SMALL, name)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SMOKE).count() > 0  # values: see the tests of its own module


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "completeness_ratio" in df.columns
