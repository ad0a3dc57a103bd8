"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from support import SF_SMALL
from tools.check_oracle import TABLES, compare, type_mismatches

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    # the library's own; optional subpackages test what SQL cannot express in another way
    from paygrid.plans import queries
    assert set(queries.ORACLE) == set(queries.QUERIES)
    assert set(queries.QUERIES) <= set(QUERIES) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    res = duck.execute(ORACLE[name])
    problem = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert problem is None, problem
    assert type_mismatches(df.schema, res.description) == {}
    assert len(rows) > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and len(df.columns) == 51


def test_run_log_query(spark):
    rows = QUERIES["run_log"](spark, SF_SMALL).collect()
    assert len(rows) == 2
