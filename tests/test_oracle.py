"""Every query with an oracle: Spark result equals DuckDB's on the same parquet tables (sf0.001)."""
import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from quillspark.sources.tables import TABLES

import importlib.util, os  # noqa: E401
_spec = importlib.util.spec_from_file_location("check", os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools", "check.py"))
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert check.digest(df.columns, rows)[0] == check.digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
