"""Every registered query against its DuckDB oracle on the smallest data set
(the driver repeats this at sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["ord", "question", "answer_span", "sentence_context"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(sdf.columns, s_rows)[0] == digest(o_cols, o_rows)[0]


def test_every_query_has_an_oracle():
    assert set(entry.QUERIES) == set(entry.ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())
