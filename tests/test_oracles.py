"""Every registered query with an oracle matches DuckDB on the small test tables; the others run."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import compare, duck

from flowguard import catalog

QUERIES = {k: q for k, q in E.queries().items() if k in catalog.QUERIES}
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k in ORACLES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    con.execute(f"CREATE OR REPLACE TEMP VIEW oracle AS {ORACLES[key]}")  # as the driver loads it
    cur = con.execute("SELECT * FROM oracle")
    res = compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description])
    assert res["cols_match"] and res["rows_spark"] == res["rows_sql"] and res["exact"], res


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k not in ORACLES))
def test_rows_only_queries_run(spark, key):
    assert QUERIES[key](spark, SF_SMALL).count() >= 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["class_label", "precision", "recall", "f1", "support"]
    assert df.count() > 0
