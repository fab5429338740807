"""Every catalog query against its DuckDB equivalent on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from oracles import ORACLES
from prodseries.plans.queries import CATALOG

SF = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        return "0.0" if isinstance(v, float) and v == 0 else str(v)

    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_every_query_has_an_equivalent():
    assert set(CATALOG) == set(ORACLES)
    # The text operators bring queries and statements of their own.
    assert set(CATALOG) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query(spark, duck, name):
    result = CATALOG[name](spark, SF)
    mine = canonical(result.columns, result.collect())
    plan = result._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan
    # As a view, which a statement with columns that only the data know cannot be.
    duck.execute(f"CREATE OR REPLACE VIEW their_result AS {ORACLES[name]}")
    cursor = duck.execute("SELECT * FROM their_result")
    assert mine == canonical([d[0] for d in cursor.description], cursor.fetchall())
