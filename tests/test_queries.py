"""Every registered query against its DuckDB oracle on sf0.001 (rows-only where no oracle)."""

import duckdb
import pytest

import __spark_entry__ as E
from sylvan.plans import ORACLES, QUERIES
from sylvan.sources.tables import TABLES
from tools.oracle_check import _approx, _rows

from .conftest import SF001

# result types must agree too (the driver compares schemas)
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT"}


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "node_id" in df.columns


def test_every_query_has_oracle_or_is_declared_rows_only():
    rows_only = set(QUERIES) - set(ORACLES)
    assert rows_only <= {"cart_classify", "cart_regress", "html_elements"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in sdf.collect()]
    assert srows, "an empty result proves nothing"
    plan = sdf._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    if name not in ORACLES:
        return
    rel = con.sql(ORACLES[name])
    spark_types = {f.name.lower(): SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in sdf.schema.fields}
    duck_types = {c.lower(): str(t) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types
    dcols = list(rel.columns)
    drows = rel.fetchall()
    sc, sr = _rows(sdf.columns, srows)
    dc, dr = _rows(dcols, drows)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr or _approx(sr, dr)
