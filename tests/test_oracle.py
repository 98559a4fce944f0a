"""Every registered query against its DuckDB oracle on sf0.001 (the
driver does the same at sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
# Spark simple type names -> DuckDB type names of equal values
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "date": "DATE"}
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    # scale guard: no query pairs every row with every row of another side
    plan = sdf._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in ORACLE:
        assert srows is not None
        return
    rel = con.sql(ORACLE[name])
    dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    stypes = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in sdf.schema.fields}
    assert stypes == dtypes
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, res.fetchall())
