"""Every query with a SQL equivalent gives the same rows and types as DuckDB."""

import glob
import importlib.util
import math
import os

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "int": "INTEGER",
}


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", f"{ROOT}/__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


ENTRY = load_entry()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ENTRY.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    df = ENTRY.queries()[name](spark, SF)
    relation = duck.sql(ENTRY.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    want = dict(zip(relation.columns, map(str, relation.types)))
    assert {f.name: TYPES.get(f.dataType.simpleString()) for f in df.schema} == want
    assert rows_of(df.columns, df.collect()) == rows_of(relation.columns, relation.fetchall())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_entry_is_a_registered_query(spark):
    assert ENTRY.entry(spark).count() == 6


def test_all_oracles_are_registered():
    assert set(ENTRY.oracle_sql()) <= set(ENTRY.queries())


@pytest.mark.parametrize("name", sorted(set(ENTRY.queries()) - set(ENTRY.oracle_sql())))
def test_queries_without_sql_run(spark, name):
    assert ENTRY.queries()[name](spark, SF).count() > 0
