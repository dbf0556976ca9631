"""Every core query against its SQL on the smallest data, and on empty tables."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

from foliomill.plans import catalogue

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def norm(v):
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    if isinstance(v, pd.Timestamp):
        return str(v.tz_localize(None) if v.tzinfo else v)
    try:
        return round(float(v), 6)
    except (TypeError, ValueError):
        return str(v)


def rows(frame, columns):
    return sorted(str(tuple(map(norm, r))) for r in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, db, name):
    a, b = QUERIES[name](spark, SF).toPandas(), db.sql(SQL[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a, sorted(a.columns)) == rows(b, sorted(a.columns))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("nothing")
    for p in glob.glob(f"{SF}/*.parquet"):
        spark.read.parquet(p).limit(0).write.parquet(f"{d}/{os.path.basename(p)}")
    return str(d)


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n not in ("r_rollup", "r_cube")])
def test_query_on_empty_tables(spark, nothing, name):
    assert QUERIES[name](spark, nothing).count() == 0


@pytest.fixture(scope="module")
def dirty(spark, tmp_path_factory):
    from dirty import write

    d = str(tmp_path_factory.mktemp("dirty"))
    write(spark, SF, [os.path.basename(p)[:-8] for p in glob.glob(f"{SF}/*.parquet")], d)
    return d


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_on_dirty_tables(spark, dirty, name):
    QUERIES[name](spark, dirty).write.format("noop").mode("overwrite").save()
