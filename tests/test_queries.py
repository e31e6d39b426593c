"""Every registered query against its DuckDB oracle on the smallest test tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from laminar.queries import QUERIES  # noqa: E402
from oracle_check import TABLES, normalise  # noqa: E402
from type_check import SPARK_TO_DUCK  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(E.oracle_sql()) == set()
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_DIR)
    want_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == want_types
    got = df.toPandas()
    want = con.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert normalise(got) == normalise(want)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 32 and df.count() >= 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_product_or_python(spark, name):
    import contextlib
    import io

    from plan_report import WATCH
    df = E.queries()[name](spark, SF_DIR)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    assert [w for w in WATCH if w in buf.getvalue()] == []
