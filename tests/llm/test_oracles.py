"""The DuckDB SQL of the training-data queries gives the rows of the Spark queries."""

import duckdb
import pytest

from laminar.llm.oracles import ORACLES
from laminar.llm.queries import QUERIES
from tools.oracle_check import normalise

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want, got = con.execute(ORACLES[name]).df(), QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert normalise(got) == normalise(want)
