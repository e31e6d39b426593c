import math
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from laminar.functions import SOCIO_LEVELS
from laminar.operators import socio_correlation

SCHEMA = "sigla_uf string, socio_economico string, enem_media_geral double"


def naive(data):
    """The reference's cross join, run by DuckDB on the same rows."""
    pdf = pd.DataFrame(data, columns=["sigla_uf", "socio_economico", "enem_media_geral"])
    whens = " ".join(f"WHEN socio_economico = '{lab}' THEN {i}" for i, lab in enumerate(SOCIO_LEVELS))
    sql = f"""
    WITH s AS (SELECT CASE {whens} END AS x, enem_media_geral AS y FROM pdf
               WHERE socio_economico IS NOT NULL AND enem_media_geral IS NOT NULL),
         d AS (SELECT sigla_uf FROM pdf)
    SELECT d.sigla_uf,
      CASE WHEN count(CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 1 END) < 2 THEN NULL
           ELSE corr(x, y) END AS c
    FROM s, d GROUP BY d.sigla_uf"""
    con = duckdb.connect()
    con.register("pdf", pdf)
    return {r[0]: r[1] for r in con.execute(sql).fetchall()}


def ours(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    return {r["SIGLA_UF"]: r["CORRELACAO_SOCIOECONOMICA_ENEM"]
            for r in socio_correlation(df).collect()}


def same(a, b):
    if a is None or b is None:
        return a is None and b is None
    if math.isnan(a) or math.isnan(b):
        return math.isnan(a) and math.isnan(b)
    return abs(a - b) < 1e-9


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rewrite_equals_cross_join(spark, seed):
    rnd = random.Random(seed)
    labels = list(SOCIO_LEVELS) + ["Desconhecido", None]
    states = ["SP", "RJ", "MG", None]
    data = [(rnd.choice(states), rnd.choice(labels),
             None if rnd.random() < 0.1 else round(rnd.uniform(300, 800), 2)) for _ in range(150)]
    expected, got = naive(data), ours(spark, data)
    assert expected.keys() == got.keys()
    for k in expected:
        assert same(expected[k], got[k]), (k, expected[k], got[k])


def test_single_pair_is_null_alone_and_nan_when_repeated(spark):
    # one scored school; state A has 1 school (1 pair -> NULL), state B has 2 (2 copies -> NaN)
    data = [("A", "Alto", 500.0), ("B", None, None), ("B", None, 600.0)]
    got = ours(spark, data)
    assert got["A"] is None
    assert math.isnan(got["B"])


def test_zero_variance_and_nan_give_nan(spark):
    flat = [("A", "Alto", 500.0), ("A", "Alto", 600.0)]
    assert math.isnan(ours(spark, flat)["A"])
    with_nan = [("A", "Alto", 500.0), ("A", "Baixo", float("nan")), ("A", "Médio", 550.0)]
    assert math.isnan(ours(spark, with_nan)["A"])


def test_no_scored_school_gives_no_rows(spark):
    assert ours(spark, [("A", None, 500.0), ("B", "Alto", None)]) == {}


def test_same_value_in_every_state(spark):
    data = [("A", "Alto", 700.0), ("A", "Baixo", 420.0), ("B", "Médio", 515.0), ("C", None, None)]
    vals = [v for v in ours(spark, data).values()]
    assert len(vals) == 3 and all(same(v, vals[0]) for v in vals)


@pytest.mark.parametrize("seed", [4, 5])
def test_single_pass_profile_equals_shares_join_indicator(spark, seed):
    from laminar.operators import band_shares
    from laminar.operators.profile import state_profile
    rnd = random.Random(seed)
    labels = list(SOCIO_LEVELS) + ["Desconhecido", None]
    data = [(rnd.choice(["SP", "RJ", None]), rnd.choice(labels), rnd.choice([1, 2, 4, 7, None]),
             None if rnd.random() < 0.1 else float(rnd.choice([400, 500, 550, 600, 700, 750])))
            for _ in range(120)]
    df = spark.createDataFrame(data, "sigla_uf string, socio_economico string, "
                                     "dependencia_administrativa long, enem_media_geral double")
    shares = band_shares(df)
    ind = socio_correlation(df).withColumnRenamed("SIGLA_UF", "_u")
    joined = shares.join(ind, shares["SIGLA_UF"] == ind["_u"]).drop("_u")
    cols = sorted(joined.columns)

    def key(rows):
        return sorted(tuple(round(v, 9) if isinstance(v, float) and not math.isnan(v) else v
                            for v in (r[c] for c in cols)) for r in rows)
    assert key(state_profile(df).collect()) == key(joined.collect())


def test_correlation_edge_rules_from_moments(spark):
    from laminar.functions.sqltext import guarded_corr_sql, pair_moment_sqls
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 4.0), ("a", None, 9.0),
                                ("b", 1.0, 1.0), ("c", 1.0, 1.0), ("c", 1.0, 2.0)],
                               "k string, x double, y double")
    moments = df.groupBy("k").agg(*[F.expr(e) for e in pair_moment_sqls("x", "y")])
    got = {r["k"]: r["corr"] for r in moments.selectExpr("k", f"{guarded_corr_sql('pairs', 'cov', 'sd_x', 'sd_y')} AS corr").collect()}
    assert abs(got["a"] - 1.0) < 1e-12      # the NULL pair is skipped
    assert got["b"] is None                  # one pair
    assert math.isnan(got["c"])              # zero variance in x
