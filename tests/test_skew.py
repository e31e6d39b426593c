"""One key holding a third of all rows: results stay whole and no task gets the hot group."""

import contextlib
import io

from pyspark.sql import functions as F

from laminar.operators import band_counts, socio_correlation
from laminar.plans.marts import build_datamart
from laminar.sources import id_lookup
from tests.test_mart import SCHOOLS, STATS, school


def formatted(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def hot_schools(spark, n=3000):
    """A third of the schools in state 'HOT', the rest over 20 states."""
    data = [school(f"s{i}", "HOT" if i % 3 == 0 else f"U{i % 20}", i % 5 + 1,
                   float(350 + i % 500), ["Baixo", "Médio", "Alto", None][i % 4]) for i in range(n)]
    return spark.createDataFrame(data, SCHOOLS)


def test_band_counts_aggregate_before_the_shuffle(spark):
    df = hot_schools(spark)
    out = band_counts(df, "enem_media_geral", ["sigla_uf"])
    text = formatted(out)
    assert "partial_count" in text  # map-side combine: one row per key and task is shuffled
    got = {r["sigla_uf"]: r for r in out.collect()}
    assert len(got) == 21


def test_mart_keeps_every_hot_row(spark):
    df = hot_schools(spark)
    stats = spark.createDataFrame([("HOT", 1.0, 2.0, 3.0, 4.0, 5.0, 500.0, 6.0)]
                                  + [(f"U{i}", 1.0, 2.0, 3.0, 4.0, 5.0, 500.0, 6.0) for i in range(20)],
                                  STATS)
    mart = build_datamart(df, stats)
    types_per_state = (df.select("sigla_uf", F.when(F.col("dependencia_administrativa").isin(1, 2, 3), "P")
                                 .when(F.col("dependencia_administrativa") == 4, "R").alias("t"))
                       .distinct().groupBy("sigla_uf").count())
    expected = (df.groupBy("sigla_uf").count().withColumnRenamed("count", "n")
                .join(types_per_state, "sigla_uf").select(F.sum(F.col("n") * F.col("count"))).first()[0])
    assert mart.count() == expected


def test_correlation_with_hot_state_equals_per_state_value(spark):
    df = hot_schools(spark)
    vals = {r["CORRELACAO_SOCIOECONOMICA_ENEM"] for r in socio_correlation(df).collect()}
    assert len(vals) == 1  # one value for every state, however big one of them is


def test_hot_id_lookup_is_split_by_aqe(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        ids = spark.range(n).select(F.col("id").alias("req"),
                                    F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
                                    .alias("cod"))
        details = spark.range(1000).select(F.col("id").alias("cod"), (F.col("id") * 2).alias("v"))
        out = id_lookup(ids, details, "cod")
        assert out.count() == n
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "isSkewJoin=true" in plan or "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
