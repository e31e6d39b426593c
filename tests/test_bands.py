from pyspark.sql import functions as F

from laminar.operators import band_counts, band_shares
from tests.conftest import rows


def test_bands_are_inclusive_and_overlap(spark):
    scores = [399.9, 400.0, 500.0, 600.0, 700.0, 700.1, None]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    r = band_counts(df, "s").first()
    assert (r["ENTRE_400_500"], r["ENTRE_500_600"], r["ENTRE_600_700"], r["MAIOR_700"]) == (2, 2, 2, 1)


def test_band_shares_keep_null_type_and_use_global_totals(spark):
    data = [("SP", 1, 450.0), ("SP", 4, 450.0), ("SP", 9, 450.0), ("SP", None, 800.0),
            ("RJ", 2, 450.0), (None, 1, 450.0)]
    df = spark.createDataFrame(data, "sigla_uf string, dependencia_administrativa long, "
                                     "enem_media_geral double")
    out = band_shares(df)
    got = rows(out, "TIPO_ESCOLA", "SIGLA_UF", "ENTRE_400_500", "RATIO_400_500", "MAIOR_700",
               "RATIO_MAIOR_700")
    # five schools in 400-500 overall (NULL state included), one above 700
    assert (None, "SP", 1, 20.0, 1, 100.0) in got
    assert ("Privada", "SP", 1, 20.0, 0, 0.0) in got
    assert ("Pública", "SP", 1, 20.0, 0, 0.0) in got
    assert ("Pública", "RJ", 1, 20.0, 0, 0.0) in got
    assert ("Pública", None, 1, 20.0, 0, 0.0) in got
    assert len(got) == 5


def test_band_share_ratio_null_when_total_zero(spark):
    df = spark.createDataFrame([("SP", 1, 100.0)], "sigla_uf string, dependencia_administrativa long, "
                                                   "enem_media_geral double")
    r = band_shares(df).first()
    assert r["ENTRE_400_500"] == 0 and r["RATIO_400_500"] is None


def test_band_share_plan_scans_schools_once(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.range(1000).select(
        (F.col("id") % 7).cast("string").alias("sigla_uf"),
        (F.col("id") % 5).alias("dependencia_administrativa"),
        (F.col("id") % 900).cast("double").alias("enem_media_geral")).write.parquet(path)
    out = band_shares(spark.read.parquet(path))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan or "ReusedSubquery" in plan
