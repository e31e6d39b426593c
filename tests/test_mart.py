from datetime import date

from laminar.plans import tables
from laminar.plans.marts import build_datamart, mart_columns, school_means

SCHOOLS = ("nome string, nome_municipio string, sigla_uf string, tipo_localizacao_txt string, "
           "dependencia_administrativa long, dependencia_administrativa_txt string, ano_censo date, "
           "enem_portugues double, enem_matematica double, enem_humanas double, enem_naturais double, "
           "enem_redacao double, enem_media_geral double, ideb_af double, socio_economico string")
STATS = ("nome_local string, enem_portugues double, enem_matematica double, enem_humanas double, "
         "enem_naturais double, enem_redacao double, enem_media_geral double, ideb_af double")


def school(name, uf, dep, score, socio):
    d = date(2020, 1, 1)
    return (name, "M", uf, "Urbana", dep, str(dep), d, 1.0, 2.0, 3.0, 4.0, 5.0, score, 6.0, socio)


def fixture(spark):
    schools = [school("a1", "A", 1, 450.0, "Alto"), school("a2", "A", 4, 650.0, "Baixo"),
               school("a3", "A", None, 520.0, "Médio"), school("b1", "B", 2, 710.0, "Alto"),
               school("n1", None, 1, 480.0, "Baixo")]
    stats = [("A", 1.0, 2.0, 3.0, 4.0, 5.0, 500.0, 6.0), ("C", 1.0, 2.0, 3.0, 4.0, 5.0, 510.0, 6.0)]
    return spark.createDataFrame(schools, SCHOOLS), spark.createDataFrame(stats, STATS)


def test_fanout_and_dropped_states(spark):
    s, st = fixture(spark)
    mart = build_datamart(s, st)
    assert mart.columns == mart_columns() and len(mart.columns) == 32
    got = mart.collect()
    # state A: 3 schools x 1 stats row x 3 type groups (Pública, Privada, NULL); B has no
    # statistics row and the NULL state never joins.
    assert len(got) == 9
    assert {r["ESCOLA"] for r in got} == {"a1", "a2", "a3"}
    assert {r["TIPO_ESCOLA"] for r in got} == {"Pública", "Privada", None}
    per_school = {}
    for r in got:
        per_school.setdefault(r["ESCOLA"], set()).add(r["TIPO_ESCOLA"])
    assert all(v == {"Pública", "Privada", None} for v in per_school.values())


def test_repeated_statistics_rows_repeat_schools(spark):
    s, st = fixture(spark)
    mart = build_datamart(s, st.unionByName(st))
    assert mart.count() == 18


def jobs_of(spark, fn):
    """What ``fn`` returns, and the Spark jobs that it ran."""
    sc, group = spark.sparkContext, f"g-{id(fn)}"
    sc.setJobGroup(group, "test")
    try:
        return fn(), len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_building_the_mart_runs_nothing_and_keeps_nothing(spark, tmp_path):
    s, st = fixture(spark)
    s.write.parquet(str(tmp_path / "schools"))
    s = spark.read.schema(s.schema).parquet(str(tmp_path / "schools"))
    spark.catalog.clearCache()
    (mart, means), jobs = jobs_of(spark, lambda: (build_datamart(s, st), school_means(s, st)))
    assert jobs == 0 and spark._jsparkSession.sharedState().cacheManager().isEmpty()
    assert (mart.count(), means.count()) == (9, 3)
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def written_plan(spark, monkeypatch, s, st, path):
    from laminar.plans import marts
    seen = []
    real = marts.tables.replace
    monkeypatch.setattr(marts.tables, "replace", lambda df, *a: (df.collect(), seen.append(df._jdf.queryExecution().executedPlan().toString()), real(df, *a)))
    marts.write_datamart(s, st, path)
    return seen[0]


def test_written_mart_broadcasts_the_side_by_its_bytes(spark, tmp_path, monkeypatch):
    s, st = fixture(spark)
    s.write.parquet(str(tmp_path / "schools"))
    s = spark.read.schema(s.schema).parquet(str(tmp_path / "schools"))
    plan = written_plan(spark, monkeypatch, s, st, str(tmp_path / "mart"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert tables.read(spark, str(tmp_path / "mart")).count() == 9
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()


def test_a_side_beyond_the_bound_is_shuffled(spark, tmp_path, monkeypatch):
    s, st = fixture(spark)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "10")
    try:
        plan = written_plan(spark, monkeypatch, s, st, str(tmp_path / "mart"))
    finally:
        for name in names:
            spark.conf.unset(name)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert tables.read(spark, str(tmp_path / "mart")).count() == 9
