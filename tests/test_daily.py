"""End to end: saved payloads -> LAND -> RAW -> TRUSTED -> mart, then LAND truncated."""

import json
import os
import uuid
from datetime import datetime

import pytest

from laminar.plans import layers, tables
from laminar.plans.contracts import INFRASTRUCTURE, SCHOOLS, STATISTICS
from laminar.plans.daily import extract_infrastructure, extract_schools, extract_statistics, run_daily
from laminar.sources.payloads import INFRA_DEPENDENCIES, INFRA_YEARS, STATE_CODES

SAMPLE = {"string": "x", "long": "1", "double": "512.5", "bool": "true", "year": "2020",
          "dmy": "1/2/2020"}


def school(cod, uf, dep, score, socio):
    obj = {f.source: SAMPLE[f.kind] for f in SCHOOLS.fields}
    obj.update(cod=cod, siglaUf=uf, dependenciaAdministrativa=str(dep), enemMediaGeral=str(score),
               socioEconomico=socio, nome=f"Escola {cod}")
    return obj


def stats(uf, geral):
    obj = {f.source: SAMPLE[f.kind] for f in STATISTICS.fields}
    obj.update(nomeLocal=uf, enemMediaGeral=str(geral), id=uf)
    return obj


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def payload_dir(tmp):
    d = f"{tmp}/payloads"
    write(f"{d}/cidades/sp.json", json.dumps(["3500105 - Adamantina", "3550308 - São Paulo",
                                              "3500204 - Adolfo"]))
    write(f"{d}/busca_capital/shard1.json", json.dumps([2, [{"cod": "c1"}, {"cod": "c2"}]]))
    write(f"{d}/busca_capital/shard2.json", json.dumps([1, [{"cod": "c2"}]]))
    write(f"{d}/busca_cidades/cidade=3500105/r.json", json.dumps([1, [{"cod": "a1"}]]))
    write(f"{d}/busca_cidades/cidade=3500204/r.json", json.dumps([0, []]))
    write(f"{d}/busca_cidades/cidade=3599999/r.json", json.dumps([1, [{"cod": "zz"}]]))
    schools = [school("c1", "SP", 1, 650.0, "Alto"), school("c2", "SP", 4, 480.0, "Baixo"),
               school("a1", "SP", 3, 720.0, "Médio"), school("zz", "SP", 2, 500.0, "Alto")]
    write(f"{d}/escolas/part.json", "\n".join(json.dumps(s) for s in schools))
    write(f"{d}/estatisticas/part.json", "\n".join(json.dumps(stats(u, g))
                                                   for u, g in ((u, 500.0 + i) for i, u in enumerate(STATE_CODES))))
    infra = [{"section": "Água", "items": [{"label": "Filtrada", "values": [
        {"entidade": "SP", "value": "90.5", "escolas": "10.5", "slug": "sp", "qtd_escolas": "12"}]}]}]
    for year in INFRA_YEARS:
        for dep in INFRA_DEPENDENCIES:
            write(f"{d}/infraestrutura/ano={year}/dep={dep}/p.json", json.dumps(infra))
    return d


def test_daily_run(spark, tmp_path):
    root = f"{tmp_path}/{uuid.uuid4().hex}"
    paths = run_daily(spark, payload_dir(tmp_path), root, now=datetime(2024, 5, 2, 12, 0))
    raw_schools = layers.read_raw(spark, SCHOOLS, paths.raw(SCHOOLS))
    # c1, c2 (twice: on two shards), a1; zz's city is not in the city list
    assert sorted(r["cod"] for r in raw_schools.collect()) == ["a1", "c1", "c2", "c2"]
    trusted = layers.read_trusted(spark, SCHOOLS, paths.trusted(SCHOOLS))
    assert dict(trusted.dtypes)["agua_filtrada"] == "boolean"
    assert dict(trusted.dtypes)["ano_censo"] == "date"
    infra = layers.read_trusted(spark, INFRASTRUCTURE, paths.trusted(INFRASTRUCTURE))
    assert infra.count() == 24 and {r["escolas"] for r in infra.collect()} == {11}
    assert {r["id"] for r in infra.collect()} == {None}
    mart = tables.read(spark, paths.mart)
    assert len(mart.columns) == 32
    # 4 school rows in SP x 1 statistics row x 2 type groups (Pública, Privada)
    assert mart.count() == 8
    for c in (SCHOOLS, STATISTICS, INFRASTRUCTURE):
        assert layers.read_land(spark, c, paths.land(c)).count() == 0
    archived = spark.read.parquet(f"{paths.archive}/2024/05/02/{SCHOOLS.name}")
    assert archived.count() == 4
    from laminar.plans.views import register_views
    assert "datamart_diretoria" in register_views(spark, paths)
    row = spark.sql("SELECT count(*) AS n, count(DISTINCT ESCOLA) AS e FROM datamart_diretoria "
                    "WHERE SIGLA_UF = 'SP'").first()
    assert (row["n"], row["e"]) == (8, 3)
    assert spark.sql("SELECT count(*) FROM api_escolas_trusted").first()[0] == 4


def test_extract_schools_keeps_shard_duplicates_unless_asked(spark, tmp_path):
    d = payload_dir(tmp_path)
    assert sorted(r["cod"] for r in extract_schools(spark, d).collect()) == ["a1", "c1", "c2", "c2"]
    assert sorted(r["cod"] for r in extract_schools(spark, d, dedupe=True).collect()) == ["a1", "c1", "c2"]


def test_daily_run_with_streamed_raw_copy_is_exactly_once(spark, tmp_path):
    root = f"{tmp_path}/{uuid.uuid4().hex}"
    d = payload_dir(tmp_path)
    paths = run_daily(spark, d, root, now=datetime(2024, 5, 2, 12, 0), raw_stream=True)
    assert layers.read_raw(spark, SCHOOLS, paths.raw(SCHOOLS)).count() == 4
    # the next day: LAND was truncated, a new batch lands; RAW gains only the new batch
    paths = run_daily(spark, d, root, now=datetime(2024, 5, 3, 12, 0), raw_stream=True)
    raw = layers.read_raw(spark, SCHOOLS, paths.raw(SCHOOLS))
    assert raw.count() == 8
    assert raw.select("partition_time").distinct().count() == 2
    assert layers.read_trusted(spark, SCHOOLS, paths.trusted(SCHOOLS)).count() == 4
    assert tables.read(spark, paths.mart).count() == 8


def test_command_line_runs_the_daily_job(spark, tmp_path, capsys):
    from laminar.__main__ import main
    root = f"{tmp_path}/{uuid.uuid4().hex}"
    main([payload_dir(tmp_path), root])
    out = json.loads(capsys.readouterr().out)
    assert spark.read.parquet(out["mart"]).count() == 8
    assert spark.read.parquet(out["escolas"]["trusted"]).count() == 4


# ---------------------------------------------------------------- the extract is complete or fails

def written(df, tmp_path):
    """The landing write: only what it reads survives the optimizer."""
    df.select(df.columns[0]).write.parquet(f"{tmp_path}/{uuid.uuid4().hex}")


def remove(path):
    import shutil
    shutil.rmtree(path)


def test_a_listed_city_without_a_saved_search_fails(spark, tmp_path):
    d = payload_dir(tmp_path)
    remove(f"{d}/busca_cidades/cidade=3500204")
    with pytest.raises(Exception, match="no payload for cidade 3500204"):
        written(extract_schools(spark, d), tmp_path)


def test_a_found_school_without_a_detail_fails(spark, tmp_path):
    d = payload_dir(tmp_path)
    write(f"{d}/busca_capital/shard3.json", json.dumps([1, [{"cod": "lost"}]]))
    with pytest.raises(Exception, match="no payload for cod lost"):
        written(extract_schools(spark, d), tmp_path)


@pytest.mark.parametrize("place, extract", [
    ("busca_capital/shard1.json", extract_schools), ("busca_cidades/cidade=3500105/r.json", extract_schools),
    ("cidades/sp.json", extract_schools), ("infraestrutura/ano=2020/dep=4/p.json", extract_infrastructure)])
@pytest.mark.parametrize("payload", ['{"error": "too many requests"}', '"busy"', "not json"])
def test_an_error_object_fails(spark, tmp_path, place, extract, payload):
    d = payload_dir(tmp_path)
    write(f"{d}/{place}", payload)
    with pytest.raises(Exception):
        written(extract(spark, d), tmp_path)


def test_error_objects_inside_the_infrastructure_lists_fail(spark, tmp_path):
    d = payload_dir(tmp_path)
    for payload in ('[{"error": 1}]', '[{"section": "s", "items": [{"label": "l"}]}]'):
        write(f"{d}/infraestrutura/ano=2020/dep=4/p.json", payload)
        with pytest.raises(Exception, match="without"):
            written(extract_infrastructure(spark, d), tmp_path)


def test_states_and_requests_drive_the_read(spark, tmp_path):
    d = payload_dir(tmp_path)
    assert extract_statistics(spark, d).count() == 27
    with pytest.raises(Exception, match="no payload for the request nome_local=XX"):
        written(extract_statistics(spark, d, spark.createDataFrame([(s,) for s in (*STATE_CODES, "XX")], "nome_local string")), tmp_path)
    with pytest.raises(Exception, match="payload outside the requests: nome_local=TO"):
        written(extract_statistics(spark, d, spark.createDataFrame([(s,) for s in STATE_CODES[:-1]], "nome_local string")), tmp_path)
    write(f"{d}/infraestrutura/ano=2030/dep=4/p.json", "[]")
    with pytest.raises(Exception, match="payload outside the requests: ano=2030 dep=4"):
        written(extract_infrastructure(spark, d), tmp_path)
    remove(f"{d}/infraestrutura/ano=2030")
    remove(f"{d}/infraestrutura/ano=2015/dep=5")
    with pytest.raises(Exception, match="no payload for the request ano=2015 dep=5"):
        written(extract_infrastructure(spark, d), tmp_path)


def test_the_run_stops_at_wrong_keys_before_landing(spark, tmp_path):
    d = payload_dir(tmp_path)
    objects = [stats(u, 500.0) for u in STATE_CODES]
    for o in objects:
        del o["biblioteca"], o["id"]
    write(f"{d}/estatisticas/part.json", "\n".join(map(json.dumps, objects)))
    root = f"{tmp_path}/lake"
    with pytest.raises(Exception, match=r"keys missing from every object \['biblioteca', 'id'\]"):
        run_daily(spark, d, root, now=datetime(2024, 5, 2, 12, 0))
    assert layers.landed(spark, f"{root}/land/{STATISTICS.name}") == []
    objects[3] |= {"biblioteca": "1", "id": "x"}          # in one object is enough
    write(f"{d}/estatisticas/part.json", "\n".join(map(json.dumps, objects)))
    run_daily(spark, d, f"{tmp_path}/lake2", now=datetime(2024, 5, 2, 12, 0))
    objects[5]["novo"] = 1
    write(f"{d}/estatisticas/part.json", "\n".join(map(json.dumps, objects)))
    with pytest.raises(Exception, match="keys outside the contract novo"):
        run_daily(spark, d, f"{tmp_path}/lake3", now=datetime(2024, 5, 2, 12, 0))


def test_a_run_without_schools_ends_with_an_empty_mart(spark, tmp_path):
    d = payload_dir(tmp_path)
    write(f"{d}/busca_capital/shard1.json", "[0, []]")
    write(f"{d}/busca_capital/shard2.json", "[0, []]")
    write(f"{d}/busca_cidades/cidade=3500105/r.json", "[0, []]")
    paths = run_daily(spark, d, f"{tmp_path}/lake", now=datetime(2024, 5, 2, 1, 0))
    assert tables.read(spark, paths.mart).count() == 0 and len(tables.read(spark, paths.mart).columns) == 32
    assert layers.read_trusted(spark, SCHOOLS, paths.trusted(SCHOOLS)).count() == 0
    # 01:00 less three hours: the archive folder is the day of the stamp
    assert os.path.isdir(f"{paths.archive}/2024/05/01/{SCHOOLS.name}")
