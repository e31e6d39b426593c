import json
import uuid

import pytest
from pyspark.sql import functions as F

from laminar.plans.contracts import SCHOOLS, Contract, ContractError
from laminar.sources import (KeyAudit, city_ids, envelope_ids, flatten_infrastructure, id_lookup, literal_grid,
                             parse_objects, shard_filter)
from tests.conftest import rows


def texts(spark, *values, **cols):
    data = [(v,) + tuple(c[i] for c in cols.values()) for i, v in enumerate(values)]
    schema = "value string" + "".join(f", {k} long" for k in cols)
    return spark.createDataFrame(data, schema)


def test_envelope_guard_and_explode(spark):
    p = texts(spark, '[2,[{"cod":1},{"cod":2}]]', "[0,[]]", "[0,null]")
    assert rows(envelope_ids(p), "cod") == [("1",), ("2",)]
    assert rows(envelope_ids(p, guard=False), "cod") == [("1",), ("2",)]


def test_shards_are_a_bag_union(spark):
    df = spark.createDataFrame([(1, 507.0), (2, 500.0), (3, 530.0), (4, 1200.0)], "cod long, s double")
    shards = ((1, 507), (507, 530), (530, 551))
    got = rows(shard_filter(df, "s", shards), "cod", "shard")
    assert got == [(1, 0), (1, 1), (2, 0), (3, 1), (3, 2)]
    union = None
    for i, (lo, hi) in enumerate(shards):
        part = df.where(F.col("s").between(lo, hi)).withColumn("shard", F.lit(i))
        union = part if union is None else union.unionByName(part)
    assert rows(union, "cod", "shard") == got


def test_nested_flatten(spark):
    payload = ('[{"section":"S1","items":[{"label":"L1","values":['
               '{"entidade":"e1","value":"10.5","escolas":"3","slug":"SP","qtd_escolas":"7"},'
               '{"entidade":"e2","value":"1","escolas":"1","slug":"RJ","qtd_escolas":"2"}]},'
               '{"label":"L2","values":[{"entidade":"e3","value":"2","escolas":"2","slug":"MG",'
               '"qtd_escolas":"3"},{"entidade":"e4","value":"3","escolas":"3","slug":"BA",'
               '"qtd_escolas":"4"}]}]},'
               '{"section":"S2","items":[]}]')
    p = spark.createDataFrame([(payload, 2015, 4), (payload, 2016, 5)], "value string, ano long, dep long")
    out = flatten_infrastructure(p)
    assert len(out.columns) == 9 and out.count() == 8
    r = out.where("entidade = 'e1' AND ano = '2015'").first()
    assert (r["secao"], r["tema"], r["porcentagem"], r["sigla_uf"], r["total_escolas"],
            r["tipo_escolas"]) == ("S1", "L1", "10.5", "SP", "7", "Privada")
    assert out.where("ano = '2016'").first()["tipo_escolas"] == "Pública"


def test_city_ids_prefix_and_exclusion(spark):
    p = texts(spark, '["3500105 - Adamantina", "3550308 - São Paulo", "3500204 - Adolfo"]')
    assert rows(city_ids(p), "cidade") == [("3500105",), ("3500204",)]


def test_parse_objects_renames_and_stringifies(spark):
    p = texts(spark, '{"cod": 35000012, "regFundamental9": true, "datashows": 2, "idebAF": 5.1}')
    out = parse_objects(p, SCHOOLS)
    assert out.columns == SCHOOLS.land_columns
    r = out.first()
    assert (r["cod"], r["reg_fundamental19"], r["data_shows"], r["ideb_af"]) == \
        ("35000012", "true", "2", "5.1")
    assert r["nome"] is None


def test_literal_grid(spark):
    g = literal_grid(spark)
    assert g.count() == 24
    assert rows(g.where("ano = 2012"), "dep", "tipo_escolas") == [(4, "Privada"), (5, "Pública")]


def test_strict_keys_in_the_pass_that_writes(spark, tmp_path):
    contract = Contract.from_text("t", "long: " + " ".join(f"key{i}" for i in range(130)) + "\nstring: orderStatus", "key0")

    def landed(*objects):
        audit = KeyAudit(contract)
        found = parse_objects(texts(spark, *map(json.dumps, objects)), contract, audit)
        out = audit.watch(found)
        assert out.columns == contract.land_columns
        out.write.parquet(path := f"{tmp_path}/{uuid.uuid4().hex}")
        audit.check()
        return rows(spark.read.parquet(path), "key0", "key129", "order_status")

    full = {f.source: 1 for f in contract.fields}
    assert landed(full) == [("1", "1", "1")]
    # every key is in one object at least, nulls count as present
    halves = [{k: None for i, k in enumerate(full) if i % 2 == half} for half in (0, 1)]
    assert landed(*halves) == [(None, None, None)] * 2
    with pytest.raises(ContractError, match=r"missing from every object \['key64', 'orderStatus'\]"):
        landed(*[{k: 1 for k in full if k not in ("key64", "orderStatus")}] * 3)
    with pytest.raises(Exception, match="keys outside the contract extraField"):
        landed(full, full | {"extraField": 3})
    assert landed() == []


def test_envelopes_of_another_shape_fail(spark):
    for bad in ('{"error": 1}', "[]", "[3]", '"x"', "7", "null", '[1, {"cod": 2}]', "[1, "):
        with pytest.raises(Exception):
            envelope_ids(texts(spark, "[0,[]]", bad), guard=False).collect()
    with pytest.raises(Exception):
        envelope_ids(texts(spark, '["many", []]')).collect()


def test_checks_survive_pruning(spark):
    ids = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    details = spark.createDataFrame([("a", "x")], "k string, v string")
    with pytest.raises(Exception, match="no payload for k b"):
        id_lookup(ids, details, "k", required_ids=True).select("v").collect()
    with pytest.raises(Exception, match="no payload for k b"):
        id_lookup(ids, details, "k", required_ids=True).select(F.lit(1)).collect()
    with pytest.raises(Exception, match="no payload for k b"):
        id_lookup(ids, details, "k", required_ids=True).count()
