"""A payload folder derived from the driver's tables, in the layout ``run_daily`` reads.

The school model of ``analogue.py`` (school = customer, state = nation,
score = balance), written as the API's documents so the whole daily job
(U1-U10) runs on data that grows with the tables:

* ``cidades``: 'id - name' per nation (city id = the nation key on 7 digits;
  nation 0 plays the capital);
* ``busca_capital``: the capital's customers found through the reference's
  seven score shards, balance = score x 10, shared endpoints kept;
* ``busca_cidades/cidade=<id>``: every nation's customers, ``[0, []]`` for a
  nation without customers;
* ``escolas``: one object per customer with all 135 school keys;
* ``estatisticas``: one object per nation with all 100 statistics keys;
* ``infraestrutura/ano=<y>/dep=<d>``: order counts nested as section ->
  items -> values.

Every document is capped: envelopes and lists hold at most ``BLOCK``
entries (grouped by a key block, not by a possibly huge key), nested
payloads are bounded by the number of priorities and statuses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laminar.functions.sqltext import literal
from laminar.plans import analogue as A
from laminar.plans.contracts import SCHOOLS, STATISTICS
from laminar.plans.daily import concurrently
from laminar.sources.payloads import CAPITAL_SCORE_SHARDS, parameter_grid, shard_filter

CAPITAL_NATION = 0
SCORE_SCALE = 10
BLOCK = 1000
CAPITAL_SHARDS = tuple((lo * SCORE_SCALE, hi * SCORE_SCALE) for lo, hi in CAPITAL_SCORE_SHARDS)


def city_id(c: Column) -> Column:
    return F.lpad(c.cast("string"), 7, "0")


CAPITAL_ID = "0000000"


def _block(c: str) -> Column:
    return F.floor(F.col(c) / BLOCK)


def _envelope(key_col: str) -> Column:
    """``[count, [ {cod}, ... ]]`` text of the rows in the group."""
    items = F.to_json(F.collect_list(F.struct(F.col(key_col).cast("string").alias("cod"))))
    return F.concat(F.lit("["), F.count(F.lit(1)).cast("string"), F.lit(","), items, F.lit("]"))


def _json_object(fields: list[tuple[str, str]]) -> str:
    """``to_json(named_struct(...))`` of (key, SQL expression) pairs, as SQL text."""
    return "to_json(named_struct(" + ", ".join(f"{literal(k)}, {e}" for k, e in fields) + ")) AS value"


def school_objects(customers: DataFrame, nations: DataFrame) -> DataFrame:
    """One JSON object per customer with every school key of the contract (one selectExpr)."""
    c = customers.join(nations, customers["c_nationkey"] == nations["n_nationkey"], "left")
    dep = "(pmod(c_custkey, 5) + 1)"
    labels = " ".join(f"WHEN {dep} = {i} THEN {literal(lab)}"
                      for i, lab in enumerate(A.DEPENDENCY_LABELS, 1))
    special = {
        "cod": "CAST(c_custkey AS STRING)", "anoCenso": "CAST(2019 + n_regionkey AS STRING)",
        "nome": "c_name", "siglaUf": "n_name",
        "nomeMunicipio": "c_mktsegment", "socioEconomico": "c_mktsegment",
        "tipoLocalizacaoTxt": "CASE WHEN c_acctbal >= 0 THEN 'Urbana' ELSE 'Rural' END",
        "dependenciaAdministrativa": dep, "dependenciaAdministrativaTxt": f"CASE {labels} END",
        "enemMediaGeral": "c_acctbal", "idebAF": "c_acctbal / 1000",
    }
    for land, divisor in A.SUBJECT_DIVISORS:
        source = next(f.source for f in SCHOOLS.fields if f.land == land)
        special[source] = f"c_acctbal / {divisor}"
    by_kind = {
        "string": "c_name", "long": "pmod(c_custkey, 97)", "double": "c_acctbal",
        "bool": "pmod(c_custkey, 2) = 0", "year": "'2020'",
        "dmy": "date_format(make_date(2020, pmod(c_custkey, 12) + 1, pmod(c_custkey, 28) + 1), 'd/M/yyyy')",
    }
    fields = [(f.source, special.get(f.source, by_kind[f.kind])) for f in SCHOOLS.fields]
    return c.selectExpr(_json_object(fields))


def statistics_objects(suppliers: DataFrame, nations: DataFrame) -> DataFrame:
    """One JSON object per nation: supplier balances averaged (the analogue's statistics)."""
    stats = (suppliers.join(nations, suppliers["s_nationkey"] == nations["n_nationkey"], "inner")
             .groupBy("n_nationkey", "n_name").agg(F.avg("s_acctbal").alias("_mean")))
    special = {"id": "CAST(n_nationkey AS STRING)", "ano": "2023", "tipoLocal": "'EST'",
               "nomeLocal": "n_name", "codMunicipio": "0", "melhores": "0",
               "enemMediaGeral": "round(_mean, 6)", "idebAF": "round(_mean / 1000, 6)"}
    for land, divisor in A.SUBJECT_DIVISORS:
        source = next(f.source for f in STATISTICS.fields if f.land == land)
        special[source] = f"round(_mean / {divisor}, 6)"
    fields = [(f.source, special.get(f.source, "round(_mean, 6)")) for f in STATISTICS.fields]
    return stats.selectExpr(_json_object(fields))


def request_grid(orders: DataFrame) -> DataFrame:
    """The (ano, dep) requests: every year of the orders with every dependency."""
    years = orders.where("o_orderdate IS NOT NULL").select(F.year("o_orderdate").alias("ano")).distinct()
    return parameter_grid(years, "ano")


def infrastructure_payloads(orders: DataFrame) -> DataFrame:
    """Per (year, dependency) request: priorities -> statuses -> one value each (an empty list without orders)."""
    req = orders.select(F.year("o_orderdate").alias("ano"),
                        F.when(F.col("o_orderstatus") == "F", 4).otherwise(5).alias("dep"),
                        "o_orderpriority", "o_orderstatus")
    counts = req.groupBy("ano", "dep", "o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("ano", "dep"))   # over the few count rows
    value = F.struct(F.col("o_orderstatus").alias("entidade"),
                     F.round(F.col("n") * 100 / total, 4).cast("string").alias("value"),
                     (F.col("n") + 0.5).cast("string").alias("escolas"),
                     F.lower("o_orderstatus").alias("slug"),
                     total.cast("string").alias("qtd_escolas"))
    items = counts.select("ano", "dep", "o_orderpriority",
                          F.struct(F.col("o_orderstatus").alias("label"),
                                   F.array(value).alias("values")).alias("item"))
    sections = (items.groupBy("ano", "dep", "o_orderpriority")
                .agg(F.collect_list("item").alias("items"))
                .select("ano", "dep", F.struct(F.col("o_orderpriority").alias("section"),
                                               "items").alias("sec")))
    filled = sections.groupBy("ano", "dep").agg(F.to_json(F.collect_list("sec")).alias("value"))
    return request_grid(orders).select("ano", "dep").join(filled, ["ano", "dep"], "left").withColumn("value", F.coalesce("value", F.lit("[]")))


def write_payloads(spark: SparkSession, sf_dir: str, out: str) -> str:
    """Write the whole payload folder (JSON lines) under ``out``; return ``out``."""
    c = A.table(spark, sf_dir, "customer")
    n = A.table(spark, sf_dir, "nation")
    label = F.concat(city_id(F.col("n_nationkey")), F.lit(" - "), F.col("n_name"))
    cities = (n.groupBy(_block("n_nationkey")).agg(F.to_json(F.collect_list(label)).alias("value"))
              .select("value"))

    capital = shard_filter(c.where(F.col("c_nationkey") == CAPITAL_NATION)
                           .select("c_custkey", "c_acctbal"), "c_acctbal", CAPITAL_SHARDS)
    capital_env = (capital.groupBy("shard", _block("c_custkey"))
                   .agg(_envelope("c_custkey").alias("value")).select("value"))

    found = (c.groupBy(city_id(F.col("c_nationkey")).alias("cidade"), _block("c_custkey"))
             .agg(_envelope("c_custkey").alias("value")).select("cidade", "value"))
    with_customers = c.select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    empty = (n.join(with_customers, "n_nationkey", "left_anti")
             .select(city_id(F.col("n_nationkey")).alias("cidade"), F.lit("[0,[]]").alias("value")))

    writes = [
        lambda: cities.write.text(f"{out}/cidades"),
        lambda: capital_env.write.text(f"{out}/busca_capital"),
        lambda: found.unionByName(empty).write.partitionBy("cidade").text(f"{out}/busca_cidades"),
        lambda: school_objects(c, n).write.text(f"{out}/escolas"),
        lambda: statistics_objects(A.table(spark, sf_dir, "supplier"), n)
        .write.text(f"{out}/estatisticas"),
        lambda: infrastructure_payloads(A.table(spark, sf_dir, "orders"))
        .write.partitionBy("ano", "dep").text(f"{out}/infraestrutura"),
    ]
    concurrently(lambda write: write(), writes)   # independent folders, concurrent jobs
    return out
