"""Dashboard indicators the reference declares but never computes.

Definitions are ours; each keeps the large tables partitioned: counts are
pre-aggregated per customer and year before the customer join, rankings run
over one row per state, the overall mean is a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laminar.functions import percent


def growth_vs_total(orders: DataFrame, customers: DataFrame, nations: DataFrame, focus: str,
                    years: int = 5) -> DataFrame:
    """Per year: orders of the focus state and of all states, and growth over ``years``."""
    per_customer = (orders.groupBy(F.col("o_custkey").alias("c_custkey"),
                                   F.year("o_orderdate").cast("bigint").alias("ano"))
                    .agg(F.count(F.lit(1)).alias("n")))
    located = (per_customer.join(customers.select("c_custkey", "c_nationkey"), "c_custkey", "left")
               .join(nations.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"),
                     "c_nationkey", "left"))
    yearly = located.groupBy("ano").agg(
        F.sum(F.when(F.col("n_name") == focus, F.col("n")).otherwise(0)).alias("focus_orders"),
        F.sum("n").alias("total_orders"))
    # one row per year; the frame holds just the row of that year minus ``years``
    before = Window.orderBy("ano").rangeBetween(-years, -years)
    joined = yearly.select("*", F.first("focus_orders").over(before).alias("_pf"),
                           F.first("total_orders").over(before).alias("_pt")).where(F.col("_pt").isNotNull())
    return joined.select(
        "ano", "focus_orders", "total_orders",
        percent(F.col("focus_orders") - F.col("_pf"), F.col("_pf")).alias("focus_growth_pct"),
        percent(F.col("total_orders") - F.col("_pt"), F.col("_pt")).alias("total_growth_pct"))


def rank_states(schools: DataFrame, state: str, score: str) -> DataFrame:
    """Mean score per state and its rank (1 = highest); ties share a rank.

    The window has no partition key but runs over one row per state.
    """
    means = schools.groupBy(F.col(state).alias("SIGLA_UF")).agg(F.avg(score).alias("media"))
    return means.withColumn("posicao", F.rank().over(Window.orderBy(F.col("media").desc())))


def against_overall(schools: DataFrame, score: str) -> DataFrame:
    """Each row with the overall mean (scalar subquery) and its difference from it."""
    overall = schools.select(F.avg(score)).scalar()
    return schools.select("*", overall.alias("media_geral"),
                          (F.col(score) - overall).alias("diferenca"))
