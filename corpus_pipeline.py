"""A corpus pipeline of five operators: toxicity filter, near-duplicate removal, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result to the
shared folder and reads it back as the next stage's documents, so a lost executor
only repeats tasks of the stage under way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from laminar.llm import decontamination, mixing, sharding, simhash_dedup, toxicity
from laminar.llm.common import materialise, read_table
from laminar.session import release, workspaces

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity passes the rejection threshold go."""
    model = toxicity.fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model).select(*COLUMNS)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash (3-word shingles, 2 bits) the one with the smallest id stays (NULL last)."""
    return simhash_dedup.keep_one(docs, shingle=3, max_distance=2).select(*COLUMNS)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window that matches a benchmark item go."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix in training order: one row per copy taken (no row for one not taken)."""
    return mixing.mixture(docs).select(*COLUMNS)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each row of the mix; copies of a document are rows of their own."""
    return sharding.shard(docs, 8).select(*COLUMNS, "shard", "slot")


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash_dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

# Training and SimHash cannot be expressed in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. A stage's working folders and its input go when its result is written."""
    docs, before = read_table(spark, sf_dir, "documents"), set(workspaces())
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark, [path for path in workspaces() if path not in before and f"pipeline-{name}-" not in path])
    return STAGES[-1][1](spark, docs, sf_dir)
