"""Driver queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.llm import (decontamination, divergence, line_rules, merkle, mixing, pii, ppm, quality, sharding, simhash_dedup,
                         substring_dedup, token_files, toxicity)
from laminar.llm.common import id_remainder, keyed, read_table
from laminar.llm.oracles import ORACLES  # noqa: F401  (the entry point reads it here)
from laminar.session import workspace


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", (id_remainder(F.col("doc_id"), quality.HELD_OUT_MOD) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(read_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = keyed(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    placed = mixing.placements(rows)
    first, second = (F.round(F.get("times", F.lit(k)), 6) for k in (0, 1))
    return (placed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", first.alias("position"), second.alias("position_2"))
            .repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id"))     # what is not taken comes first


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    # size and checksum stand for the text, so that whole texts are not shuffled
    rows = sharding.sizes(read_table(spark, sf_dir, "documents"))
    return (sharding.shard(rows, 8, key=("doc_id", "size", "text_crc32"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


def op5_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.evaluate(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("cleaned")


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_dedup.near_duplicates(docs, shingle=3, max_distance=2)


def op7_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = workspace(spark, "tokens")
    token_files.write_tokens(read_table(spark, sf_dir, "documents").select("doc_id", "text"), path,
                             public_tokenizers.path("word_bpe_49k.json"))
    return token_files.digest(token_files.read_tokens(spark, path))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.benchmark_matches(docs, read_table(spark, sf_dir, "benchmark"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves = merkle.tampered_leaves(read_table(spark, sf_dir, "documents"))
    proven = merkle.proofs(merkle.build(leaves, "lang", ["doc_id"]), ["doc_id", "claim"])
    return merkle.verify(proven).drop("idx", "claim")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents").select("lang", "source", "text"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_pii": op2_pii,
    "op3_mixing": op3_mixing,
    "op4_sharding": op4_sharding,
    "op5_line_rules": op5_line_rules,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_ppm": op7_ppm,
    "op8_token_files": op8_token_files,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_merkle": op12_merkle,
    "op13_divergence": op13_divergence,
}
