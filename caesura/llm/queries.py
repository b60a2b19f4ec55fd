"""The registered queries of this subpackage: each applies its operator to whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caesura.llm import attribution, chat, decontamination, divergence, ngram_join, packing, secrets, sharding, substrings, token_store
from caesura.llm.sql import ORACLES as ORACLES
from caesura.llm.store import documents, workspace
from caesura.llm.tokens import default_path


def op1_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(documents(spark, sf_dir))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(documents(spark, sf_dir)).drop("class_id")


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "token-store")
    token_store.write_store(documents(spark, sf_dir), path, default_path("word_bpe_49k.json"), end_id=2)
    return token_store.read_store(spark, path)


def op4_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    path = workspace(spark, "chat")
    chat.write_examples(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").unionByName(extra), path)
    return chat.digest(spark, path)


def op5_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.count_tokens(documents(spark, sf_dir), default_path("byte_bpe_50k.json"), rule="first")


def op6_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_shuffled_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, shards, seed = workspace(spark, "shards"), 8, 7
    sharding.write_shards(documents(spark, sf_dir), path, shards, seed)
    text = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    return sharding.read_shards(spark, path).select(
        "doc_id", (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), sharding.shard_of(F.col("doc_id"), shards + 1, seed).alias("grown_shard")
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def op9_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), default_path("byte_bpe_50k.json"), end_id=0)


def op10_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_distribution_divergence, op2_ngram_jaccard, op3_token_store, op4_chat_prefix_targets, op5_token_attribution, op6_simhash_decontamination, op7_shuffled_shards, op8_secret_scan, op9_cutting_stock_packing, op10_repeated_substrings)}
