"""A corpus, stage by stage. Each function takes (spark, docs, sf_dir) and returns a DataFrame.

Documents that the quality rules reject go; of each group of near copies the one with the least doc_id stays; documents that hold a
benchmark item go; secrets are replaced by a mark (n_chars follows); what is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caesura.llm import decontamination, divergence, ngram_join, packing, secrets
from caesura.llm.store import documents, materialize
from caesura.llm.tokens import default_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return divergence.keep(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.representatives(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def token_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, default_path("byte_bpe_50k.json"), end_id=0)


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", ngram_jaccard_join), ("benchmark decontamination", benchmark_decontamination), ("secret scans", secret_scans), ("packing", token_packing)]
#: SQL has no tokenizer, forest or fingerprint; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
