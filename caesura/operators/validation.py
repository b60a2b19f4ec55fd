"""Document-level annotations: checks, training rows and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caesura.functions.text import BOUNDARY_TYPES

ITEM = "array<struct<sentence_id: string, split_after: boolean, boundary_type: string, confidence: double>>"


def document_issues(sentence_ids: Column, items: Column) -> Column:
    """Codes and sentence ids of all rule breaks: coverage, missing and unknown sentences (as strings sorted), labels."""
    given = F.transform(items, lambda i: i["sentence_id"])
    issue = lambda code, sid=None: F.struct(F.lit(code).alias("code"), (F.lit(None).cast("string") if sid is None else sid).alias("sentence_id"))
    none = F.array().cast("array<struct<code: string, sentence_id: string>>")
    coverage = F.when((F.size(F.array_except(sentence_ids, given)) > 0) | (F.size(F.array_except(given, sentence_ids)) > 0), F.array(issue("coverage_mismatch"))).otherwise(none)
    missing = F.transform(F.array_sort(F.array_except(sentence_ids, given)), lambda s: issue("missing_sentence_annotation", s))
    unknown = F.transform(F.array_sort(F.array_except(given, sentence_ids)), lambda s: issue("unknown_sentence_id", s))

    def labels(i: Column) -> Column:
        found = F.array(
            F.when(~i["boundary_type"].isin(BOUNDARY_TYPES), issue("unknown_boundary_type", i["sentence_id"])),
            F.when(~i["split_after"] & (i["boundary_type"] != "none"), issue("split_false_boundary_type_not_none", i["sentence_id"])),
            F.when(i["split_after"] & (i["boundary_type"] == "none"), issue("split_true_boundary_type_none", i["sentence_id"])),
        )
        return F.filter(found, lambda x: x.isNotNull())

    return F.concat(coverage, missing, unknown, F.flatten(F.transform(items, labels)))


def training_rows(sentences: DataFrame, items: DataFrame, threshold: float = 0.75) -> DataFrame:
    """sentences: document_id, sentence_index, sentence_id, block_id, paragraph_index. items: document_id, position, sentence_id,
    split_after, boundary_type, confidence, has_flags. Of several items of a sentence the last counts; a sentence without any is an error."""
    last = items.groupBy("document_id", "sentence_id").agg(F.max_by(F.struct("split_after", "boundary_type", "confidence", "has_flags"), "position").alias("item"))
    order = Window.partitionBy("document_id").orderBy("sentence_index")
    paired = sentences.withColumn("right", F.lead(F.struct("sentence_id", "block_id", "paragraph_index")).over(order))
    joined = paired.join(last, ["document_id", "sentence_id"], "left")
    joined = joined.withColumn("item", F.coalesce("item", F.raise_error(F.concat(F.lit("no annotation for "), F.col("sentence_id")))))
    same = F.coalesce((F.col("paragraph_index") == F.col("right.paragraph_index")) & (F.col("block_id") == F.col("right.block_id")), F.lit(False))
    return joined.select(
        "document_id", F.col("sentence_id").alias("left_sentence_id"), F.col("right.sentence_id").alias("right_sentence_id"), F.col("item.split_after").alias("split_after_left"), F.col("item.boundary_type").alias("boundary_type"), F.col("item.confidence").alias("teacher_confidence"),
        same.alias("same_original_paragraph"), F.when((F.col("item.confidence") < threshold) | F.col("item.has_flags"), "needs_review").otherwise("teacher_only").alias("review_status"),
    )


def summarize(items: DataFrame) -> DataFrame:
    """boundary_type (unknown where missing), n and n_split over annotation items."""
    return items.groupBy(F.coalesce("boundary_type", F.lit("unknown")).alias("boundary_type")).agg(F.count("*").alias("n"), F.sum(F.coalesce(F.col("split_after").cast("long"), F.lit(0))).alias("n_split"))
