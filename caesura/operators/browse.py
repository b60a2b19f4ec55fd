"""Looking through examples: filters, orders, labels and comparison of gold with predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caesura.functions.text import STUDENT_LABELS, let, once, sid_number


def boundary_labels(output: Column) -> Column:
    """Labels of an output's lines with two tokens and a known label, in order."""
    tokens = F.transform(F.split(output, "\n"), lambda x: let(F.trim(x), lambda t: F.when(t.rlike(r"[\t\x0b-\r]|  "), F.split(t, r"\s+")).otherwise(F.split(t, " "))))
    return F.transform(F.filter(tokens, lambda t: (F.size(t) == 2) & sid_number(F.get(t, F.lit(0))).isNotNull() & F.get(t, F.lit(1)).isin(STUDENT_LABELS)), lambda t: F.get(t, F.lit(1)))


def filter_examples(examples: DataFrame, query: str = "", boundaries: str = "all", label: str = "all") -> DataFrame:
    """examples: example_id, document_id, input, output. boundaries: all, boundary_only or no_boundary. Case is folded by lower()."""
    out = examples
    if query.strip():
        out = out.where(F.contains(F.lower(F.concat_ws("\n", "example_id", "document_id", "input", "output")), F.lit(query.strip().lower())))
    if boundaries == label == "all":
        return out
    rows = once(out, labels=boundary_labels(F.col("output")))
    if boundaries == "boundary_only":
        rows = rows.where(F.size("labels") > 0)
    elif boundaries == "no_boundary":
        rows = rows.where(F.size("labels") == 0)
    return (rows if label == "all" else rows.where(F.array_contains("labels", label))).drop("labels")


def sort_examples(examples: DataFrame, order: str = "example_id") -> DataFrame:
    """By example_id, document_id, boundary_count or text_length (greatest first), or label; ties by example_id."""
    n = F.size(boundary_labels(F.col("output")))
    keys = {"example_id": [], "document_id": [F.col("document_id")], "boundary_count": [n.desc()], "text_length": [F.length("input").desc()], "label": [F.array_join(F.array_sort(F.array_distinct(boundary_labels(F.col("output")))), ",")]}
    return examples.orderBy(*keys[order], "example_id")


def label_histogram(examples: DataFrame) -> DataFrame:
    """label, n over all labels, zero included; and NO_BOUNDARY for examples without any."""
    labels = let(boundary_labels(F.col("output")), lambda x: F.when(F.size(x) == 0, F.array(F.lit("NO_BOUNDARY"))).otherwise(x))
    counts = examples.select(F.explode(labels).alias("label")).groupBy("label").agg(F.count("*").alias("n"))
    grid = examples.sparkSession.createDataFrame([(x,) for x in [*STUDENT_LABELS, "NO_BOUNDARY"]], "label string")
    return F.broadcast(grid).join(counts, "label", "left").select("label", F.coalesce("n", F.lit(0)).alias("n"))


def status(gold: Column, predicted: Column) -> Column:
    return F.when(predicted.isNull(), "-").when(gold == predicted, "match").when(gold == "none", "FP").when(predicted == "none", "FN").otherwise("label_mismatch")


def with_mappings(examples: DataFrame, mappings: DataFrame) -> DataFrame:
    """examples with the mapping that names them under either of its two example ids."""
    both = mappings.select(F.explode(F.array("sparse_example_id", "first_boundary_example_id")).alias("example_id"), F.struct("custom_id", "source_path", "local_to_source").alias("mapping"))
    return examples.join(both, "example_id", "left")
