"""Sentences and overlapping target/context windows. A document is one row with an array of sentences, so nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caesura.functions.text import boundary_label, let, once, padded, split_lines


def sentence_array(text: Column) -> Column:
    """All sentences of a text whose lines are blocks, in order."""
    return split_lines(text)


def group_sentences(sentences: DataFrame) -> DataFrame:
    """document_id, sentences (texts in order) from a row a sentence (document_id, sentence_index, text): the one shuffle, where rows come that way."""
    return sentences.groupBy("document_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("sentence_index", "text"))), lambda s: s["text"]).alias("sentences"))


def explode_sentences(documents: DataFrame, cap: int | None = None) -> DataFrame:
    """document_id, sentence_id, sentence_index, text; at most cap sentences a document."""
    array = F.col("sentences") if cap is None else F.slice("sentences", 1, cap) if cap else F.slice("sentences", 1, 0)
    rows = documents.select("document_id", F.posexplode(array).alias("sentence_index", "text"))
    return rows.select("document_id", F.format_string("%s.s%04d", "document_id", "sentence_index").alias("sentence_id"), "sentence_index", "text")


def build_windows(documents: DataFrame, target_size: int = 160, left: int = 20, right: int = 20) -> DataFrame:
    """A row a window that has a candidate: ids, spans and its visible sentences with role and candidacy.

    Window w targets sentences [w T, w T + T) and shows `left` more before and `right` more after. A target is a candidate
    if the sentence after it is visible.
    """
    if target_size <= 0 or left < 0 or right < 0:
        raise ValueError("target_size must be positive, contexts not negative")
    stem = F.concat(F.coalesce("document_id", F.lit("null")), F.lit(".s"))
    rows = once(documents.select("document_id", "sentences"), texts=F.col("sentences"), stem=stem, n=F.size("sentences"))
    ids = F.transform("texts", lambda _, p: F.concat("stem", padded(p)))
    rows = once(rows.select("document_id", "texts", "stem", "n"), ids=ids)
    rows = rows.select("document_id", "texts", "ids", "n", F.explode(F.when(F.col("n") > 0, F.sequence(F.lit(0), F.ceil(F.col("n") / target_size).cast("int") - 1))).alias("window_index"))
    start = F.col("window_index") * target_size
    rows = rows.withColumns({"target_start": start, "target_end": F.least(start + target_size, F.col("n")), "visible_start": F.greatest(F.lit(0), start - left)})
    rows = rows.withColumn("visible_end", F.least(F.col("n"), F.col("target_end") + right))
    size, before, after = F.col("visible_end") - F.col("visible_start"), F.col("target_start") - F.col("visible_start"), F.col("visible_end") - F.col("target_end")
    candidates = F.least(F.col("target_end"), F.col("visible_end") - 1) - F.col("target_start")
    # Fields of visible as arrays beside each other: nothing is computed element by element.
    runs = lambda *parts: F.concat(*[F.array_repeat(F.lit(value), n) for value, n in parts])
    fields = {
        "local_sid": F.slice(F.array(*[F.lit(f"S{i + 1}") for i in range(left + target_size + right)]), F.lit(1), size), "source_sentence_id": F.slice("ids", F.col("visible_start") + 1, size),
        "global_sentence_index": F.sequence("visible_start", F.col("visible_end") - 1), "text": F.slice("texts", F.col("visible_start") + 1, size),
        "role": runs(("context", before), ("target", F.col("target_end") - F.col("target_start")), ("context", after)), "candidate": runs((False, before), (True, candidates), (False, size - before - candidates)),
    }
    rows = once(rows.where(candidates > 0).withColumns(fields), visible=F.arrays_zip(*fields))
    rows = rows.withColumn("targets", F.slice("visible", before + 1, candidates))
    name = F.format_string("teacher:%s:w%04d:%d-%d", "document_id", "window_index", "target_start", "target_end")
    return rows.select(name.alias("custom_id"), "document_id", "window_index", "target_start", "target_end", "visible_start", "visible_end", "visible", "targets")


def limit_windows(windows: DataFrame, n: int) -> DataFrame:
    """The first n windows by document and window."""
    return windows.orderBy("document_id", "window_index").limit(n)


def anchored_text(visible: Column) -> Column:
    return F.array_join(F.transform(visible, lambda s: F.concat(F.lit("<"), s["local_sid"], F.lit("> "), s["text"])), "\n")


def rule_annotations(targets: Column) -> Column:
    """An annotation item for every candidate, by rules: confidence 0.35 for a split, else 0.6."""

    def item(s: Column, label: Column) -> Column:
        split = label != "none"
        return F.struct(s["local_sid"].alias("local_sid"), s["source_sentence_id"].alias("source_sentence_id"), split.alias("split_after"), label.alias("boundary_type"), F.when(split, 0.35).otherwise(0.6).alias("confidence"))

    return F.transform(targets, lambda s: let(boundary_label(s["text"]), lambda label: item(s, label)))
