"""Student training sets from annotations: preflight, examples of two families in three splits, files, candidates and their evaluation."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from caesura.functions.text import let, sid_number, split_name
from caesura.operators import evaluation, ingest, training

# Families and splits, by which files are named.
FAMILIES = ("sparse_multi_boundary", "first_boundary")
SPLITS = ("train", "validation", "test")
# End of fixed values.

CHECKED = "struct<codes: array<string>, items: array<struct<local_sid: string, source_sentence_id: string, split_after: boolean, boundary_type: string, confidence: double>>>"


def _check(annotation: str, custom_id: str, sources: dict[str, str], targets: list[str]) -> tuple[list[str], list[dict]]:
    note = json.loads(annotation)
    codes = [i["code"] for i in ingest.issues(note, custom_id, sources, targets)]
    return codes, [] if codes else note["boundary_annotations"]


def _judged(rows: list[tuple[list[str], list[dict]] | None], kind: pa.StructType) -> pa.StructArray:
    """codes and items of rows, field by field."""
    some = [r or ([], []) for r in rows]
    offsets = lambda k: pa.array(np.append(0, np.cumsum([len(r[k]) for r in some])), pa.int32())
    item = kind.field("items").type.value_type
    given = [i for _, items in some for i in items]
    fields = [pa.array([float(i[f.name]) for i in given] if f.name == "confidence" else [i[f.name] for i in given], f.type) for f in item]
    codes = pa.ListArray.from_arrays(offsets(0), pa.array([c for r, _ in some for c in r], pa.string()))
    items = pa.ListArray.from_arrays(offsets(1), pa.StructArray.from_arrays(fields, fields=list(item)))
    return pa.StructArray.from_arrays([codes.cast(kind.field("codes").type), items.cast(kind.field("items").type)], fields=list(kind), mask=pa.array([r is None for r in rows]))


def checked(annotations: DataFrame, windows: DataFrame) -> DataFrame:
    """annotations: custom_id, annotation (JSON). windows: custom_id, document_id, source_path, target_local_sids, local_to_source (map of sid to
    source_sentence_id and text). A row an annotation: the window's columns, codes of its rule breaks, its items, and problem, what forbids to build from it."""
    kind = to_arrow_type(_parse_datatype_string(CHECKED))

    def check(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            for at in range(0, len(batch[0]), ingest.SLICE):
                known, notes, names, sources, sids = (x.slice(at, ingest.SLICE) for x in batch)
                named = ((k and dict(zip(k, v, strict=True))) or {} for k, v in zip(ingest.lists(sources, sources.keys), ingest.lists(sources, sources.items), strict=True))
                rows = zip(known.to_pylist(), notes.to_pylist(), names.to_pylist(), named, ingest.lists(sids, sids.values), strict=True)
                yield _judged([_check(note, name, source, wanted or []) if there else None for there, note, name, source, wanted in rows], kind)

    joined = annotations.join(windows.withColumn("known", F.lit(True)), "custom_id", "left")
    named = F.transform_values("local_to_source", lambda _, v: v["source_sentence_id"])
    judged = F.arrow_udf(check, CHECKED)(F.coalesce("known", F.lit(False)), "annotation", "custom_id", named, "target_local_sids")
    joined = joined.withColumn("judged", judged).select(*windows.columns, "known", "judged.codes", "judged.items")
    sids, sources = F.col("target_local_sids"), F.col("local_to_source")
    lost = F.filter(sids, lambda s: ~F.array_contains(F.map_keys(sources), s))
    mute = F.filter(sids, lambda s: sources[s]["text"].isNull())
    problem = (
        F.when(F.col("known").isNull(), "no window with this custom_id")
        .when(sids.isNull(), "the window has no target_local_sids")
        .when(sources.isNull(), "the window has no local_to_source")
        .when(F.size("codes") > 0, F.concat(F.lit("the annotation breaks rules: "), F.array_join("codes", ", ")))
        .when(F.size(lost) > 0, F.concat(F.lit("local_to_source lacks "), F.get(lost, F.lit(0))))
        .when(F.size(mute) > 0, F.concat(F.lit("no text for "), F.get(mute, F.lit(0))))
    )
    return joined.withColumn("problem", problem).drop("known")


def preflight(rows: DataFrame) -> None:
    """Raises for the first annotation, by custom_id, that examples can't be built from."""
    first = rows.where("problem IS NOT NULL").orderBy("custom_id").select("custom_id", "problem").head()
    if first is not None:
        raise ValueError(f"{first['custom_id']}: {first['problem']}")


def sentences(sids: Column, sources: Column) -> Column:
    """(local_sid, text) of the distinct sids, by number."""
    numbered = F.transform(F.array_distinct(sids), lambda s: F.struct(sid_number(s).alias("n"), s.alias("local_sid"), sources[s]["text"].alias("text")))
    return F.transform(F.sort_array(numbered), lambda s: F.struct(s["local_sid"].alias("local_sid"), s["text"].alias("text")))


def examples(rows: DataFrame) -> DataFrame:
    """Of checked() rows with targets, an example a family: target_type, split, example_id, document_id, input, output, custom_id."""
    shown = rows.where(F.size("target_local_sids") > 0).withColumn("input", training.student_input(sentences(F.col("target_local_sids"), F.col("local_to_source"))))
    outputs = let(
        training.boundary_lines(F.col("items")),
        lambda lines: F.array(
            F.struct(F.lit(FAMILIES[0]).alias("target_type"), F.concat(F.lit("sparse:"), "custom_id").alias("example_id"), training.all_lines(lines).alias("output")),
            F.struct(F.lit(FAMILIES[1]).alias("target_type"), F.concat(F.lit("first:"), "custom_id").alias("example_id"), training.first_line(lines).alias("output")),
        ),
    )
    both = shown.select("custom_id", "document_id", "input", split_name(F.col("document_id")).alias("split"), F.explode(outputs).alias("e"))
    return both.select("e.target_type", "split", "e.example_id", "document_id", "input", "e.output", "custom_id")


def mappings(rows: DataFrame) -> DataFrame:
    """Both example ids of every annotation that has examples, with where its sentences come from."""
    shown = rows.where(F.size("target_local_sids") > 0)
    return shown.select(F.concat(F.lit("sparse:"), "custom_id").alias("sparse_example_id"), F.concat(F.lit("first:"), "custom_id").alias("first_boundary_example_id"), "custom_id", "document_id", "source_path", "local_to_source")


def split_counts(made: DataFrame) -> DataFrame:
    """n by family and split, zeros included."""
    grid = made.sparkSession.createDataFrame([(f, s) for f in FAMILIES for s in SPLITS], "target_type string, split string")
    counts = made.groupBy("target_type", "split").agg(F.count("*").alias("n"))
    return F.broadcast(grid).join(counts, ["target_type", "split"], "left").select("target_type", "split", F.coalesce("n", F.lit(0)).alias("n"))


def build(annotations: DataFrame, windows: DataFrame, out: str) -> dict:
    """Writes <out>/<family>/<split> for all six, <out>/mappings and <out>/summary as JSON lines, in custom_id order; returns the summary.

    Nothing is written before the preflight of all annotations has passed. An empty split has a folder without rows.
    """
    rows = checked(annotations, windows).persist()
    try:
        preflight(rows)
        made = examples(rows)
        for family in FAMILIES:
            for split in SPLITS:
                part = made.where((F.col("target_type") == family) & (F.col("split") == split)).orderBy("custom_id")
                part.select("example_id", "document_id", "target_type", "input", "output").write.option("ignoreNullFields", "false").json(f"{out}/{family}/{split}")
        mappings(rows).orderBy("custom_id").write.option("ignoreNullFields", "false").json(f"{out}/mappings")
        counts: dict[str, dict[str, int]] = {f: {} for f in FAMILIES}
        for r in split_counts(made).collect():  # six rows
            counts[r["target_type"]][r["split"]] = r["n"]
        n, skipped = rows.agg(F.count_if(F.size("target_local_sids") > 0), F.count_if(F.size("target_local_sids") == 0)).head()
        summary = {"out_dir": out, "example_count": n, "skipped_empty_candidate_count": skipped, "split_counts": counts}
        annotations.sparkSession.createDataFrame([(json.dumps(summary, sort_keys=True),)], "value string").coalesce(1).write.text(f"{out}/summary")
        return summary
    finally:
        rows.unpersist()


def read_examples(spark: SparkSession, out: str, family: str, split: str) -> DataFrame:
    if family not in FAMILIES or split not in SPLITS:
        raise ValueError(f"no such family or split: {family}, {split}")
    return spark.read.schema("example_id string, document_id string, target_type string, input string, output string").json(f"{out}/{family}/{split}")


def candidates(made: DataFrame) -> DataFrame:
    """A row a sentence of an example: candidate_id, example_id, document_id, local_sid, number, text, label, features. An output that does not parse is an error."""
    shown = made.withColumn("all", training.extract_sentences(F.col("input")))
    parsed = training.parse_outputs(shown.select("example_id", "output", F.col("all.local_sid").alias("valid")))
    bad = F.max(F.when(F.size("issues") > 0, F.concat_ws(" ", "line_number", F.array_join("issues", ","))))
    labels = parsed.groupBy("example_id").agg(bad.alias("bad"), F.map_from_entries(F.collect_list(F.when(F.size("issues") == 0, F.struct("token", "label")))).alias("labels"))
    joined = shown.join(labels, "example_id", "left").withColumn("all", F.when(F.col("bad").isNotNull(), F.raise_error(F.concat_ws(": ", "example_id", "bad"))).when(F.size("all") == 0, F.raise_error(F.concat("example_id", F.lit(": no sentences")))).otherwise(F.col("all")))
    long = joined.select("example_id", "document_id", F.explode("all").alias("s"), "labels")
    label = F.coalesce(F.col("labels")[F.col("s.local_sid")], F.lit("none"))
    number = sid_number(F.col("s.local_sid"))
    return long.select(F.concat_ws("|", "example_id", "s.local_sid").alias("candidate_id"), "example_id", "document_id", "s.local_sid", number.alias("number"), "s.text", label.alias("label"), training.feature_map(F.col("s.text"), number).alias("features"))


def limit_candidates(rows: DataFrame, most: int | None, seed: int = 13) -> DataFrame:
    """At most so many candidates: those with a boundary first, then others, each in the order of a seeded hash."""
    if most is None:
        return rows
    if most <= 0:
        raise ValueError("the limit must be positive")
    return rows.orderBy(F.col("label") == "none", F.xxhash64(F.lit(seed), "candidate_id"), "candidate_id").limit(most)


def evaluate(scored: DataFrame) -> DataFrame:
    """scored: example_id, number, gold, predicted (labels), p_gold. One row: counts, mean log loss, accuracy, and precision, recall and F1 over the
    boundaries of all examples together, exact and within one sentence. Without candidates all are zero."""
    marked = lambda c: F.array_sort(F.collect_set(F.when(F.col(c) != "none", F.col("number"))))
    each = scored.groupBy("example_id").agg(F.count("*").alias("n"), F.sum(-F.log(F.greatest(F.col("p_gold"), F.lit(1e-12)))).alias("loss"), F.count_if(F.col("gold") == F.col("predicted")).alias("hit"), marked("gold").alias("g"), marked("predicted").alias("p"))
    each = each.withColumn("exact", evaluation.matched(F.col("g"), F.col("p"))).withColumn("near", evaluation.matched(F.col("g"), F.col("p"), 1))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    total = each.agg(F.count("*").alias("example_count"), zero("n").alias("candidate_count"), zero("loss").alias("loss"), zero("hit").alias("hit"), zero(F.size("g")).alias("n_gold"), zero(F.size("p")).alias("n_pred"), zero("exact").alias("exact"), zero("near").alias("near"))
    some, per = F.col("candidate_count") > 0, lambda c: F.when(F.col("candidate_count") > 0, F.col(c) / F.col("candidate_count")).otherwise(0.0)
    share = lambda tp, n, other: F.when(~some, 0.0).when((F.col(n) == 0) & (F.col(other) == tp), 1.0).when(F.col(n) == 0, 0.0).otherwise(tp / F.col(n))
    f1 = lambda p, r: F.when(p + r == 0, 0.0).otherwise(2 * p * r / (p + r))
    sides = {k: (share(F.col(k), "n_pred", "n_gold"), share(F.col(k), "n_gold", "n_pred")) for k in ("exact", "near")}
    return total.select("candidate_count", "example_count", per("loss").alias("loss"), per("hit").alias("accuracy"), sides["exact"][0].alias("precision"), sides["exact"][1].alias("recall"), f1(*sides["exact"]).alias("f1"), f1(*sides["near"]).alias("tolerance1_f1"))


def flat_metrics(spark: SparkSession, summary: dict, prefix: str = "dataset") -> DataFrame:
    """metric, value of all numbers in a summary (booleans are none), named by their path."""
    out: list[tuple[str, float]] = []

    def walk(name: str, value) -> None:
        if isinstance(value, dict):
            for k, v in value.items():
                walk(f"{name}/{k}", v)
        elif isinstance(value, int | float) and not isinstance(value, bool):
            out.append((name, float(value)))

    walk(prefix, summary)
    return spark.createDataFrame(out, "metric string, value double")


def first_rows(rows: DataFrame, n: int | None) -> DataFrame:
    """The first n rows by line_number."""
    return rows if n is None else rows.orderBy("line_number").limit(n)


def with_scores(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """candidates() with predicted label, p_gold: what evaluate() takes."""
    scored = training.score(rows.select("candidate_id", "features"), weights)
    own = Window.partitionBy("candidate_id")
    best = scored.withColumn("predicted", F.max(F.when(F.col("rank") == 1, F.col("label"))).over(own))
    gold = rows.select("candidate_id", "example_id", "number", F.col("label").alias("gold"))
    return gold.join(best, "candidate_id").where(F.col("label") == F.col("gold")).select("example_id", "number", "gold", "predicted", F.col("probability").alias("p_gold"))
