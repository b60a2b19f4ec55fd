"""Registered queries over the driver's tables, each with SQL that computes the same in another way.

Lines of `documents` are blocks; some sentences are replaced by cue literals, by index, so that every rule has work to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caesura.functions import text as T
from caesura.operators import browse as browsing
from caesura.operators import evaluation, ingest, payload, student, training, validation, windows
from caesura.sources import markup

# Literals laid over sentences, by index mod 17.
OVERLAY = {0: "기도하겠습니다.", 3: "제10장 세마포", 5: "(요 3:16)", 7: "Chapter 9", 9: "(계 19:7, 8)", 11: "아멘.", 13: "이것은 다음과 같이 표현합니다 하였다.", 15: "본문 설명입니다."}
WEIGHTS = [("topic_shift", "cue:starts_chapter", 2.5), ("topic_shift", "cue:starts_je", 2.0), ("prayer_or_closing", "cue:contains:기도", 1.5), ("prayer_or_closing", "cue:contains:아멘", 3.0), ("scripture_reading_start", "char:(", 0.75), ("none", "bias", 1.0), ("illustration_start", "len_bucket:10", 0.25), ("application_start", "bigram:en", 0.5)]
# End of fixed values.


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _overlay(text: Column, i: Column) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(OVERLAY.get(k)).cast("string") for k in range(17)]), (i % 17).cast("int")), text)


def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    name = T.document_id("hwp", F.concat(F.lit("documents/"), F.col("doc_id").cast("string")))
    return docs.select("doc_id", "source", name.alias("document_id"), F.transform(windows.sentence_array(F.col("text")), _overlay).alias("sentences"))


def _windows(spark: SparkSession, sf_dir: str, *sizes: int) -> DataFrame:
    return windows.build_windows(_sentences(spark, sf_dir), *(sizes or (20, 3, 3)))


def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.once(_windows(spark, sf_dir), items=windows.rule_annotations(F.col("targets")))


def _gold_and_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold by rules; predictions are gold with some dropped, some moved on by one and some made up."""
    number = lambda i: i["local_sid"].substr(F.lit(2), F.lit(9)).cast("int")
    gold = F.transform(F.filter("items", lambda i: i["split_after"]), number)
    moved = F.transform(F.filter(gold, lambda g: (g * 7 + F.col("window_index")) % 5 != 0), lambda g: F.when((g * 7 + F.col("window_index")) % 5 == 1, g + 1).otherwise(g))
    made = F.filter(F.transform("targets", number), lambda g: (g * 11 + F.col("window_index")) % 13 == 0)
    rows = _annotated(spark, sf_dir).withColumn("gold", gold)
    return rows.select("custom_id", F.size("visible").alias("n"), "gold", F.array_sort(F.array_distinct(F.concat(moved, made))).alias("predicted"))


def normalize_text(spark, sf_dir):
    t = T.normalize_ws(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.length(t).cast("long").alias("n"), F.md5(t).alias("digest"))


def block_filters(spark, sf_dir):
    lines = _docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line")).withColumn("line", F.when(F.col("i") % 9 == 4, "12").when(F.col("i") % 9 == 7, " • ").otherwise(_overlay(F.col("line"), F.col("i"))))
    counts = {f"n_{s}": F.sum(f"n_{s}").cast("long").alias(f"n_{s}") for s in T.SCRIPTS}
    rows = lines.withColumns({f"n_{s}": T.script_count(F.col("line"), s) for s in T.SCRIPTS} | {"noise": T.is_layout_noise(F.col("line")).cast("long")})
    rows = rows.withColumn("reason", T.language_reason(F.col("line"), {s: F.col(f"n_{s}") for s in T.SCRIPTS}))
    return rows.groupBy("reason", T.keeps(F.col("reason")).alias("kept")).agg(F.count("*").alias("n_lines"), F.sum("noise").alias("n_noise"), *counts.values())


def document_kinds(spark, sf_dir):
    name = F.concat(F.element_at(F.array(*map(F.lit, ["주일 설교", "새벽 기도", "논문 요약", "공지 사항", "기도 논문"])), (F.col("doc_id") % 5 + 1).cast("int")), F.lit(".docx"))
    path = F.concat(F.lit("datas/docx/"), F.col("doc_id").cast("string"))
    return _docs(spark, sf_dir).select("doc_id", T.document_id("docx", path).alias("document_id"), T.document_kind(name).alias("kind"), T.split_name(T.document_id("docx", path)).alias("split"))


def sentence_rows(spark, sf_dir):
    return windows.explode_sentences(_sentences(spark, sf_dir)).withColumn("sentence_index", F.col("sentence_index").cast("long"))


def sentence_cap(spark, sf_dir):
    return windows.explode_sentences(_sentences(spark, sf_dir), 5).groupBy("document_id").agg(F.count("*").alias("n"), F.max("sentence_id").alias("last_id"))


def dataset_summary(spark, sf_dir):
    n = F.size("sentences")
    docs = _sentences(spark, sf_dir).select("source", n.alias("n"))
    return docs.rollup("source").agg(F.count("*").alias("total"), F.sum((F.col("n") > 0).cast("long")).alias("succeeded"), F.sum((F.col("n") == 0).cast("long")).alias("failed"), F.sum(F.col("n").cast("long")).alias("n_sentences"))


def window_sizes(spark, sf_dir):
    rows = _windows(spark, sf_dir, 160, 20, 20)
    return rows.groupBy("document_id").agg(F.count("*").alias("n_windows"), F.sum(F.size("visible").cast("long")).alias("n_visible"), F.sum(F.size("targets").cast("long")).alias("n_targets"))


def window_rows(spark, sf_dir):
    spans = [F.col(c).cast("long").alias(c) for c in ("window_index", "target_start", "target_end", "visible_start", "visible_end")]
    return _windows(spark, sf_dir).select("custom_id", "document_id", *spans, F.array_join("targets.local_sid", ",").alias("target_sids"), F.md5(windows.anchored_text(F.col("visible"))).alias("anchored_md5"))


def window_sentences(spark, sf_dir):
    return _windows(spark, sf_dir).select("custom_id", F.explode("visible").alias("s")).select("custom_id", "s.local_sid", "s.source_sentence_id", F.col("s.global_sentence_index").cast("long").alias("position"), "s.role", "s.candidate")


def window_limit(spark, sf_dir):
    return windows.limit_windows(_windows(spark, sf_dir), 25).select("custom_id")


def rule_labels(spark, sf_dir):
    items = _annotated(spark, sf_dir).select("document_id", F.explode("items").alias("i"))
    return items.groupBy("i.boundary_type").agg(F.count("*").alias("n"), F.sum(F.col("i.split_after").cast("long")).alias("n_split"), F.round(F.avg("i.confidence"), 6).alias("mean_confidence"))


def student_examples(spark, sf_dir):
    rows = _annotated(spark, sf_dir)
    return rows.select(F.concat(F.lit("sparse:"), "custom_id").alias("example_id"), F.md5(training.student_input(F.col("targets"))).alias("input_md5"), training.sparse_output(F.col("items")).alias("sparse"), training.first_output(F.col("items")).alias("first"), T.split_name(F.col("document_id")).alias("split"))


def training_summary(spark, sf_dir):
    rows = _annotated(spark, sf_dir).select(T.split_name(F.col("document_id")).alias("split"), training.student_input(F.col("targets")).alias("input"), training.sparse_output(F.col("items")).alias("output"))
    grid = spark.createDataFrame([("train",), ("validation",), ("test",)], "split string")
    sums = rows.groupBy("split").agg(F.count("*").alias("n"), F.sum((F.col("output") == "NO_BOUNDARY").cast("long")).alias("n_none"), F.sum(training.boundary_line_count(F.col("output")).cast("long")).alias("n_lines"), F.avg(F.length("input")).alias("mean_input"), F.avg(F.length("output")).alias("mean_output"))
    zero = lambda c, k: F.coalesce(c, F.lit(k)).alias(c)
    return F.broadcast(grid).join(sums, "split", "left").select("split", zero("n", 0), zero("n_none", 0), zero("n_lines", 0), F.round(F.coalesce("mean_input", F.lit(0.0)), 6).alias("mean_input"), F.round(F.coalesce("mean_output", F.lit(0.0)), 6).alias("mean_output"))


def extracted_sentences(spark, sf_dir):
    rows = _windows(spark, sf_dir).select("custom_id", F.explode(training.extract_sentences(training.student_input(F.col("targets")))).alias("s"))
    return rows.select("custom_id", "s.local_sid", "s.text")


def parse_issues(spark, sf_dir):
    rows = _annotated(spark, sf_dir).withColumn("k", F.col("window_index") % 6)
    out = training.sparse_output(F.col("items"))
    broken = (
        F.when(F.col("k") == 1, F.concat(out, F.lit("\nS2 none\nbad\nSX topic_shift\nS999 topic_shift")))
        .when(F.col("k") == 2, F.concat(F.lit("S3 topic_shift\n\nS2 topic_shift\n  \nS2 topic_shift\n"), out))
        .when(F.col("k") == 3, F.lit("  "))
        .otherwise(out)
    )
    parsed = training.parse_outputs(rows.select(F.col("custom_id").alias("example_id"), broken.alias("output"), F.col("targets.local_sid").alias("valid")))
    return parsed.groupBy("example_id").agg(*[F.sum(F.array_contains("issues", c).cast("long")).alias(c) for c in ("invalid_line", "unknown_local_sid", "invalid_label", "duplicate_local_sid", "not_ascending")], F.sum(F.col("is_boundary").cast("long")).alias("n_boundaries"))


def boundary_scores(spark, sf_dir):
    g, p = F.col("gold"), F.col("predicted")
    rows = _gold_and_predicted(spark, sf_dir).withColumn("exact", evaluation.boundary_f1(g, p)).withColumn("near", evaluation.boundary_f1(g, p, 1))
    return rows.select("custom_id", F.col("exact.tp").cast("long").alias("tp"), F.col("exact.fp").cast("long").alias("fp"), F.col("exact.fn").cast("long").alias("fn"), F.round("exact.f1", 6).alias("f1"), F.col("near.tp").cast("long").alias("near_tp"), F.round("near.f1", 6).alias("near_f1"))


def segmentation_scores(spark, sf_dir):
    g, p, n = F.col("gold"), F.col("predicted"), F.col("n")
    return _gold_and_predicted(spark, sf_dir).select("custom_id", F.round(evaluation.pk(n, g, p), 6).alias("pk"), F.round(evaluation.window_diff(n, g, p), 6).alias("window_diff"))


def training_rows(spark, sf_dir):
    """The sentences are one array, so the next one's id needs no shuffle."""
    n = F.size("sentences")
    rows = _sentences(spark, sf_dir).select("document_id", n.alias("n"), F.posexplode("sentences").alias("i", "text"))
    rows = rows.withColumn("label", T.boundary_label(F.col("text")))
    name = lambda i: F.format_string("%s.s%04d", "document_id", i)
    review = F.when(F.col("i") % 4 == 0, 0.72).otherwise(0.93) < 0.75
    return rows.select(name(F.col("i")).alias("left_sentence_id"), F.when(F.col("i") + 1 < F.col("n"), name(F.col("i") + 1)).alias("right_sentence_id"), (F.col("label") != "none").alias("split_after_left"), F.col("label").alias("boundary_type"), F.when(review, "needs_review").otherwise("teacher_only").alias("review_status"))


def label_scores(spark, sf_dir):
    rows = _windows(spark, sf_dir).select("custom_id", F.explode("targets").alias("s"))
    number = F.substring("s.local_sid", 2, 9).cast("int")
    found = rows.select(F.concat_ws("|", "custom_id", "s.local_sid").alias("candidate_id"), T.boundary_label(F.col("s.text")).alias("gold"), training.feature_map(F.col("s.text"), number).alias("features"))
    scored = training.score(found.select("candidate_id", "features"), F.broadcast(spark.createDataFrame(WEIGHTS, "label string, feature string, weight double")))
    best = scored.where("rank = 1").select("candidate_id", F.col("label").alias("predicted"), F.round("probability", 6).alias("probability"))
    return best.groupBy("predicted").agg(F.count("*").alias("n"), F.round(F.sum("probability"), 4).alias("mass"))


def feature_sums(spark, sf_dir):
    rows = _windows(spark, sf_dir).select(F.explode("targets").alias("s"))
    found = rows.select(F.explode(training.feature_map(F.col("s.text"), F.substring("s.local_sid", 2, 9).cast("int"))).alias("feature", "value"))
    return found.groupBy("feature").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def _examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _annotated(spark, sf_dir)
    return rows.select(F.concat(F.lit("sparse:"), "custom_id").alias("example_id"), "document_id", training.student_input(F.col("targets")).alias("input"), training.sparse_output(F.col("items")).alias("output"))


def browse(spark, sf_dir):
    rows = browsing.filter_examples(_examples(spark, sf_dir), " Chapter 9", "boundary_only", "topic_shift")
    return rows.select(F.expr("substring(example_id, 8)").alias("custom_id"), training.boundary_line_count(F.col("output")).cast("long").alias("n_lines"))


def browse_sort(spark, sf_dir):
    """The first examples by number of boundaries: the order is the feature."""
    rows = browsing.sort_examples(_examples(spark, sf_dir), "boundary_count").limit(40)
    return rows.select("example_id", F.size(browsing.boundary_labels(F.col("output"))).cast("long").alias("n"))


def label_histogram(spark, sf_dir):
    return browsing.label_histogram(_examples(spark, sf_dir))


def _mapped(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Annotations as JSON, and windows, as the build of training sets takes them."""
    rows = _annotated(spark, sf_dir)
    named = lambda **c: F.named_struct(*[x for k, v in c.items() for x in (F.lit(k), v)])
    items = F.transform("items", lambda i: named(local_sid=i["local_sid"], source_sentence_id=i["source_sentence_id"], split_after=i["split_after"], boundary_type=i["boundary_type"], confidence=i["confidence"], rationale=F.lit("rule")))
    note = F.to_json(named(custom_id=F.col("custom_id"), boundary_annotations=items, quality_flags=F.array().cast("array<string>")))
    sources = F.map_from_entries(F.transform("visible", lambda s: F.struct(s["local_sid"], F.struct(s["source_sentence_id"].alias("source_sentence_id"), s["text"].alias("text")))))
    return rows.select("custom_id", note.alias("annotation")), rows.select("custom_id", "document_id", F.lit("documents").alias("source_path"), F.col("targets.local_sid").alias("target_local_sids"), sources.alias("local_to_source"))


def sft_split_counts(spark, sf_dir):
    return student.split_counts(student.examples(student.checked(*_mapped(spark, sf_dir))))


def sft_examples(spark, sf_dir):
    made = student.examples(student.checked(*_mapped(spark, sf_dir)))
    return made.select("example_id", "target_type", "split", F.md5("input").alias("input_md5"), "output")


def example_mapping(spark, sf_dir):
    rows = student.checked(*_mapped(spark, sf_dir))
    joined = browsing.with_mappings(student.examples(rows), student.mappings(rows))
    return joined.select("example_id", F.col("mapping.custom_id").alias("custom_id"), F.size("mapping.local_to_source").cast("long").alias("n_sources"))


def training_scores(spark, sf_dir):
    """The evaluation of predictions made from gold, with made probabilities."""
    rows = _gold_and_predicted(spark, sf_dir).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
    label = lambda c: F.when(F.array_contains(c, F.col("i")), "topic_shift").otherwise("none")
    scored = rows.select(F.col("custom_id").alias("example_id"), F.col("i").alias("number"), label("gold").alias("gold"), label("predicted").alias("predicted"), (1 / (1 + F.col("i") % 7)).alias("p_gold"))
    out = student.evaluate(scored)
    return out.select(*[F.round(c, 6).alias(c) if k == "double" else F.col(c) for c, k in out.dtypes])


def doc_validation(spark, sf_dir):
    """Rule breaks of document annotations from which some items were taken, moved or changed by number."""
    rows = _sentences(spark, sf_dir)
    ids = F.transform("sentences", lambda s, i: F.format_string("%s.s%04d", F.col("document_id"), i))
    items = F.transform("sentences", lambda s, i: F.struct(F.when(i % 23 == 5, "nowhere").otherwise(F.format_string("%s.s%04d", F.col("document_id"), i)).alias("sentence_id"), (i % 3 == 0).alias("split_after"), F.when(i % 19 == 1, "odd").when(i % 4 == 0, "topic_shift").otherwise("none").alias("boundary_type"), i.alias("i")))
    items = F.filter(items, lambda x: x["i"] % 29 != 7)
    found = rows.select("document_id", F.explode(validation.document_issues(ids, items)).alias("issue"))
    return found.groupBy("issue.code").agg(F.count("*").alias("n"), F.countDistinct("document_id").alias("n_documents"))


def annotation_summary(spark, sf_dir):
    return validation.summarize(_annotated(spark, sf_dir).select(F.explode("items").alias("i")).select("i.*"))


def label_requests(spark, sf_dir):
    rows = payload.requests(_windows(spark, sf_dir))
    task = F.get_json_object("body", "$.input[1].content")
    field = lambda path: F.get_json_object(task, path)
    return rows.select(
        "custom_id", "method", "url", field("$.document_id").alias("document_id"), F.md5(F.array_join(F.from_json(field("$.anchored_text"), "array<string>"), "\n")).alias("anchored_md5"), F.array_join(F.from_json(field("$.target_local_sids"), "array<string>"), ",").alias("target_sids"),
        F.get_json_object("body", "$.text.format.schema.required[2]").alias("third_key"), F.get_json_object("body", "$.max_output_tokens").cast("long").alias("max_output_tokens"),
    )


def gold_vs_predicted(spark, sf_dir):
    rows = _gold_and_predicted(spark, sf_dir)
    both = rows.select(F.explode(F.array_union("gold", "predicted")).alias("s"), "gold", "predicted")
    status = F.when(~F.array_contains("gold", F.col("s")), "FP").when(~F.array_contains("predicted", F.col("s")), "FN").otherwise("match")
    return both.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def routed_results(spark, sf_dir):
    """Labelling results made from rule annotations, some with faults by window index, routed."""
    rows = _annotated(spark, sf_dir).withColumn("k", F.col("window_index") % 8)
    named = lambda **c: F.named_struct(*[x for k, v in c.items() for x in (F.lit(k), v)])
    confidence = lambda i, n: F.when((F.col("k") == 4) & (n == 0), 2.0).when(F.col("k") == 5, 0.9).otherwise(i["confidence"])
    items = F.transform("items", lambda i, n: named(local_sid=i["local_sid"], source_sentence_id=i["source_sentence_id"], split_after=i["split_after"], boundary_type=F.when((F.col("k") == 3) & (n == 0), "bad").otherwise(i["boundary_type"]), confidence=confidence(i, n), rationale=F.lit("rule")))
    items = F.when(F.col("k") == 6, F.slice(items, 2, 1_000)).otherwise(items)
    note = F.to_json(named(custom_id=F.col("custom_id"), boundary_annotations=items, quality_flags=F.array().cast("array<string>")))
    content = named(type=F.lit("output_text"), text=F.when(F.col("k") == 2, "").otherwise(note))
    body = named(output=F.array(named(content=F.array(content))))
    line = F.to_json(named(custom_id=F.col("custom_id"), response=named(status_code=F.when(F.col("k") == 1, 500).otherwise(200), body=body)))
    lines = rows.where("k <> 7").select(F.explode(F.when(F.col("k") == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"), F.xxhash64("custom_id").alias("at"), line.alias("line"))
    results = lines.select((F.col("at") % 1_000_000_007 * 2 + F.col("copy")).alias("line_number"), "line")
    routed = ingest.route(results, rows.select("custom_id", "visible", "targets"))
    return routed.groupBy("route", "needs_review", F.coalesce("exception_type", F.lit("")).alias("exception_type"), F.array_join("codes", ",").alias("codes")).agg(F.count("*").alias("n"))


def html_blocks(spark, sf_dir):
    return markup.html_blocks(spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").alias("source_id"), "html"), "source_id")


def html_headings(spark, sf_dir):
    """Headings of pages: h1 never nests in the driver's pages, so a pattern finds the same."""
    blocks = markup.html_blocks(spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").alias("source_id"), "html"), "source_id").where("source_tag = 'h1'")
    return blocks.groupBy("source_id").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (normalize_text, block_filters, document_kinds, sentence_rows, sentence_cap, dataset_summary, window_sizes, window_rows, window_sentences, window_limit, rule_labels, student_examples, training_summary, extracted_sentences, parse_issues, boundary_scores, segmentation_scores, training_rows, label_scores, feature_sums, browse, browse_sort, label_histogram, sft_split_counts, sft_examples, example_mapping, training_scores, doc_validation, annotation_summary, label_requests, gold_vs_predicted, routed_results, html_blocks, html_headings)}
