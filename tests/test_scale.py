"""Steps do their work once: what plans and batches hold, which small tables' times don't show."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from caesura.functions import text as T
from caesura.operators import browse, ingest, student, training, windows
from caesura.plans.queries import QUERIES
from caesura.sources import markup

TABLES = "/root/testdata/sf0.001"


def plan(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


def nodes(rows, name):
    return len(re.findall(rf"^[\s:+-]*{name}\b", plan(rows), re.M))


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no driver tables")
@pytest.mark.parametrize("name", ["annotation_summary", "rule_labels", "training_scores", "label_histogram", "boundary_scores", "segmentation_scores", "label_requests", "student_examples", "browse_sort", "training_summary", "browse", "label_scores", "feature_sums", "parse_issues"])
def test_texts_are_split_once(spark, name):
    assert plan(QUERIES[name](spark, TABLES)).count("_split_texts(") == 1


def test_lines_are_split_as_blocks_are(spark):
    rnd = random.Random(7)
    signs = ["a", "b", "다", "음", ".", "!", "？", "。", " ", "  ", "\n", "\r", "\t", "\x1f", "\x85", " ", " ", " ", " ", "　", "é"]
    texts = ["".join(rnd.choices(signs, k=rnd.randint(0, 30))) for _ in range(400)] + ["가나다 " * 200, "가나다 " * 200 + "끝. 또\n" + "가다 " * 300, "", None]
    blocks = F.filter(F.transform(F.split("x", "\n", -1), T.normalize_ws), lambda b: b != "")
    rows = spark.createDataFrame([(t,) for t in texts], "x string").select("x", windows.sentence_array(F.col("x")).alias("got"), F.flatten(F.transform(blocks, T.split_sentences)).alias("want"))
    assert [r for r in rows.collect() if r["got"] != r["want"]] == []
    odd = spark.createDataFrame([(chr(i),) for i in range(0xFFFF) if not 0xD800 <= i <= 0xDFFF], "x string")
    assert odd.where(F.col("x").rlike(T.WS) != F.lit(T.SPACES).contains(F.col("x"))).count() == 0


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no driver tables")
def test_scripts_of_a_line_are_counted_once(spark):
    found = plan(QUERIES["block_filters"](spark, TABLES))
    assert [found.count(f"[^{chars}]") for chars in T.SCRIPTS.values()] == [1] * len(T.SCRIPTS)


def test_features_are_counted_together(spark):
    rnd = random.Random(11)
    texts = ["", None, "제", "chapter 기도 아멘", "aaa aaa", "😀😀 é"] + ["".join(rnd.choices("ab 가나😀", k=rnd.randint(0, 130))) for _ in range(60)]
    rows = spark.createDataFrame([(i, t, i % 25) for i, t in enumerate(texts)], "i int, t string, n int").coalesce(1)
    made = rows.select("i", training.feature_map(F.col("t"), F.col("n")).alias("f"))
    assert "array_distinct" not in plan(made)  # a pass over all items for each distinct one
    for i, got in made.collect():
        if texts[i] is None:
            assert got is None
            continue
        t = " ".join(texts[i].split())
        head = t[:96]
        want = {"bias": 1.0, f"sid_bucket:{min(i % 25, 20)}": 1.0, f"len_bucket:{min(len(t) // 20, 10)}": 1.0}
        want |= {"sid:first": 1.0} if i % 25 == 1 else {}
        want |= {"cue:starts_je": 1.0} if t.startswith("제") else {}
        want |= {"cue:starts_chapter": 1.0} if t.startswith("chapter ") else {}
        want |= {f"cue:contains:{c}": 1.0 for c in training.CUES if c in t}
        for c in head.replace(" ", ""):
            want[f"char:{c}"] = min(want.get(f"char:{c}", 0.0) + 1, 4.0)
        for k in range(min(len(head) - 1, 48)):
            want[f"bigram:{head[k : k + 2]}"] = min(want.get(f"bigram:{head[k : k + 2]}", 0.0) + 1, 3.0)
        assert got == want


def test_scores_need_one_pass_and_no_windows(spark):
    table = spark.createDataFrame([("c", {"bias": 1.0, "x": 2.0}), ("d", {"y": 1.0}), ("e", {})], "candidate_id string, features map<string,double>")
    weights = spark.createDataFrame([("topic_shift", "bias", 3.0), ("topic_shift", "x", -1.0), ("none", "x", 1.0), ("odd", "x", 9.0)], "label string, feature string, weight double")
    scored = training.score(table, weights)
    assert nodes(scored, "Window") == 0 and nodes(scored, "Join") == 1
    got = {(r["candidate_id"], r["rank"]): (r["label"], r["score"]) for r in scored.collect()}
    assert len(got) == 24 and got["c", 1] == ("none", 2.0) and got["c", 2] == ("topic_shift", 1.0) and got["d", 1] == got["e", 1] == ("none", 0.0) and got["d", 2] == ("topic_shift", 0.0)


def test_outputs_are_parsed_without_a_shuffle(spark):
    rows = spark.createDataFrame([("e", "S2 topic_shift\nbad\nS1 topic_shift\nS2 none", ["S1", "S2"])], "example_id string, output string, valid array<string>")
    found = training.parse_outputs(rows)
    assert nodes(found, "Window") == 0
    assert [(r["line_number"], r["issues"]) for r in found.collect()] == [(1, []), (2, ["invalid_line"]), (3, ["not_ascending"]), (4, ["invalid_label", "duplicate_local_sid"])]


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no driver tables")
def test_labels_of_outputs_are_found_once(spark):
    outputs = spark.read.parquet(f"{TABLES}/documents.parquet").select(F.col("doc_id").cast("string").alias("example_id"), F.lit("d").alias("document_id"), F.col("text").alias("input"), F.concat(F.lit("S1 "), F.col("text")).alias("output"))
    assert plan(browse.filter_examples(outputs, "x", "boundary_only", "topic_shift")).count("^S([0-9]+)$") == 1
    lines = spark.createDataFrame([("S1 topic_shift\n S2\t none \nS3  topic_shift\nS4 topic_shift x",)], "o string")
    assert lines.select(browse.boundary_labels(F.col("o"))).head()[0] == ["topic_shift", "topic_shift"]


def test_pages_are_parsed_in_slices(spark):
    import pyarrow as pa

    pages = pa.array([f"<p>page {i}</p>" for i in range(2 * markup.SLICE + 5)] + [None])
    found = list(markup._parsed(iter([pages])))
    assert [len(x) for x in found] == [markup.SLICE, markup.SLICE, 6]
    assert [x[0]["text"] if x else None for part in found for x in part.to_pylist()] == [f"page {i}" for i in range(2 * markup.SLICE + 5)] + [None]
    assert markup.html_blocks(spark.createDataFrame([(1, "<p>text</p>")], "id int, html string"), "id").head()["text"] == "text"


def test_results_meet_windows_once(spark):
    shown = windows.build_windows(spark.createDataFrame([("a", ["x", "y"]), ("b", ["x", "y"])], "document_id string, sentences array<string>"), 2, 0, 0)
    routed = ingest.route(spark.createDataFrame([(1, None), (2, '{"custom_id": "q"}')], "line_number long, line string"), shown)
    assert nodes(routed, "Join") == 1
    got = sorted((str(r["line_number"]), r["route"], r["exception_type"]) for r in routed.collect())
    assert got == [("1", "failure", "TypeError"), ("2", "failure", "KeyError"), ("None", "failure", "MissingBatchResult"), ("None", "failure", "MissingBatchResult")]


def test_annotations_meet_windows_once(spark):
    shown = spark.createDataFrame([("a", "d", "p", ["S1"], {"S1": ("d.s0", "x")})], "custom_id string, document_id string, source_path string, target_local_sids array<string>, local_to_source map<string, struct<source_sentence_id: string, text: string>>")
    item = '{"local_sid": "S1", "source_sentence_id": "d.s0", "split_after": true, "boundary_type": "topic_shift", "confidence": 1, "rationale": ""}'
    note = f'{{"custom_id": "a", "boundary_annotations": [{item}], "quality_flags": []}}'
    rows = student.checked(spark.createDataFrame([("a", note), ("q", "not json, and no window")], "custom_id string, annotation string"), shown)
    assert nodes(rows, "Join") == 1
    got = {r["custom_id"]: (r["codes"], r["items"] and [tuple(i) for i in r["items"]], r["problem"]) for r in rows.collect()}
    assert got == {"a": ([], [("S1", "d.s0", True, "topic_shift", 1.0)], None), "q": (None, None, "no window with this custom_id")}


def test_flawless_items_are_those_without_issues():
    rnd = random.Random(3)
    sources, targets = {"S1": "a", "S2": "b"}, ["S1", "S2"]
    values = {"local_sid": ["S1", "S2", "S9", 1], "source_sentence_id": ["a", "b", None], "split_after": [True, False, 1], "boundary_type": ["none", "topic_shift", "odd", None], "confidence": [0, 1.0, 0.5, 2, -1, True, float("nan"), "x"], "rationale": ["", None]}
    for _ in range(3000):
        item = {k: rnd.choice(v) for k, v in values.items() if rnd.random() < 0.97} | ({"more": 1} if rnd.random() < 0.03 else {})
        seen = ["S1"] if rnd.random() < 0.2 else []
        first = [{"local_sid": "S1", "source_sentence_id": "a", "split_after": False, "boundary_type": "none", "confidence": 1, "rationale": ""}] * len(seen)
        found = ingest.issues({"custom_id": "w", "boundary_annotations": [*first, item], "quality_flags": []}, "w", sources, targets)
        clean = not [i for i in found if i["code"] != "missing_target_annotation"]
        assert ingest._flawless(item, set(seen), sources, set(targets), set(T.BOUNDARY_TYPES)) == clean
