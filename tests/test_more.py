"""Browsing, document validation, payloads and streamed results."""

import json

import pytest
from pyspark.sql import functions as F

from caesura.operators import browse, payload, validation, windows
from caesura.streaming.results import first_results


def examples(spark):
    return spark.createDataFrame([("e1", "d1", "<S1> 둘째 Text", "S1 topic_shift\nS2 topic_shift"), ("e2", "d0", "longer input here", "NO_BOUNDARY"), ("e3", "d2", "x", "S1 prayer_or_closing")], "example_id string, document_id string, input string, output string")


def test_browse(spark):
    ids = lambda rows: [r["example_id"] for r in rows.collect()]
    table = examples(spark)
    assert ids(browse.filter_examples(table, "둘째 text", "boundary_only", "topic_shift")) == ["e1"]
    assert ids(browse.filter_examples(table, boundaries="no_boundary")) == ["e2"]
    assert [ids(browse.sort_examples(table, o)) for o in ("document_id", "boundary_count", "text_length")] == [["e2", "e1", "e3"], ["e1", "e3", "e2"], ["e2", "e1", "e3"]]
    n = {r["label"]: r["n"] for r in browse.label_histogram(table).collect()}
    assert n["topic_shift"] == 2 and n["NO_BOUNDARY"] == 1 and n["enumeration_start"] == 0
    said = spark.createDataFrame([("none", "none"), ("none", "a"), ("a", "none"), ("a", "b"), ("a", None)], "g string, p string").select(browse.status(F.col("g"), F.col("p")).alias("s"))
    assert [r["s"] for r in said.collect()] == ["match", "FP", "FN", "label_mismatch", "-"]


def test_document_validation(spark):
    row = spark.createDataFrame([(["s0", "s1", "s10"], [("s0", False, "topic_shift", 0.9), ("sx", True, "none", 0.5)])], f"ids array<string>, items {validation.ITEM}")
    got = row.select(validation.document_issues(F.col("ids"), F.col("items")).alias("i")).head()["i"]
    assert [tuple(i) for i in got] == [("coverage_mismatch", None), ("missing_sentence_annotation", "s1"), ("missing_sentence_annotation", "s10"), ("unknown_sentence_id", "sx"), ("split_false_boundary_type_not_none", "s0"), ("split_true_boundary_type_none", "sx")]


def test_training_rows(spark):
    sentences = spark.createDataFrame([("d", i, f"d.s{i}", f"b{i // 2}", i // 2) for i in range(3)], "document_id string, sentence_index int, sentence_id string, block_id string, paragraph_index int")
    items = spark.createDataFrame([("d", 0, "d.s0", False, "none", 0.1, False), ("d", 1, "d.s0", True, "topic_shift", 0.93, False), ("d", 2, "d.s1", False, "none", 0.98, False), ("d", 3, "d.s2", False, "none", 0.72, False)], "document_id string, position int, sentence_id string, split_after boolean, boundary_type string, confidence double, has_flags boolean")
    got = validation.training_rows(sentences, items).orderBy("left_sentence_id").collect()
    assert [(r["right_sentence_id"], r["boundary_type"], r["same_original_paragraph"], r["review_status"]) for r in got] == [("d.s1", "topic_shift", True, "teacher_only"), ("d.s2", "none", False, "teacher_only"), (None, "none", False, "needs_review")]
    assert {r["boundary_type"]: r["n"] for r in validation.summarize(items).collect()} == {"none": 3, "topic_shift": 1}


def test_payload_and_jsonl(spark, tmp_path):
    table = windows.build_windows(spark.createDataFrame([("d", ["가.", "나.", "다."])], "document_id string, sentences array<string>"), 2, 1, 1)
    row = payload.requests(table).orderBy("custom_id").head()
    body = json.loads(row["body"])
    asked = json.loads(body["input"][1]["content"])
    assert row["method"] == "POST" and asked["anchored_text"][0] == "<S1> 가." and asked["target_local_sids"] == ["S1", "S2"] and body["max_output_tokens"] == 8192
    payload.write_jsonl(table.select("custom_id", "document_id"), str(tmp_path / "w"))
    assert payload.read_keyed_jsonl(spark, str(tmp_path / "w"), "custom_id string, document_id string").count() == 1
    payload.write_jsonl(table.select("custom_id").unionAll(table.select("custom_id")), str(tmp_path / "twice"))
    with pytest.raises(ValueError):
        payload.read_keyed_jsonl(spark, str(tmp_path / "twice"), "custom_id string")


def test_streamed_results(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"custom_id": "a", "n": 1}\n{"custom_id": "b"}\nbad\n{"custom_id": "a", "n": 2}\n')
    query = first_results(spark, str(folder)).writeStream.format("memory").queryName("got").option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r["custom_id"] for r in spark.table("got").collect()) == ["a", "b"]
