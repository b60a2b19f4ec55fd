"""Building: files to sentences, annotations to training sets, evaluation, results to their four outputs, requests."""

import json
import math
import os

import pytest

from caesura.operators import browse, ingest, payload, student, training, validation
from caesura.sources import markup

WINDOW = "custom_id string, document_id string, source_path string, target_local_sids array<string>, local_to_source map<string, struct<source_sentence_id: string, text: string>>"


def note(custom_id, *items):
    given = [{"local_sid": s, "source_sentence_id": f"d.{s}", "split_after": label != "none", "boundary_type": label, "confidence": 0.9, "rationale": "r"} for s, label in items]
    return json.dumps({"custom_id": custom_id, "boundary_annotations": given, "quality_flags": []})


def window(custom_id, document_id, sids, texts):
    return custom_id, document_id, "p", sids, {s: (f"d.{s}", t) for s, t in texts.items()}


def rows_of(folder):
    return [json.loads(line) for f in sorted(os.listdir(folder)) if f.startswith("part-") for line in open(f"{folder}/{f}", encoding="utf-8")]


def test_build(spark, tmp_path):
    windows = spark.createDataFrame([window("a", "doc1", ["S2", "S10", "S2"], {"S2": "둘.", "S10": "열.", "S1": "하나."}), window("b", "doc2", [], {"S1": "x"}), window("c", "doc3", ["S1"], {"S1": "끝."}), window("z", "doc9", ["S1"], {})], WINDOW)
    notes = [("a", note("a", ("S10", "topic_shift"), ("S2", "prayer_or_closing"))), ("b", note("b")), ("c", note("c", ("S1", "none")))]
    table = lambda rows: spark.createDataFrame(rows, "custom_id string, annotation string")
    out = f"{tmp_path}/sets"
    summary = student.build(table(notes), windows, out)
    assert summary["example_count"] == 2 and summary["skipped_empty_candidate_count"] == 1
    assert {f: sum(n.values()) for f, n in summary["split_counts"].items()} == dict.fromkeys(student.FAMILIES, 2)
    made = {(f, s): rows_of(f"{out}/{f}/{s}") for f in student.FAMILIES for s in student.SPLITS}  # all six are there
    sparse = {r["example_id"]: r for (f, _), rows in made.items() for r in rows}
    assert sparse["sparse:a"]["output"] == "S2 prayer_or_closing\nS10 topic_shift" and sparse["first:a"]["output"] == "S2 prayer_or_closing"
    assert sparse["sparse:c"]["output"] == sparse["first:c"]["output"] == "NO_BOUNDARY"
    assert sparse["sparse:a"]["input"].endswith("<TEXT>\n<S2> 둘.\n<S10> 열.")
    assert [r["custom_id"] for r in rows_of(f"{out}/mappings")] == ["a", "c"]
    found = student.candidates(spark.createDataFrame([(r["example_id"], r["document_id"], r["input"], r["output"]) for r in sparse.values()], "example_id string, document_id string, input string, output string"))
    labels = {(r["example_id"], r["local_sid"]): r["label"] for r in found.collect()}
    assert labels["sparse:a", "S10"] == "topic_shift" and labels["first:a", "S10"] == "none" and len(labels) == 6
    assert [r["label"] for r in student.limit_candidates(found, 3).collect()].count("none") == 0 and student.limit_candidates(found, 5).count() == 5
    with pytest.raises(ValueError):
        student.limit_candidates(found, 0)
    for bad, said in ((("q", note("q")), "no window"), (("z", note("z", ("S1", "none"))), "local_to_source lacks S1"), (("c", note("c", ("S1", "odd"))), "unknown_boundary_type")):
        with pytest.raises(ValueError, match=said):
            student.build(table([*notes[:2], bad]), windows, f"{tmp_path}/none")
    assert not os.path.exists(f"{tmp_path}/none")
    assert {r["metric"]: r["value"] for r in student.flat_metrics(spark, {"a": 1, "b": {"c": 2.5, "d": True, "e": "x"}}).collect()} == {"dataset/a": 1.0, "dataset/b/c": 2.5}


def test_evaluate(spark):
    rows = [("e", 1, "none", "topic_shift", 0.5), ("e", 2, "topic_shift", "none", 0.25), ("e", 3, "none", "none", 0.0), ("f", 1, "topic_shift", "topic_shift", 1.0)]
    schema = "example_id string, number int, gold string, predicted string, p_gold double"
    got = student.evaluate(spark.createDataFrame(rows, schema)).head()
    loss = (-math.log(0.5) - math.log(0.25) - math.log(1e-12)) / 4
    assert (got["candidate_count"], got["example_count"], got["accuracy"], got["precision"], got["recall"], got["f1"], got["tolerance1_f1"]) == (4, 2, 0.5, 0.5, 0.5, 0.5, 1.0) and abs(got["loss"] - loss) < 1e-9
    none = student.evaluate(spark.createDataFrame([("e", 1, "none", "none", 1.0)], schema)).head()
    assert (none["precision"], none["recall"], none["f1"]) == (1.0, 1.0, 1.0)
    assert student.evaluate(spark.createDataFrame([], schema)).head().asDict() == dict.fromkeys(("loss", "accuracy", "precision", "recall", "f1", "tolerance1_f1"), 0.0) | {"candidate_count": 0, "example_count": 0}


def test_blank_lines_count_but_are_no_issue(spark):
    rows = [("a", "S1 topic_shift\n\n  \nS2 topic_shift\n", ["S1", "S2"]), ("b", " \n ", ["S1"])]
    got = training.parse_outputs(spark.createDataFrame(rows, "example_id string, output string, valid array<string>")).orderBy("example_id", "line_number").collect()
    assert [(r["example_id"], r["line_number"], r["issues"]) for r in got] == [("a", 1, []), ("a", 4, []), ("b", 1, ["invalid_line"])]


def test_dataset(spark, tmp_path):
    os.makedirs(f"{tmp_path}/datas/datalab_parsed/x"), os.makedirs(f"{tmp_path}/datas/hwps")
    page = '<div data-page-id="3"><h1>제목입니다</h1><p>첫 문장입니다. 둘째 문장입니다.</p><p>12</p><p>바깥 <td>안쪽</td> 끝</p></div>'
    for name, body in (("b", {"html": page, "success": True}), ("a", {"html": None}), ("c", "not json")):
        with open(f"{tmp_path}/datas/datalab_parsed/x/{name}.json", "w", encoding="utf-8") as f:
            f.write(body if isinstance(body, str) else json.dumps(body))
    with open(f"{tmp_path}/datas/hwps/기도.hwp", "wb") as f:
        f.write(b"h")
    summary = markup.build_dataset(spark, str(tmp_path), f"{tmp_path}/out")
    assert summary["documents"] == {"datalab_parsed_json": 2} and summary["failures"] == {"datalab_parsed_json": 1, "hwp": 1}
    texts = [r["text"] for r in sorted(rows_of(f"{tmp_path}/out/sentences"), key=lambda r: r["sentence_index"])]
    assert texts == ["제목입니다", "첫 문장입니다.", "둘째 문장입니다.", "안쪽", "바깥 안쪽 끝"]
    files = markup.discover_all(spark, str(tmp_path), ("datalab_parsed_json", "hwp"))
    assert [r["path"].rsplit("/", 1)[-1] for r in files.collect()] == ["a.json", "b.json", "c.json", "기도.hwp"]
    assert markup.pick(markup.discover(spark, str(tmp_path), "datalab_parsed_json"), "datalab_parsed_json").head()["path"].endswith("b.json")
    with pytest.raises(FileNotFoundError):
        markup.pick(markup.discover(spark, str(tmp_path), "datalab_parsed_json").where("path LIKE '%a.json'"), "datalab_parsed_json")
    with pytest.raises(ValueError):
        markup.discover(spark, str(tmp_path), "pdf")
    assert markup.read_rows(spark, f"{tmp_path}/nowhere", "a int").count() == 0
    failures = markup.failure_rows(markup.decode(markup.discover(spark, str(tmp_path), "hwp"), "hwp"), "hwp")
    line = failures.withColumn("error", markup.F.lit("a|b\nc" + "x" * 400)).select(markup.failure_line().alias("line")).head()["line"]
    assert line.startswith("| hwp | datas/hwps/") and "| a\\|b cxx" in line and len(line) < 420


def test_results(spark, tmp_path):
    with open(f"{tmp_path}/r.jsonl", "w", encoding="utf-8") as f:
        f.write('{"custom_id": "a"}\n\nbad\n')
    numbered = ingest.read_results(spark, f"{tmp_path}/r.jsonl")
    assert [(r["line_number"], r["line"]) for r in numbered.orderBy("line_number").collect()] == [(1, '{"custom_id": "a"}'), (3, "bad")]
    routed = spark.createDataFrame([("a", 1, "ok", [], True, None, "{}"), ("b", 2, "issues", ["x", "y"], False, None, "{}"), ("c", None, "failure", [], False, "KeyError", None)], ingest.ROUTED)
    assert ingest.write_routes(routed, f"{tmp_path}/out") == {"ok_count": 1, "issue_count": 2, "failure_count": 1, "review_count": 1}
    assert [len(rows_of(f"{tmp_path}/out/{x}")) for x in ("annotations", "issues", "failures", "review")] == [1, 1, 1, 1]


def test_requests_hold_the_schema_and_rows_without_annotation_are_an_error(spark):
    visible = "array<struct<local_sid: string, text: string>>"
    windows = spark.createDataFrame([("w", "d", [("S1", "말 \"씀\".")], [("S1", "말 \"씀\".")])], f"custom_id string, document_id string, visible {visible}, targets {visible}")
    body = json.loads(payload.requests(windows).head()["body"])
    wanted = body["text"]["format"]
    assert wanted["strict"] and wanted["schema"] == payload.response_schema() and list(body) == ["model", "input", "max_output_tokens", "text"]
    assert json.loads(body["input"][1]["content"])["anchored_text"] == ["<S1> 말 \"씀\"."]
    assert payload.document_response_schema()["required"][0] == "document_id"
    sentences = spark.createDataFrame([("d", 0, "s0", "b", 0), ("d", 1, "s1", "b", 0)], "document_id string, sentence_index int, sentence_id string, block_id string, paragraph_index int")
    items = spark.createDataFrame([("d", 0, "s0", False, "none", 0.9, False)], "document_id string, position int, sentence_id string, split_after boolean, boundary_type string, confidence double, has_flags boolean")
    with pytest.raises(Exception, match="no annotation for s1"):
        validation.training_rows(sentences, items).collect()


def test_mappings(spark):
    examples = spark.createDataFrame([("sparse:a",), ("first:a",), ("x",)], "example_id string")
    mappings = spark.createDataFrame([("sparse:a", "first:a", "a", "p", {"S1": "s"})], "sparse_example_id string, first_boundary_example_id string, custom_id string, source_path string, local_to_source map<string, string>")
    got = {r["example_id"]: r["mapping"] for r in browse.with_mappings(examples, mappings).collect()}
    assert got["sparse:a"]["custom_id"] == got["first:a"]["custom_id"] == "a" and got["x"] is None
