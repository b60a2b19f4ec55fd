"""Expected results of the engine's operators on small inputs."""

import io
import json
import random
import zipfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from caesura.functions import text as T
from caesura.operators import evaluation, ingest, training, windows
from caesura.sources import markup


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).head()["y"]


def docs(spark, **texts):
    return spark.createDataFrame(list(texts.items()), "document_id string, sentences array<string>")


def test_text(spark):
    assert one(spark, T.normalize_ws, "  요한   일서\n2장\t1절  ") == "요한 일서 2장 1절"
    assert [one(spark, T.is_layout_noise, x) for x in ("12", "•", "", "문장입니다.")] == [True, True, True, False]
    assert one(spark, lambda c: T.script_count(c, "latin"), "áéñüĀāƀƁ×") == 8
    assert one(spark, T.language_reason, "(계 19:7, 8)") == "scripture_reference_or_short_context"
    assert one(spark, T.language_reason, "An English sentence of some length.") == "latin_dominant_foreign"
    assert [one(spark, T.document_kind, x) for x in ("기도 논문", "논문", "공지", "x")] == ["prayer", "thesis", "notice", "sermon"]
    assert one(spark, lambda c: F.size(T.split_sentences(c)), "오늘 본문 말씀은 요한일서 2장 1절입니다 " * 25) == 25
    labels = ["기도하겠습니다.", "하나님 아버지", "Chapter 9", "본문 설명입니다.", " ", "아멘", "(요 3:16)", "제목"]
    assert [one(spark, T.boundary_label, x) for x in labels] == ["prayer_or_closing", "none", "topic_shift", "none", "none", "prayer_or_closing", "scripture_reading_start", "topic_shift"]
    import hashlib

    for x in ("a", "docx.1234", "é"):
        b = int(hashlib.sha1(x.encode()).hexdigest(), 16) % 10
        assert one(spark, T.split_name, x) == ("train" if b < 8 else "validation" if b == 8 else "test")


def test_sentences_cap(spark):
    table = docs(spark, a=["x one.", "y two."], b=[])
    assert windows.explode_sentences(table, 0).count() == 0
    assert [r["sentence_id"] for r in windows.explode_sentences(table, 1).collect()] == ["a.s0000"]
    long = spark.createDataFrame([("d", 1, "b"), ("d", 0, "a")], "document_id string, sentence_index int, text string")
    assert windows.group_sentences(long).head()["sentences"] == ["a", "b"]


def test_windows(spark):
    got = windows.build_windows(docs(spark, a=[f"t{i}" for i in range(6)]), 3, 1, 1).orderBy("window_index").collect()
    assert [(r["custom_id"], [s["local_sid"] for s in r["visible"]], [s["local_sid"] for s in r["targets"]]) for r in got] == [("teacher:a:w0000:0-3", ["S1", "S2", "S3", "S4"], ["S1", "S2", "S3"]), ("teacher:a:w0001:3-6", ["S1", "S2", "S3", "S4"], ["S2", "S3"])]
    assert got[1]["visible"][1]["source_sentence_id"] == "a.s0003"
    assert windows.build_windows(docs(spark, a=["one"]), 1, 1, 1).count() == 0
    assert windows.limit_windows(windows.build_windows(docs(spark, a=list("abcdefghij"), b=list("abc")), 2, 1, 1), 1).count() == 1
    with pytest.raises(ValueError):
        windows.build_windows(docs(spark, a=["x"]), 0)


def test_windows_against_loop(spark):
    rnd = random.Random(3)
    for _ in range(4):
        n, t, left, right = rnd.randint(1, 20), rnd.randint(1, 6), rnd.randint(0, 8), rnd.randint(0, 8)
        want = {}
        for w in range(-(-n // t)):
            a, b = max(0, w * t - left), min(n, min(w * t + t, n) + right)
            kept = [p for p in range(a, b) if w * t <= p < min(w * t + t, n) and p + 1 < b]
            if kept:
                want[w] = (a, b, [f"S{p - a + 1}" for p in kept])
        got = windows.build_windows(docs(spark, d=[str(i) for i in range(n)]), t, left, right).collect()
        assert {r["window_index"]: (r["visible_start"], r["visible_end"], [s["local_sid"] for s in r["targets"]]) for r in got} == want


ITEM = "array<struct<local_sid: string, split_after: boolean, boundary_type: string>>"


def test_outputs_and_rendering(spark):
    items = [("S10", True, "application_start"), ("S2", True, "topic_shift"), ("S3", False, "none")]
    assert one(spark, training.sparse_output, items, ITEM) == "S2 topic_shift\nS10 application_start"
    assert one(spark, training.first_output, items, ITEM) == "S2 topic_shift"
    assert one(spark, training.sparse_output, items[2:], ITEM) == one(spark, training.first_output, items[2:], ITEM) == "NO_BOUNDARY"
    with pytest.raises(Exception, match="not a boundary label"):
        one(spark, training.sparse_output, [("S1", True, "none")], ITEM)
    sentence = "array<struct<local_sid: string, text: string>>"
    rendered = one(spark, training.student_input, [("S2", "a b"), ("S10", "c")], sentence)
    assert rendered.splitlines()[-3:] == ["<TEXT>", "<S2> a b", "<S10> c"] and rendered.startswith("<TASK>\n")
    assert [tuple(s) for s in one(spark, training.extract_sentences, rendered)] == [("S2", "a b"), ("S10", "c")]
    assert [one(spark, training.boundary_line_count, x) for x in ("", "NO_BOUNDARY", "S1 a\n\nS2 b")] == [0, 0, 2]


def parsed(spark, output, valid):
    rows = training.parse_outputs(spark.createDataFrame([("e", output, valid)], "example_id string, output string, valid array<string>"))
    return [(r["line_number"], r["issues"], r["is_boundary"]) for r in rows.orderBy("line_number").collect()]


def test_parser(spark):
    assert parsed(spark, "S2 none\nS9 topic_shift\nbad\nSX topic_shift", ["S1", "S2"]) == [(1, ["invalid_label"], False), (2, ["unknown_local_sid"], False), (3, ["invalid_line"], False), (4, ["invalid_line", "unknown_local_sid"], False)]
    assert parsed(spark, "S2 topic_shift\nS1 topic_shift", ["S1", "S2"])[1] == (2, ["not_ascending"], True)
    assert parsed(spark, "NO_BOUNDARY", ["S1"]) == [] and parsed(spark, " ", ["S1"]) == [(1, ["invalid_line"], False)]
    assert parsed(spark, "S1 topic_shift\nS1 topic_shift", ["S1"])[1] == (2, ["duplicate_local_sid", "not_ascending"], False)


def f1(gold, predicted, tolerance):
    left, tp = sorted(gold), 0
    for p in sorted(predicted):
        near = [g for g in left if abs(g - p) <= tolerance]
        if near:
            left.remove(min(near, key=lambda g: (abs(g - p), g)))
            tp += 1
    return tp


def test_metrics(spark):
    rnd = random.Random(5)
    rows = [([2, 7], [2, 8], 9), ([2, 3], [3, 4], 5), ([], [], 5), ([2, 4], [2], 6)] + [(rnd.sample(range(1, 15), rnd.randint(0, 6)), rnd.sample(range(1, 15), rnd.randint(0, 6)), rnd.randint(1, 15)) for _ in range(60)]
    table = spark.createDataFrame(rows, "g array<int>, p array<int>, n int")
    g, p, n = F.col("g"), F.col("p"), F.col("n")
    got = table.select("g", "p", *[evaluation.matched(g, p, t).alias(f"t{t}") for t in range(3)], evaluation.boundary_f1(g, p).alias("f"), evaluation.pk(n, g, p).alias("pk"), evaluation.window_diff(n, g, p).alias("wd")).collect()
    for r in got:
        assert [r[f"t{t}"] for t in range(3)] == [f1(r["g"], r["p"], t) for t in range(3)]
    assert got[0]["f"]["f1"] == 0.5 and got[0]["t1"] == 2 and got[1]["t1"] == 1 and got[2]["f"]["f1"] == 1.0
    assert abs(got[3]["pk"] - 0.2) < 1e-12 and abs(got[3]["wd"] - 0.2) < 1e-12
    assert spark.range(1).select(evaluation.window_size(F.lit(5), F.array().cast("array<int>")).alias("k")).head()["k"] == 2


SOURCES, TARGETS = {"S1": "a.s0", "S2": "a.s1", "S3": "a.s2"}, ["S2", "S3"]


def annotation(**changes):
    items = [{"local_sid": s, "source_sentence_id": SOURCES[s], "split_after": s == "S2", "boundary_type": "topic_shift" if s == "S2" else "none", "confidence": 0.9, "rationale": ""} for s in TARGETS]
    items[0].update(changes)
    return {"custom_id": "w", "boundary_annotations": items, "quality_flags": []}


def codes(note):
    return [i["code"] for i in ingest.issues(note, "w", SOURCES, TARGETS)]


def test_validation():
    assert codes(annotation()) == []
    assert codes(annotation(split_after="false")) == ["invalid_field_type", "invalid_split_after"]
    assert codes(annotation(split_after=1)) == ["invalid_field_type", "invalid_split_after"]
    assert codes(annotation(confidence=2)) == ["invalid_confidence"] and codes(annotation(confidence=True)) == ["invalid_field_type", "invalid_confidence"]
    assert codes(annotation(confidence=float("nan"))) == []
    assert codes(annotation(boundary_type="none")) == ["split_true_boundary_none"] and codes(annotation(extra=1)) == ["additional_property"]
    assert codes(annotation() | {"boundary_annotations": None}) == ["invalid_field_type", "invalid_boundary_annotations"]
    assert codes(annotation(local_sid="S1")) == ["unknown_or_context_local_sid", "source_sentence_id_mismatch", "missing_target_annotation"]
    bare = annotation()
    del bare["quality_flags"]
    assert ingest.issues(bare, "w", SOURCES, TARGETS) == [{"code": "missing_required_field", "path": "$", "field": "quality_flags"}]


def line(custom_id, note, status=200):
    return json.dumps({"custom_id": custom_id, "response": {"status_code": status, "body": {"output": [{"content": [{"type": "output_text", "text": json.dumps(note)}]}]}}})


def test_routing(spark):
    shown = windows.build_windows(docs(spark, a=["x", "y"], b=["x", "y"], c=["x", "y"], d=["x", "y"]), 2, 0, 0)
    item = lambda d, c: {"local_sid": "S1", "source_sentence_id": f"{d}.s0000", "split_after": False, "boundary_type": "none", "confidence": c, "rationale": ""}
    name = lambda d: f"teacher:{d}:w0000:0-2"
    note = lambda d, c=0.9: {"custom_id": name(d), "boundary_annotations": [item(d, c)], "quality_flags": []}
    lines = [line(name("a"), note("a")), line(name("a"), note("a")), line(name("b"), note("b", 0.7)), line(name("c"), note("c"), 500), "not json", line("other", note("a"))]
    results = spark.createDataFrame(list(enumerate(lines, 1)), "line_number long, line string")
    got = {(r["line_number"], r["route"], r["needs_review"], r["exception_type"]) for r in ingest.route(results, shown).collect()}
    assert got == {(1, "ok", False, None), (2, "failure", False, "ValueError"), (3, "ok", True, None), (4, "failure", False, "ValueError"), (5, "failure", False, "JSONDecodeError"), (6, "failure", False, "KeyError"), (None, "failure", False, "MissingBatchResult")}


def test_features_and_scores(spark):
    table = spark.createDataFrame([("c", "제 aab  aa", 1)], "candidate_id string, t string, n int").select("candidate_id", training.feature_map(F.col("t"), F.col("n")).alias("features"))
    got = table.head()["features"]
    assert got["bias"] == got["sid:first"] == got["cue:starts_je"] == got["sid_bucket:1"] == got["len_bucket:0"] == 1.0
    assert got["char:a"] == 4.0 and got["bigram:aa"] == 2.0 and got["bigram: a"] == 2.0 and "char: " not in got
    weights = spark.createDataFrame([("topic_shift", "bias", 3.0)], "label string, feature string, weight double")
    best = training.score(table, weights).where("rank = 1").head()
    assert best["label"] == "topic_shift" and abs(best["probability"] - 0.7415) < 1e-3
    assert training.score(table, weights.limit(0)).where("rank = 1").head()["label"] == "none"


def test_training(spark):
    table = spark.createDataFrame([(i, {"bias": 1.0, f"x{i % 2}": 1.0}, ["none", "topic_shift"][i % 2]) for i in range(20)], "candidate_id long, features map<string,double>, label string")
    weights = training.train(table, epochs=20)
    said = training.score(table, weights).where("rank = 1").join(table.select("candidate_id", F.col("label").alias("gold")), "candidate_id")
    assert said.where("label = gold").count() == 20


def test_html(spark):
    page = "<div data-page-id='0'><h2>Head</h2><p>a<b>b</b><br>c</p></div><ul><li>outer <li>inner</li></li></ul><p>12</p><p>lost"
    got = markup.html_blocks(spark.createDataFrame([(1, page), (2, None)], "id int, html string"), "id").orderBy("position").collect()
    assert [(r["text"], r["source_tag"], r["html_boundary_before"]) for r in got] == [("Head", "h2", True), ("a b c", "p", True), ("inner", "li", False), ("outer inner", "li", False)]
    assert got[1]["heading_context"] == ["Head"] and got[1]["page_id"] == "0" and got[0]["block_id"] == "html.b0000"


def docx(*paragraphs):
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{markup.WORD[1:-1]}"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def test_files(spark, tmp_path):
    for folder, name, data in (("docx", "a.docx", docx("한글 문장입니다.", "An English paragraph that is long enough.", "또 다른 문장")), ("docx", "broken.docx", b"no zip"), ("datalab_parsed/x", "p.json", json.dumps({"html": "<p>text here</p>"}).encode())):
        (tmp_path / "datas" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / "datas" / folder / name).write_bytes(data)
    decoded = markup.decode(markup.discover(spark, str(tmp_path), "docx"), "docx")
    by = {r["path"]: r for r in decoded.collect()}
    assert by["datas/docx/broken.docx"]["exception_type"] == "BadZipFile"
    blocks = markup.number_blocks(decoded, "docx").orderBy("paragraph_index").collect()
    assert [(b["block_id"], b["paragraph_index"], b["language_filter_reason"]) for b in blocks] == [("docx.b0000", 0, "hangul_present"), ("docx.b0001", 2, "hangul_present")]
    assert markup.decode(markup.discover(spark, str(tmp_path), "datalab_parsed_json"), "datalab_parsed_json").head()["paragraphs"] == ["text here"]


def test_hwp():
    chars = [SimpleNamespace(kind="char_code", code=ord(c)) for c in "정상 문장입니다."] + [SimpleNamespace(kind="char_code", code=0xD800), SimpleNamespace(kind="control", code=65)]
    reader = lambda path: SimpleNamespace(sections=[SimpleNamespace(paragraphs=[SimpleNamespace(chars=chars), SimpleNamespace(chars=[])])])
    assert markup.hwp_paragraphs("x", reader) == ["정상 문장입니다."]
