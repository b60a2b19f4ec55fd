"""Labelling requests for windows, and keyed reading and writing of JSON lines."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caesura.functions.text import BOUNDARY_TYPES
from caesura.operators.windows import anchored_text

# The request's texts.
SYSTEM_PROMPT = "You are a Korean sermon discourse-boundary annotation teacher. Annotate only target_local_sids. Metadata is available only as hints, not gold labels. Do not rewrite, summarize, translate, or normalize the sermon text. A boundary means a split after the sentence. Return strict JSON that matches the provided schema."
INSTRUCTIONS = [
    "Return one annotation for every target_local_sid.",
    "Use boundary_type='none' when split_after=false.",
    "Use a non-none boundary_type when split_after=true.",
    "Keep scripture quotation/reference together.",
    "Treat metadata hints as hints, not gold labels.",
    "Do not annotate context sentences.",
    "Do not annotate a boundary when the next source sentence is not visible.",
]
MODEL, MAX_OUTPUT_TOKENS = "gpt-5.5", 8192
SCHEMA_NAME = "sermon_teacher_boundary_annotation"
# End of fixed values.


def _object(**properties: dict) -> dict:
    """A JSON schema of an object with just these properties, all required."""
    return {"type": "object", "additionalProperties": False, "properties": properties, "required": list(properties)}


def _list(items: dict) -> dict:
    return {"type": "array", "items": items}


_STRING, _LABEL, _SHARE = {"type": "string"}, {"type": "string", "enum": BOUNDARY_TYPES}, {"type": "number", "minimum": 0, "maximum": 1}


def response_schema() -> dict:
    """What an answer to a window's request must be."""
    item = _object(local_sid=_STRING, source_sentence_id=_STRING, split_after={"type": "boolean"}, boundary_type=_LABEL, confidence=_SHARE, rationale=_STRING)
    return _object(custom_id=_STRING, boundary_annotations=_list(item), quality_flags=_list(_STRING))


def document_response_schema() -> dict:
    """What an answer to a document's request must be."""
    item = _object(sentence_id=_STRING, text_excerpt=_STRING, split_after={"type": "boolean"}, boundary_type=_LABEL, confidence=_SHARE, rationale=_STRING)
    paragraph = _object(paragraph_id=_STRING, sentence_ids=_list(_STRING), paragraph_role=_STRING, reason=_STRING)
    return _object(document_id=_STRING, source_type=_STRING, reasoning_effort=_STRING, preprocessing_observations=_list(_STRING), boundary_annotations=_list(item), proposed_atomic_paragraphs=_list(paragraph), quality_flags=_list(_STRING))


def _named(**columns: Column) -> Column:
    return F.named_struct(*[x for k, v in columns.items() for x in (F.lit(k), v)])


def task(custom_id: Column, document_id: Column, visible: Column, targets: Column) -> Column:
    """The user's part of a request, as JSON."""
    texts = lambda xs: F.array(*map(F.lit, xs))
    return F.to_json(_named(custom_id=custom_id, document_id=document_id, target_local_sids=F.transform(targets, lambda s: s["local_sid"]), anchored_text=F.split(anchored_text(visible), "\n"), allowed_boundary_types=texts(BOUNDARY_TYPES), instructions=texts(INSTRUCTIONS)), {"ignoreNullFields": "false"})


def requests(windows: DataFrame, model: str = MODEL, max_output_tokens: int = MAX_OUTPUT_TOKENS) -> DataFrame:
    """custom_id, method, url and body (JSON) of a request a window."""
    user = task(F.col("custom_id"), F.col("document_id"), F.col("visible"), F.col("targets"))
    message = lambda role, text: _named(role=F.lit(role), content=text)
    body = _named(model=F.lit(model), input=F.array(message("system", F.lit(SYSTEM_PROMPT)), message("user", user)), max_output_tokens=F.lit(max_output_tokens))
    wanted = {"format": {"type": "json_schema", "name": SCHEMA_NAME, "schema": response_schema(), "strict": True}}
    whole = F.concat(F.expr("left(json, length(json) - 1)"), F.lit(f', "text": {json.dumps(wanted, ensure_ascii=False)}}}'))  # a constant part, put before the last brace
    return windows.withColumn("json", F.to_json(body)).select("custom_id", F.lit("POST").alias("method"), F.lit("/v1/responses").alias("url"), whole.alias("body"))


def write_jsonl(rows: DataFrame, path: str) -> None:
    """JSON lines with sorted keys and nulls kept."""
    rows.select(*sorted(rows.columns)).write.option("ignoreNullFields", "false").json(path)


def read_keyed_jsonl(spark: SparkSession, path: str, schema: str, key: str = "custom_id") -> DataFrame:
    """Rows of JSON lines; a bad row, an empty key or a repeated one is an error."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    bad = rows.groupBy(key).count().where(F.col(key).isNull() | (F.col(key) == "") | (F.col("count") > 1)).head()
    if bad is not None:
        raise ValueError(f"{path}: empty or repeated {key}: {bad[key]!r}")
    return rows
