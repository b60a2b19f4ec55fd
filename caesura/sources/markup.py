"""Paragraphs from HTML, DOCX and HWP files. Decoding is Python; what fails gives an error in its row, not a failed job."""

from __future__ import annotations

import functools
import io
import json
import re
import unicodedata
import zipfile
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caesura.functions.text import document_id, document_kind, is_kept, is_layout_noise, language_reason, let, split_sentences
from caesura.operators import windows

# Tags that make blocks, and the places and kinds of source files.
BLOCK_TAGS = ("h1", "h2", "h3", "li", "p", "td", "th")
SOURCES = {"datalab_parsed_json": ("datas/datalab_parsed", "*.json"), "docx": ("datas/docx", "*.docx"), "hwp": ("datas/hwps", "*.hwp")}
SAMPLE_MARKS = ("세마포", "10")
WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
# End of fixed values.


def squeeze(text: str) -> str:
    return " ".join(text.split())


class Spans(HTMLParser):
    """Where a page's blocks begin and end among the pieces of its text. What a span means is decided by column expressions."""

    def __init__(self) -> None:
        super().__init__()
        self.pieces: list[str] = []
        self.page: str | None = None
        self.pending: list[dict] = []
        self.found: list[dict] = []

    def handle_starttag(self, tag, attrs):
        if tag == "div":
            self.page = next((v for k, v in reversed(attrs) if k == "data-page-id" and v is not None), self.page)
        if tag in BLOCK_TAGS:
            self.pending.append({"tag": tag, "page_id": self.page, "before": len(self.found), "start": len(self.pieces)})

    def handle_data(self, data):
        self.pieces.append(data)

    def handle_endtag(self, tag):
        if self.pending and self.pending[-1]["tag"] == tag:  # any other end tag is noise
            span = self.pending.pop()
            self.found.append(span | {"text": squeeze(" ".join(self.pieces[span["start"] :]))})


def spans(html: str | None) -> list[dict]:
    """tag, page_id, before (how many spans had ended where this one begins) and text of all spans that end, in the order of their ends.

    A span's text has that of the spans within it.
    """
    parser = Spans()
    parser.feed(html or "")
    parser.close()
    return parser.found


#: How many pages are Python objects at a time.
SLICE = 100
SPAN = "array<struct<tag: string, page_id: string, before: int, text: string>>"
_SPAN = pa.list_(pa.struct([("tag", pa.string()), ("page_id", pa.string()), ("before", pa.int32()), ("text", pa.string())]))


def blocks(found: Column) -> Column:
    """Blocks of an array of spans: those that aren't layout noise, numbered, with the last three headings that ended before they begin and
    whether a boundary lies before them (at the first block, and at both sides of a heading)."""
    is_heading = lambda x: x["tag"].startswith("h")
    placed = F.transform(found, lambda x, i: F.struct(i.alias("at"), x["tag"].alias("tag"), x["page_id"].alias("page_id"), x["before"].alias("before"), x["text"].alias("text")))

    def block(x: Column, i: Column, kept: Column) -> Column:
        headings = F.transform(F.filter(kept, lambda y: is_heading(y) & (y["at"] < x["before"])), lambda y: y["text"])
        return F.struct(
            F.format_string("html.b%04d", i).alias("block_id"), x["text"].alias("text"), F.when(is_heading(x), "heading").otherwise("paragraph").alias("block_type"), x["tag"].alias("source_tag"), x["page_id"].alias("page_id"),
            let(headings, lambda h: F.slice(h, F.greatest(F.size(h) - 2, F.lit(1)), F.lit(3))).alias("heading_context"), ((i == 0) | is_heading(x) | F.coalesce(is_heading(F.get(kept, i - 1)), F.lit(False))).alias("html_boundary_before"),
        )

    return let(F.filter(placed, lambda x: ~is_layout_noise(x["text"])), lambda kept: F.transform(kept, lambda x, i: block(x, i, kept)))


def _parsed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            yield pa.array([spans(x) for x in batch.slice(at, SLICE).to_pylist()], _SPAN)


def html_blocks(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """key, position and the block's columns; a null page has none."""
    found = pages.select(key, F.arrow_udf(_parsed, SPAN)(html).alias("spans"))
    return found.select(key, F.posexplode(blocks(F.col("spans"))).alias("position", "block")).select(key, "position", "block.*")


def docx_paragraphs(data: bytes) -> list[str]:
    """Texts of all w:p, nested ones also inside the outer one's; tabs are spaces, breaks line ends; empty ones go."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    plain = {f"{WORD}tab": " ", f"{WORD}br": "\n"}
    texts = (squeeze("".join((x.text or "") if x.tag == f"{WORD}t" else plain.get(x.tag, "") for x in p.iter())) for p in root.iter(f"{WORD}p"))
    return [t for t in texts if t]


def hwp_paragraphs(content: bytes, reader: Callable) -> list[str]:
    """Texts by a reader of the format (from bytes to sections of paragraphs of chars); only characters that are text count."""
    out = []
    for section in reader(content).sections:
        for paragraph in section.paragraphs:
            text = squeeze("".join(chr(c.code) for c in paragraph.chars if c.kind == "char_code" and c.code > 0 and not 0xD800 <= c.code <= 0xDFFF))
            if text:
                out.append(text)
    return out


def _known(source_type: str) -> str:
    if source_type not in SOURCES:
        raise ValueError(f"no such source type: {source_type}")
    return source_type


def discover(spark: SparkSession, root: str, source_type: str) -> DataFrame:
    """path (below root), content of all files of a kind; by the session's readers, so any store will do."""
    folder, pattern = SOURCES[_known(source_type)]
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(source_type == "datalab_parsed_json").lower()).load(f"{root.rstrip('/')}/{folder}")
    return files.select(F.coalesce(F.nullif(F.regexp_extract("path", f"({re.escape(folder)}/.*)$", 1), F.lit("")), "path").alias("path"), "content")


def discover_all(spark: SparkSession, root: str, kinds: Iterable[str] = tuple(SOURCES)) -> DataFrame:
    """source_type, path, content of all kinds, in their order and by path."""
    out = None
    for k, kind in enumerate(kinds):
        part = discover(spark, root, kind).select(F.lit(k).alias("kind"), F.lit(kind).alias("source_type"), "path", "content")
        out = part if out is None else out.unionByName(part)
    return out.orderBy("kind", "path").drop("kind")


def pick(files: DataFrame, source_type: str) -> DataFrame:
    """The one sample file (path, content) of a kind, by path: JSON that succeeded and has html; the tenth chapter's DOCX, else the first; the first HWP."""
    _known(source_type)
    if source_type == "datalab_parsed_json":
        parsed = F.from_json(F.decode("content", "UTF-8"), "success boolean, html string")
        found = files.where(parsed["success"] & (parsed["html"] != "")).orderBy("path")
    elif source_type == "docx":
        named = F.pandas_udf(lambda paths: paths.map(lambda p: all(x in unicodedata.normalize("NFC", p.rsplit("/", 1)[-1]) for x in SAMPLE_MARKS)), "boolean")
        found = files.orderBy(~named("path"), "path")
    else:
        found = files.orderBy("path")
    found = found.limit(1)
    if found.head() is None:
        raise FileNotFoundError(f"no {source_type} file fits")
    return found


def read_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines; a path that isn't there is an empty table."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def decode(files: DataFrame, source_type: str, reader: Callable | None = None) -> DataFrame:
    """document_id, path, kind (by the composed file name), paragraphs, exception_type, error: paragraphs or the last two are null. Paragraphs of HTML are its blocks' texts."""
    _known(source_type)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def paragraphs(content: bytes) -> list[str]:
            if source_type == "docx":
                return docx_paragraphs(content)
            if source_type == "hwp":
                if reader is None:
                    raise ModuleNotFoundError("no reader for hwp files")
                return hwp_paragraphs(content, reader)
            return [b["text"] for b in spans(json.loads(content).get("html"))]

        for batch in batches:
            out = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                name = unicodedata.normalize("NFC", path.rsplit("/", 1)[-1])
                try:
                    out.append((path, name, paragraphs(bytes(content)), None, None))
                except Exception as e:  # the row says what went wrong
                    out.append((path, name, None, type(e).__name__, str(e)))
            yield pd.DataFrame(out, columns=["path", "name", "paragraphs", "exception_type", "error"])

    got = files.select("path", "content").mapInPandas(rows, "path string, name string, paragraphs array<string>, exception_type string, error string")
    kept = F.filter("paragraphs", lambda x: ~is_layout_noise(x)) if source_type == "datalab_parsed_json" else F.col("paragraphs")
    kind = F.lit("book_chapter") if source_type == "datalab_parsed_json" else document_kind(F.col("name")) if source_type == "docx" else F.lit("sermon")
    return got.select(document_id(source_type, F.col("path")).alias("document_id"), "path", kind.alias("kind"), kept.alias("paragraphs"), "exception_type", "error")


def number_blocks(decoded: DataFrame, source_type: str) -> DataFrame:
    """Blocks of paragraphs: paragraph_index counts all, block_id only those kept; DOCX paragraphs must pass the language filter."""
    rows = decoded.select("document_id", F.posexplode("paragraphs").alias("paragraph_index", "text"))
    if source_type == "docx":
        rows = rows.withColumn("language_filter_reason", language_reason(F.col("text"))).where(is_kept(F.col("text")))
    number = F.row_number().over(Window.partitionBy("document_id").orderBy("paragraph_index")) - 1
    return rows.withColumn("block_id", F.format_string(f"{source_type}.b%04d", number))


def document_rows(decoded: DataFrame, source_type: str) -> DataFrame:
    """A row a document that could be decoded: its ids and kind, and how many paragraphs were kept and removed."""
    kept = F.size(F.filter("paragraphs", is_kept)) if source_type == "docx" else F.size("paragraphs")
    return decoded.where("exception_type IS NULL").select("document_id", F.lit(source_type).alias("source_type"), F.col("path").alias("source_path"), "kind", kept.alias("block_count"), (F.size("paragraphs") - kept).alias("removed_count"))


def failure_rows(decoded: DataFrame, source_type: str) -> DataFrame:
    return decoded.where("exception_type IS NOT NULL").select("document_id", F.lit(source_type).alias("source_type"), F.col("path").alias("source_path"), "exception_type", "error")


def build_dataset(spark: SparkSession, root: str, out: str, reader: Callable | None = None, cap: int | None = None) -> dict:
    """Files of all kinds to <out>/documents, <out>/sentences and <out>/failures (JSON lines) and <out>/summary; returns the summary.

    A file that can't be decoded is a failure row and doesn't stop the others. Files are decoded once, into <out>/decoded.
    """
    documents, sentences, failures = [], [], []
    for kind in SOURCES:
        try:
            files = discover(spark, root, kind)
        except AnalysisException:  # no such folder
            continue
        decode(files, kind, reader).write.parquet(f"{out}/decoded/{kind}")
        decoded = spark.read.parquet(f"{out}/decoded/{kind}")
        documents.append(document_rows(decoded, kind))
        failures.append(failure_rows(decoded, kind))
        texts = F.filter("paragraphs", is_kept) if kind == "docx" else F.col("paragraphs")
        arrays = decoded.where("exception_type IS NULL").select("document_id", F.flatten(F.transform(texts, split_sentences)).alias("sentences"))
        sentences.append(windows.explode_sentences(arrays, cap).withColumn("source_type", F.lit(kind)))
    tables = {"documents": documents, "sentences": sentences, "failures": failures}
    summary: dict = {}
    for name, parts in tables.items():
        if not parts:
            summary[name] = {}
            continue
        table = functools.reduce(DataFrame.unionByName, parts)
        table.write.option("ignoreNullFields", "false").json(f"{out}/{name}")
        summary[name] = {r["source_type"]: r["count"] for r in table.groupBy("source_type").count().collect()}  # a row a kind
    spark.createDataFrame([(json.dumps(summary, sort_keys=True),)], "value string").coalesce(1).write.text(f"{out}/summary")
    return summary


def failure_line() -> Column:
    """A failure as a row of a Markdown table: bars escaped, line ends as spaces, the error cut to 300 characters."""
    clean = lambda c: F.regexp_replace(F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|")), r"[\r\n]+", " ")
    return F.concat(F.lit("| "), F.concat_ws(" | ", clean(F.col("source_type")), clean(F.col("source_path")), clean(F.col("exception_type")), F.substring(clean(F.col("error")), 1, 300)), F.lit(" |"))
