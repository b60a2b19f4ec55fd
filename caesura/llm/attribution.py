"""Token counts by section or field: a document is encoded once, and its tokens' character spans are joined to the sections' spans.

Sections are a text's lines, each with its line end, so they cover the text. Fields are given columns, laid out one
after another with a line end between. Which section a token that crosses a border counts for is the rule:
`first` (where its first character lies), `last` (its last character) or `largest` (the most bytes; of equals the first).
Every token counts once, so the counts of a document add up to the tokens of its whole text.

A null text counts as empty and has one section, 0, without tokens. Rows are taken as they are: repeated rows and
null doc_ids have rows of their own; an empty table gives none, extra columns are ignored, long texts are taken whole. Needs a
byte-level vocabulary, whose tokens stand for whole ranges of bytes; any other is an error.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caesura.llm.tokens import encoder, slices
from caesura.llm.vec import chunks

COUNTS = "doc_id long, section int, start_char long, end_char long, n_tokens long, n_crossing long"
_lengths: dict[str, np.ndarray] = {}


def _token_bytes(path: str) -> np.ndarray:
    if path not in _lengths:
        _lengths[path] = encoder(path).vocabulary_bytes()
    return _lengths[path]


def owners(start: np.ndarray, end: np.ndarray, borders: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """For tokens' byte spans and ascending first bytes of sections: the section of each, and whether it crosses a border."""
    first, last = (np.searchsorted(borders, x, "right") - 1 for x in (start, end - 1))
    crosses = first != last
    if rule == "first":
        return first, crosses
    if rule == "last":
        return last, crosses
    if rule != "largest":
        raise ValueError(f"no such rule: {rule}")
    owner = first.copy()
    for t in np.flatnonzero(crosses):
        edges = np.clip(np.append(borders[first[t] : last[t] + 1], end[t]), start[t], end[t])
        owner[t] = first[t] + int(np.diff(edges).argmax())
    return owner, crosses


def count_tokens(docs: DataFrame, tokenizer: str, rule: str = "first", fields: Sequence[str] = ()) -> DataFrame:
    """doc_id, section (a line's or field's number), start_char, end_char, n_tokens, n_crossing (of its tokens, those that go over its border)."""
    if not encoder(tokenizer).spaced:
        raise ValueError("the vocabulary is not byte-level: its tokens don't say how much of a text they stand for")
    n_fields = len(fields)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]
    lengths = F.array(*[F.octet_length(p) for p in parts]) if fields else F.lit(None).cast("array<int>")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.concat_ws("\n", *parts) if fields else F.col("text").cast("string")).alias("text"), lengths.alias("lengths"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = _token_bytes(tokenizer)
        for batch in batches:
            for i, j in slices(batch.column(1)):
                texts = batch.column(1).slice(i, j - i)
                flat, _ = encoder(tokenizer).encode(texts)
                _, _, chunk = next(chunks(texts, 1 << 62))
                b = chunk.b
                if n_fields:
                    size = np.array(batch.column(2).slice(i, j - i).to_pylist(), np.int64) + 1
                    borders = (chunk.edge[:-1, None] + np.concatenate([np.zeros((j - i, 1), np.int64), np.cumsum(size, 1)[:, :-1]], 1)).reshape(-1)
                    doc = np.repeat(np.arange(j - i), n_fields)
                else:
                    newline = np.flatnonzero(b == 10) + 1
                    inner = newline[~np.isin(newline, chunk.edge)]
                    borders, doc = np.concatenate([chunk.edge[:-1], inner]), np.concatenate([np.arange(j - i), np.searchsorted(chunk.edge, inner, "right") - 1])
                    order = np.lexsort((borders, doc))
                    borders, doc = borders[order], doc[order]
                end = np.cumsum(sizes[flat])
                start = end - sizes[flat]
                owner, crosses = owners(start, end, borders, rule)
                chars = np.zeros(len(b) + 1, np.int64)
                np.cumsum((b & 0xC0) != 0x80, out=chars[1:])
                first = np.searchsorted(doc, np.arange(j - i))
                stops = np.append(borders[1:], len(b))
                columns = [batch.column(0).slice(i, j - i).take(pa.array(doc)), (np.arange(len(doc)) - first[doc]).astype(np.int32), chars[borders] - chars[chunk.edge[doc]], chars[stops] - chars[chunk.edge[doc]], np.bincount(owner, minlength=len(doc)), np.bincount(owner[crosses], minlength=len(doc))]
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names=[x.split()[0] for x in COUNTS.split(", ")])

    return rows.mapInArrow(count, COUNTS)
