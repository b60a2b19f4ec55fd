"""Quality rules: base counts, and divergence from the language's reference.

Base counts of a text's words (maximal runs of characters other than space and 0x09-0x0D) and lines decide base_failed:
fewer than MIN_WORDS words, or more than half of the words in 3-word windows that occur twice or more.

The method compares three histograms of a document with those of all documents of its language (`lang`) that don't fail
the base rules: of its characters by class (Unicode categories), of its words by the kind of their first character, and of
the language's common words: the N_COMMON words of letters alone that most of its documents hold (ties: the lesser word).
The distance is Jensen-Shannon's (the root of the divergence to base 2, 0 to 1). A document is rejected whose class
distance exceeds MAX_CLASS, whose kind distance exceeds MAX_KIND, or whose word distance exceeds
WORD_LIMIT[0] + WORD_LIMIT[1] / sqrt(n_words), as few words scatter more. Short documents' histograms say little: below
MIN_CHARS characters no class distance, below MIN_WORDS words neither of the others is taken, and the rule does not apply.
The limits lie between the labelled good and bad documents of the sf0.1 tables.

A language with fewer than MIN_REFERENCE such documents has no reference: its documents have no class and no word
distance, and their kinds, which don't depend on the script, are compared with those of all languages' documents.

A null text is empty (base_failed); a null language is one language. Rows are judged one by one: repeated rows and null
doc_ids get rows of their own, extra columns are ignored, an empty table gives an empty result. Texts are taken whole; a
task holds a long one by itself.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caesura.llm.store import materialize
from caesura.llm.vec import LOWER, Chunk, Ranges, U, chunks, mix

MIN_WORDS, MAX_REPEATED = 50, 50
MIN_CHARS, MIN_REFERENCE, N_COMMON = 200, 20, 24
MAX_CLASS, MAX_KIND, WORD_LIMIT = 0.3, 0.25, (0.15, 1.6)
#: So many languages' words and references (under 1 kB each) are sent to all executors; of more, the joins shuffle.
BROADCAST_LANGUAGES = 10_000
SYMBOLS = b"#*$%&|<>"
#: Character classes by Unicode category; any other character is of class 6.
CLASSES = (("Ll",), ("Lu", "Lt"), ("Lo", "Lm", "Mn", "Mc", "Me"), ("Nd", "Nl", "No"), ("Pc", "Pd", "Ps", "Pe", "Pi", "Pf", "Po"), ("Sm", "Sc", "Sk", "So"))
#: Punctuation by category that counts as symbols, as markup and code are made of it.
MARKS = "#%&*/@[\\]_{}"
LETTERS, PUNCTUATION, SYMBOL = 2, 4, 5  # classes up to LETTERS are letters
N_CLASS = len(CLASSES) + 1
N_KIND = N_CLASS - LETTERS  # a word's kind is its first character's class, letters being one
FEATURES = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, classes array<long>, kinds array<long>, common array<long>"


@functools.cache
def _class_table() -> np.ndarray:
    """The class of every code point."""
    number = {category: k for k, members in enumerate(CLASSES) for category in members}
    table = np.array([number.get(unicodedata.category(chr(c)), len(CLASSES)) for c in range(0x110000)], np.uint8)
    table[[ord(c) for c in MARKS]] = SYMBOL
    return table


def _char_classes(b: np.ndarray) -> np.ndarray:
    """By byte: the class of the character that begins there (of other bytes, nothing)."""
    table = _class_table()
    found = table[b]
    at = np.flatnonzero(b >= 0xC0)
    if len(at):
        lead = b[at].astype(np.int32)
        tail = [b[np.minimum(at + k, len(b) - 1)].astype(np.int32) & 0x3F for k in (1, 2, 3)]
        two, three, four = (lead & 0x1F) << 6 | tail[0], (lead & 0x0F) << 12 | tail[0] << 6 | tail[1], (lead & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2]
        found[at] = table[np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four))]
    return found


def _by_doc(doc: np.ndarray, what: np.ndarray, n: int, kinds: int) -> np.ndarray:
    return np.bincount(doc * kinds + what, minlength=n * kinds).reshape(n, kinds)


def _in_doc(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mix(h + doc.astype(U) * U(0x9E3779B97F4A7C15))


def _later(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each hash occurred earlier in its text, and whether it occurs twice or more there."""
    key = _in_doc(h, doc)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    later, twice = np.zeros(len(h), bool), np.zeros(len(h), bool)
    later[order[1:]] = same
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return later, twice


def common_words(docs: DataFrame) -> DataFrame:
    """language, listed: its N_COMMON words of letters alone that most documents hold, in that order. Words are counted by chunk, by task, and then summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, chunk in chunks(batch.column(1)):
                chunk.words()
                lang = batch.column(0).slice(i, j - i).dictionary_encode(null_encoding="encode")
                code = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                other = np.concatenate([[0], np.cumsum(((chunk.b & 0xC0) != 0x80) & (_char_classes(chunk.b) > LETTERS))])
                plain = np.flatnonzero(other[chunk.end] == other[chunk.start])
                _, once = np.unique(_in_doc(chunk.hash[plain], chunk.doc[plain]), return_index=True)
                plain = plain[once]
                _, at, n = np.unique(_in_doc(chunk.hash[plain], code[chunk.doc[plain]]), return_index=True, return_counts=True)
                at, low = plain[at], LOWER[chunk.b].tobytes()
                words = pa.array([low[a:z] for a, z in zip(chunk.start[at], chunk.end[at], strict=True)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([lang.dictionary.take(pa.array(code[chunk.doc[at]])).cast(pa.string()), words, pa.array(n.astype(np.int64))], names=["language", "word", "n"])

    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    total = rows.mapInArrow(count, "language string, word string, n long").groupBy("language", "word").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("language").orderBy(F.desc("n"), "word"))
    first = total.withColumn("place", place).where(F.col("place") <= N_COMMON)
    return first.groupBy("language").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]).alias("listed"))


def _small(known: DataFrame) -> DataFrame:
    return F.broadcast(known) if known.count() <= BROADCAST_LANGUAGES else known


def features(docs: DataFrame, listed: DataFrame, carry: bool = False) -> DataFrame:
    """Counts and histograms by document (with its row, all columns as they are, if carried), given the languages' common words."""
    place = docs.columns.index("text") if carry else 0
    symbol = np.isin(np.arange(256), list(SYMBOLS))

    def listed_counts(chunk: Chunk, words: pa.ListArray) -> np.ndarray:
        """How often each text holds each of its language's words."""
        size = np.nan_to_num(words.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
        doc = np.repeat(np.arange(chunk.n), size)
        slot = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
        data = [w.encode() for w in words.flatten().to_pylist()]
        edge = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
        key = _in_doc(Ranges(np.frombuffer(b"".join(data), np.uint8)).hash(edge[:-1], edge[1:]), doc)
        out = np.zeros((chunk.n, N_COMMON), np.int64)
        if len(key) and len(chunk.hash):
            order, own = np.argsort(key), _in_doc(chunk.hash, chunk.doc)
            at = order[np.minimum(np.searchsorted(key[order], own), len(key) - 1)]
            hit = at[key[at] == own]
            out += _by_doc(doc[hit], slot[hit], chunk.n, N_COMMON)
        return out

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, chunk in chunks(batch.column(3).field(place) if carry else batch.column(3)):
                chunk.words()
                n, b = chunk.n, chunk.b
                head = (b & 0xC0) != 0x80
                char, kind = np.flatnonzero(chunk.solid & head), _char_classes(b)
                classes = _by_doc(np.repeat(np.arange(n), np.diff(chunk.edge))[char], kind[char], n, N_CLASS)
                kinds = _by_doc(chunk.doc, np.maximum(kind[chunk.start], LETTERS) - np.int64(LETTERS), n, N_KIND)
                common = listed_counts(chunk, batch.column(2).slice(i, j - i))
                # 3-word windows, and the words that repeated ones cover
                size = np.diff(chunk.first)
                count = np.maximum(size - 2, 0)
                pos = np.arange(count.sum()) + np.repeat(chunk.first[:-1] - (np.cumsum(count) - count), count)
                raw = chunk.raw()
                three = mix(mix(raw[pos] * U(3) + raw[pos + 1]) * U(5) + raw[pos + 2]) if len(pos) else raw[:0]
                _, twice = _later(chunk.doc[pos], three)
                covered = np.zeros(len(chunk.start) + 3, bool)
                for k in range(3):
                    covered[pos[twice] + k] = True
                # lines with a word
                stop = np.flatnonzero(b == 10)
                begin = np.sort(np.concatenate([chunk.edge[:-1][size >= 0], stop + 1]))
                begin = begin[begin < len(b)]
                begin = begin[np.concatenate([[True], np.diff(begin) > 0])] if len(begin) else begin
                finish = np.append(begin[1:], len(b)) if len(begin) else begin
                finish = finish - (b[finish - 1] == 10) if len(begin) else finish
                line_doc = np.searchsorted(chunk.edge, begin, "right") - 1
                solid = np.concatenate([[0], np.cumsum(chunk.solid)])
                full = solid[finish] > solid[begin]
                begin, finish, line_doc = begin[full], finish[full], line_doc[full]
                again, _ = _later(line_doc, Ranges(b).hash(begin, finish))
                columns = [
                    *(batch.column(k).slice(i, j - i) for k in (0, 1)), size, chunk.total(chunk.solid & head), chunk.total(symbol[b]), np.bincount(line_doc[again], minlength=n), chunk.total(covered[: len(chunk.start)], chunk.first),
                    *(pa.array(list(x.astype(np.int64)), pa.list_(pa.int64())) for x in (classes, kinds, common)), *([batch.column(3).slice(i, j - i)] * carry),
                ]
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x.astype(np.int64)) for x in columns], names=[x.split()[0] for x in FEATURES.split(", ")] + ["row"] * carry)

    text = F.struct(*docs.columns).alias("row") if carry else F.col("text").cast("string").alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text)
    joined = rows.join(_small(listed), F.col("lang").eqNullSafe(F.col("language")), "left")
    out = T._parse_datatype_string(FEATURES)
    return joined.select("doc_id", "lang", "listed", "row" if carry else "text").mapInArrow(count, out.add("row", rows.schema["row"].dataType) if carry else out)


def keep(docs: DataFrame) -> DataFrame:
    """The rows of docs that pass, with all their columns. Rows are carried beside their counts, so no text is shuffled."""
    return judge(docs, carry=True).where("kept").select("row.*")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def distance(own: Column, own_total: Column, ref: Column, ref_total: Column) -> Column:
    """Jensen-Shannon's distance of two arrays of counts. Totals are given: a sum inside the lambda would be taken anew for every element."""
    shares = F.zip_with(own, ref, lambda a, b: F.struct((a / own_total).alias("p"), (b / ref_total).alias("q")))
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    total = F.aggregate(shares, F.lit(0.0), lambda t, s: t + (part(s["p"], (s["p"] + s["q"]) / 2) + part(s["q"], (s["p"] + s["q"]) / 2)) / 2)
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def references(found: DataFrame) -> DataFrame:
    """A row a language: its documents that pass the base rules, and sums of their histograms (common words with the other words last)."""
    parts = {"classes": N_CLASS, "kinds": N_KIND, "common": N_COMMON}
    sums = [F.sum(F.col(name)[k]).alias(f"{name}{k}") for name, n in parts.items() for k in range(n)]
    total = found.where(~base_failed()).groupBy("lang").agg(F.count("*").alias("ref_docs"), F.sum("n_words").alias("ref_count"), F.sum("word_chars").alias("ref_chars"), *sums)
    array = lambda name: F.array(*[f"{name}{k}" for k in range(parts[name])])
    return total.select(F.col("lang").alias("language"), "ref_docs", "ref_count", "ref_chars", array("classes").alias("ref_classes"), array("kinds").alias("ref_kinds"), _with_rest(array("common"), F.col("ref_count")).alias("ref_words"))


def _with_rest(listed: Column, n: Column) -> Column:
    return F.concat(listed, F.array(n - F.aggregate(listed, F.lit(0).cast("long"), lambda s, x: s + x)))


def word_limit() -> Column:
    return F.lit(WORD_LIMIT[0]) + F.lit(WORD_LIMIT[1]) / F.sqrt("n_words")


def judge(docs: DataFrame, carry: bool = False) -> DataFrame:
    """A row for every row of docs: base counts, base_failed, kept, class_distance, kind_distance, word_distance (null where a guard says so)."""
    found = materialize(features(docs, materialize(common_words(docs), "words"), carry), "features")
    known = materialize(references(found), "references")
    everyone = known.agg(*[F.sum(F.col("ref_kinds")[k]) for k in range(N_KIND)]).head()  # one row of N_KIND sums
    joined = found.join(_small(known), F.col("lang").eqNullSafe(F.col("language")), "left")
    own = F.coalesce(F.col("ref_docs") >= MIN_REFERENCE, F.lit(False))
    all_kinds = F.array(*[F.lit(x).cast("long") for x in everyone])
    kinds = F.when(own, F.col("ref_kinds")).otherwise(all_kinds)
    kind_total = F.when(own, F.col("ref_count")).otherwise(F.lit(sum(x or 0 for x in everyone)).cast("long"))
    apart = joined.withColumns({
        "class_distance": F.when(own & (F.col("word_chars") >= MIN_CHARS), distance(F.col("classes"), F.col("word_chars"), F.col("ref_classes"), F.col("ref_chars"))),
        "kind_distance": F.when((kind_total > 0) & (F.col("n_words") >= MIN_WORDS), distance(F.col("kinds"), F.col("n_words"), kinds, kind_total)),
        "word_distance": F.when(own & (F.col("n_words") >= MIN_WORDS), distance(_with_rest(F.col("common"), F.col("n_words")), F.col("n_words"), F.col("ref_words"), F.col("ref_count"))),
        "base_failed": base_failed(),
    })
    within = lambda name, most: F.coalesce(F.col(name) <= most, F.lit(True))
    kept = ~F.col("base_failed") & within("class_distance", F.lit(MAX_CLASS)) & within("kind_distance", F.lit(MAX_KIND)) & within("word_distance", word_limit())
    rounded = [F.round(name, 4).alias(name) for name in ("class_distance", "kind_distance", "word_distance")]
    return apart.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), *rounded, *["row"] * carry)
