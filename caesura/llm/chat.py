"""Chat formatting: every assistant turn becomes an example of its own, with all preceding turns as context.

A conversation is laid out once, turn by turn, as

    <|im_start|>role\\ntext<|im_end|>\\n

and an example is a prefix of that layout: it ends after its target turn and only the target's text is trainable.
Two tables are written: the turns of the layout, and a row an example, with offsets into the layout and the SHA-256 of its
context (all before the target's text), so that a conversation of n turns costs n rows and not n*n texts. Readers check
the context of every example against that hash; render() writes examples out in full.

Control strings inside texts and roles are made harmless reversibly: in every `<\\...\\|` (any number of backslashes)
one backslash is added. A role also has its backslashes and newlines written as \\\\ and \\n.

Rows are taken by (conv_id, turn, role, text), nulls first, so ties have one order; a null text or role counts as
empty, null conv_ids are one conversation. Repeated rows stay. An empty table gives empty outputs; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caesura.llm.store import write

START, END = "<|im_start|>", "<|im_end|>\n"
TURNS = "conv_id long, seq long, formatted string, char_start long, target_start long, target_end long, example long, context_sha256 string"
EXAMPLES = ("conv_id", "example", "context_end", "target_start", "target_end", "context_sha256", "seq")
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn's layout, and from where to where its text goes."""
    head = f"{START}{escape(role.replace(chr(92), chr(92) * 2).replace(chr(10), chr(92) + 'n'))}\n"
    body = escape(text)
    return f"{head}{body}{END}", len(head), len(head) + len(body)


def parse_turn(formatted: str) -> tuple[str, str]:
    """(role, text) as they were."""
    if not formatted.startswith(START) or not formatted.endswith(END):
        raise ValueError("not a formatted turn")
    head, _, body = formatted[len(START) : -len(END)].partition("\n")
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(head)), unescape(body)


def prefix_hash(before: hashlib._Hash, more: str) -> str:
    """The digest of what before has taken, and more; before stays as it is."""
    whole = before.copy()
    whole.update(more.encode())
    return whole.hexdigest()


def _ordered(rows: DataFrame, *order: str) -> DataFrame:
    """All rows of a conversation in one partition, in order; they stream through, so a long one needs no memory."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_conversations(conversations: DataFrame, target_role: str = "assistant") -> DataFrame:
    """A row a turn: its layout, where that begins in the conversation's, and, for a target turn, the example's number, trainable span and its context's hash."""

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seq, at, example, before = object(), 0, 0, 0, hashlib.sha256()
        for batch in batches:
            out = []
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if conv != now:
                    now, seq, at, example, before = conv, 0, 0, 0, hashlib.sha256()
                formatted, a, b = format_turn(role or "", text or "")
                target = role == target_role
                out.append((conv, seq, formatted, at, *((at + a, at + b, example, prefix_hash(before, formatted[:a])) if target else (None,) * 4)))
                before.update(formatted.encode())
                seq, at, example = seq + 1, at + len(formatted), example + target
            kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], k) for k in kinds], names=[x.split()[0] for x in TURNS.split(", ")])

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"), F.col("turn").cast("long").alias("turn"))
    return _ordered(rows, "turn", "role", "text").select("conv_id", "role", "text").mapInArrow(lay_out, TURNS)


def write_examples(conversations: DataFrame, path: str, target_role: str = "assistant") -> None:
    """The layout's turns at path/turns, and a row an example at path/examples."""
    write(format_conversations(conversations, target_role), f"{path}/turns")
    turns = conversations.sparkSession.read.parquet(f"{path}/turns")
    write(turns.where("example IS NOT NULL").withColumn("context_end", F.col("target_start")).select(*EXAMPLES), f"{path}/examples")


def examples(spark: SparkSession, path: str) -> DataFrame:
    """conv_id, example, context_end (= target_start), target_start, target_end, context_sha256: offsets into the conversation's layout."""
    return spark.read.parquet(f"{path}/examples")


def render(spark: SparkSession, path: str, at_most_turns: int = 200) -> DataFrame:
    """Examples as text: conv_id, example, context (everything up to the target's text), target.

    Their size is the square of a conversation's: conversations of more turns than at_most_turns are refused with an
    error, not shortened; for those use examples() and the stored layout.
    """
    turns = spark.read.parquet(f"{path}/turns")
    long = turns.groupBy("conv_id").count().where(F.col("count") > at_most_turns).head()
    if long is not None:
        raise ValueError(f"conversation {long['conv_id']} has {long['count']} turns; render() takes {at_most_turns}")
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("seq", "formatted"))).alias("all"))
    layout = whole.select("conv_id", F.array_join("all.formatted", "").alias("layout"))
    return examples(spark, path).join(layout.withColumnRenamed("conv_id", "conv"), F.col("conv_id").eqNullSafe(F.col("conv"))).select("conv_id", "example", F.expr("substring(layout, 1, int(target_start))").alias("context"), F.expr("substring(layout, int(target_start) + 1, int(target_end - target_start))").alias("target"))


def digest(spark: SparkSession, path: str) -> DataFrame:
    """By conversation, from the stored layout and examples: what a reader gets back.

    An example's row follows its target turn. Its context, hashed anew from the turns read back, must be what was written,
    and its span is what the loss covers; an example that is not so is an error.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = object(), None, []

        def close() -> None:
            if state is not None:
                n, turns, chars, loss, size, count = state
                done.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), size, count))

        def batch_of() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done, strict=True), kinds, strict=True)], names=[x.split()[0] for x in DIGEST.split(", ")])

        before, last = hashlib.sha256(), ""  # of the layout up to the last turn, and that turn
        for batch in batches:
            for conv, formatted, a, b, context in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if state is None or conv != now:
                    close()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                    before, last = hashlib.sha256(), ""
                if context is None:  # a turn
                    before.update(last.encode())
                    last = formatted
                    role, text = parse_turn(formatted)
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    state[4] += len(formatted)
                    continue
                at = state[4] - len(last)
                if prefix_hash(before, last[: a - at]) != context:
                    raise ValueError(f"conversation {conv}: an example's context is not what was written")
                target = unescape(last[a - at : b - at])
                state[2] += len(target)
                state[3].update(target.encode())
                state[5] += 1
            if done:
                yield batch_of()
                done.clear()
        close()
        if done:
            yield batch_of()

    turns = spark.read.parquet(f"{path}/turns").select("conv_id", "seq", "formatted", *(F.lit(None).cast(kind).alias(name) for name, kind in (("target_start", "long"), ("target_end", "long"), ("context_sha256", "string"))))
    rows = turns.unionByName(examples(spark, path).select("conv_id", "seq", F.lit(None).cast("string").alias("formatted"), "target_start", "target_end", "context_sha256"))
    return _ordered(rows, "seq", "context_sha256").select("conv_id", "formatted", "target_start", "target_end", "context_sha256").mapInArrow(fold, DIGEST)
