"""Token-ID output: documents as compressed id arrays in one binary format, each readable on its own.

A zstandard dictionary is trained on the serialized ids of a bounded sample of documents; every document is then
compressed separately with it. Documents lie in ascending doc_id order in shards, a shard being one binary value:

    magic CTOK1, one byte id width, 8 bytes dictionary hash, u32 number of documents, then by document
    i64 doc_id, i64 n_tokens, i64 offset of its frame, one i64 end of the last frame, and the frames.

All numbers are little-endian. Shards are rows of a Parquet table (so Spark's committer handles lost executors, and
any store that Spark reaches will do), the dictionary is another one beside it.

Nulls: a null text counts as empty (only the end id); a null doc_id sorts first and is stored with a flag value.
Repeated doc_ids are ordered by a hash of the text, then the text. An empty table gives an empty store. Extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caesura.llm import store
from caesura.llm.tokens import encoder, slices

MAGIC, HEAD, NO_ID = b"CTOK1", "<5sB8sI", -(2**63)
SHARD_BYTES = 4_000_000
LEVEL = 3


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, sample_docs: int = 400, max_chars: int = 20_000, size: int = 32_768) -> bytes:
    """A zstandard dictionary from the ids of sample_docs documents of max_chars characters or fewer, picked by a hash.

    The bound on the sample is fixed, whatever the size of the corpus. With too few samples the dictionary is empty.
    """
    import zstandard

    mark = F.xxhash64(F.lit(3), "doc_id", "text")
    some = docs.where((F.length("text") <= max_chars) & (F.pmod(mark, F.lit(max(docs.count(), 1))) < 4 * sample_docs))  # some 4 times as many as wanted
    texts = some.orderBy(mark).limit(sample_docs).select("text").toArrow()["text"].combine_chunks()
    ids, edge = encoder(tokenizer).encode(texts) if len(texts) else (np.zeros(0, np.uint32), [0])
    width = _width(tokenizer, end_id)
    parts = [ids[a:b].astype(f"<u{width}").tobytes() + end_id.to_bytes(width, "little") for a, b in zip(edge[:-1], edge[1:], strict=True)]
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except zstandard.ZstdError:
        return b""


def _width(tokenizer: str, end_id: int) -> int:
    return 2 if max(encoder(tokenizer).whole.get_vocab_size() - 1, end_id) < 65_536 else 4


def dictionary_hash(data: bytes) -> bytes:
    import xxhash

    return xxhash.xxh64(data).digest()


def _codec(data: bytes):
    import zstandard

    shared = {"dict_data": zstandard.ZstdCompressionDict(data)} if data else {}
    return zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_dict_id=False, **shared), zstandard.ZstdDecompressor(**shared)


def _shard(ids: list[int], counts: list[int], frames: list[bytes], width: int, mark: bytes) -> bytes:
    offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<i8")
    return b"".join([struct.pack(HEAD, MAGIC, width, mark, len(ids)), np.array(ids, "<i8").tobytes(), np.array(counts, "<i8").tobytes(), offsets.tobytes(), *frames])


def open_shard(blob: bytes) -> tuple[int, bytes, np.ndarray, np.ndarray, np.ndarray, int]:
    """(id width, dictionary hash, doc_ids, n_tokens, frame offsets, where frames begin)"""
    magic, width, mark, n = struct.unpack_from(HEAD, blob)
    if magic != MAGIC:
        raise ValueError("not a token shard")
    at = struct.calcsize(HEAD)
    ids, counts = (np.frombuffer(blob, "<i8", n, at + k * 8 * n) for k in (0, 1))
    return width, mark, ids, counts, np.frombuffer(blob, "<i8", n + 1, at + 16 * n), at + 8 * (3 * n + 1)


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, partitions: int | None = None) -> None:
    """Encodes text, appends end_id to each document and writes the store to path (a new folder)."""
    spark = docs.sparkSession
    data = train_dictionary(docs, tokenizer, end_id)
    mark_of = dictionary_hash(data)
    spark.createDataFrame([(bytearray(mark_of), bytearray(data))], "dict_hash binary, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def write_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, pack, width = TaskContext.get().partitionId(), _codec(data)[0], _width(tokenizer, end_id)
        ids, counts, frames, held, shard = [], [], [], 0, 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([sum(counts)], pa.int64()), pa.array([min(ids)], pa.int64()), pa.array([max(ids)], pa.int64()), pa.array([_shard(ids, counts, frames, width, mark_of)], pa.binary())], names=SHARDS.fieldNames())

        for batch in batches:
            texts, keys = batch.column(1), batch.column(0).fill_null(NO_ID).to_numpy()
            for i, j in slices(texts):
                flat, edge = encoder(tokenizer).encode(texts.slice(i, j - i))
                flat = flat.astype(f"<u{width}")
                for k in range(j - i):
                    frame = pack.compress(flat[edge[k] : edge[k + 1]].tobytes() + end_id.to_bytes(width, "little"))
                    ids.append(int(keys[i + k])), counts.append(int(edge[k + 1] - edge[k]) + 1), frames.append(frame)
                    held += len(frame)
                    if held >= SHARD_BYTES:
                        yield row()
                        ids, counts, frames, held, shard = [], [], [], 0, shard + 1
        if ids:
            yield row()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    mark = F.xxhash64("text")  # Spark samples the columns of a range on the driver: so no texts
    ordered = rows.withColumn("mark", mark).repartitionByRange(*[partitions] * bool(partitions), "doc_id", "mark").sortWithinPartitions("doc_id", "mark", "text")
    store.write(ordered.select("doc_id", "text").mapInArrow(write_rows, SHARDS), f"{path}/shards")


SHARDS = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("shard", T.IntegerType()), T.StructField("n_docs", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("first_id", T.LongType()), T.StructField("last_id", T.LongType()), T.StructField("blob", T.BinaryType())])


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").head()["dictionary"])


def read_store(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, the ids of every document.

    Starts come from the shards' own counts: sums by write partition (a row each) are put in order, and shards in theirs.
    """
    from pyspark.sql import Window

    data = read_dictionary(spark, path)
    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards")
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()  # as many rows as tasks wrote
    before = dict(zip((r["part"] for r in parts), np.concatenate([[0], np.cumsum([r["n"] for r in parts])]).tolist(), strict=False))
    base = spark.createDataFrame([(p, n) for p, n in before.items()], "part int, base long")
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    place = shards.select("part", "shard", "n_tokens").withColumn("inside", F.coalesce(inside, F.lit(0))).join(base, "part").select("part", "shard", (F.col("base") + F.col("inside")).alias("first"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, mark = _codec(data)[1], dictionary_hash(data)
        for batch in batches:
            for first, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                blob = blob.as_py()
                width, own, keys, counts, offsets, at = open_shard(blob)
                if own != mark:
                    raise ValueError("the shard was written with another dictionary")
                crc, lists = [], []
                for k in range(len(keys)):
                    x = np.frombuffer(unpack.decompress(blob[at + offsets[k] : at + offsets[k + 1]], max_output_size=int(counts[k]) * width), f"<u{width}").astype("<u4")
                    crc.append(zlib.crc32(x.data))
                    if ids:
                        lists.append(x)
                starts = first + np.concatenate([[0], np.cumsum(counts)[:-1]])
                columns = [pa.array(keys, pa.int64(), mask=keys == NO_ID), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array([x.astype(np.int64) for x in lists], pa.list_(pa.int64()))] * ids, names=["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * ids)

    out = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids
    return shards.select("part", "shard", "blob").join(place, ["part", "shard"]).select("first", "blob").mapInArrow(read, out)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[int] | None:
    """The ids of one document: only shards with such ids are read, and only its frame is decompressed."""
    unpack = _codec(read_dictionary(spark, path))[1]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                blob = blob.as_py()
                width, _, keys, counts, offsets, at = open_shard(blob)
                for k in np.flatnonzero(keys == doc_id):
                    frame = blob[at + offsets[k] : at + offsets[k + 1]]
                    yield pa.RecordBatch.from_arrays([pa.array([frame]), pa.array([int(counts[k])]), pa.array([width])], names=["frame", "n", "width"])

    found = spark.read.schema(SHARDS).parquet(f"{path}/shards").where(F.lit(doc_id).between(F.col("first_id"), F.col("last_id"))).select("blob").mapInArrow(find, "frame binary, n long, width long").head()
    return None if found is None else np.frombuffer(unpack.decompress(bytes(found["frame"]), max_output_size=found["n"] * found["width"]), f"<u{found['width']}").tolist()
