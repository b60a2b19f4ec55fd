"""Sharding by a two-pass external shuffle, with DataFrame functions only.

Pass 1 scatters every record by seeded hashes: rendezvous hashing of (doc_id, shard) picks the shard, a hash of
doc_id and text picks one of the shard's buckets, whose number follows from the total size, so that a bucket fits in
memory at any size of the corpus. Pass 2 puts each bucket into the order of seeded 64-bit keys of its rows and writes it. That
is a uniform permutation, as a Fisher-Yates pass draws it; Spark's own shuffle() is not used, as it is seeded by the number
of a partition, and places would depend on the layout of the cluster. So order is a function of the seed and the rows alone,
and a bucket is sorted, with spilling, and not collected. A bucket's place in its shard is the count of those before it.

Law `key`: doc_id and the number of shards decide the shard, and one more shard takes rows only into itself: a row's
hash with each old shard stays, so its greatest changes only if the new shard's is greater.

A null doc_id is a key like any other; a null text counts as empty in size and crc32; equal rows stay apart, each with
its own slot. An empty table gives none. Long texts are rows like others. All other columns are carried along; only columns
named shard, bucket or pos give way to the ones added (and slot, when shards are read).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caesura.llm.store import write

BUCKET_BYTES = 16_000_000
#: So many buckets' places (16 bytes each) are sent to all executors; more are joined by a shuffle.
BROADCAST_BUCKETS = 500_000
#: The second pass has a task a bucket, up to this many tasks.
MOST_TASKS = 20_000


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """The shard with the greatest seeded hash (rendezvous hashing)."""
    scored = [F.struct(F.xxhash64(F.lit(seed), key, F.lit(k)).alias("h"), F.lit(k).alias("k")) for k in range(shards)]
    return (F.greatest(*scored) if shards > 1 else scored[0])["k"]


def write_shards(docs: DataFrame, path: str, shards: int = 8, seed: int = 7, bucket_bytes: int = BUCKET_BYTES) -> None:
    """The rows of docs in shuffled order below path, with shard, bucket and pos (inside the bucket)."""
    rows = docs.drop("shard", "bucket", "pos", "slot").withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    total = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 32)).head()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    scattered = rows.withColumns({"shard": shard_of(F.col("doc_id"), shards, seed), "bucket": F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "text"), F.lit(buckets)).cast("int")})
    order = Window.partitionBy("shard", "bucket").orderBy(F.xxhash64(F.lit(seed + 2), "doc_id", "text"), "doc_id", F.xxhash64(F.lit(seed + 3), "text"))
    placed = scattered.repartition(int(min(shards * buckets, MOST_TASKS)), "shard", "bucket").withColumn("pos", F.row_number().over(order) - 1)
    write(placed, path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The rows of write_shards (but for a column named first) with slot, the place in the shard, gapless from 0."""
    rows = spark.read.parquet(path)
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    places = counts.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("first"))
    if counts.count() <= BROADCAST_BUCKETS:  # else the join shuffles
        places = F.broadcast(places)
    carried = [c for c in rows.columns if c not in ("shard", "bucket", "pos", "first")]
    return rows.join(places, ["shard", "bucket"]).select("shard", (F.col("first") + F.col("pos")).alias("slot"), *carried)
