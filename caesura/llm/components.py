"""Connected components of a table of links, by repeated minimum labels and pointer jumping."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caesura.llm.store import discard, materialize


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one partition as links of each node with the least it reaches there: fewer, and shorter paths."""
    part: dict[int, int] = {}

    def top(x: int) -> int:
        part.setdefault(x, x)
        while part[x] != x:
            part[x] = x = part[part[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = top(a), top(b)
            part[max(x, y)] = min(x, y)
    nodes = [x for x in part if top(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([top(x) for x in nodes], pa.int64())], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """node, label for every node of links (a, b): the least node reachable. Nothing is collected; each round is a shared table.

    First each partition joins what its own links join. A round takes each node to the least label of its neighbours and on to that label's own, so paths halve.
    """
    few = materialize(links.select("a", "b").mapInArrow(contract, "a long, b long"), "links")
    pairs = materialize(few.unionByName(few.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "pairs")
    discard(few)
    labels = materialize(pairs.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = pairs.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        moved = labels.join(near, "node", "left").select("node", "label", F.least("label", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("on"))
        after = materialize(moved.join(jump, "to", "left").select("node", F.least("to", "on").alias("label"), (F.least("to", "on") < F.col("label")).alias("new")), "labels")
        discard(labels)
        labels = after.select("node", "label")
        if after.where("new").head() is None:
            discard(pairs)
            return labels
