"""Packing token sequences by cutting-stock column generation.

Documents are encoded, ended with end_id and cut into pieces of CAPACITY ids and a rest. Rests are counted by length,
rounded up (size_class): the shortest not at all, longer ones by a small share of their length, so that neither many
short nor many long pieces leave much room. The linear program over packing patterns of these classes is solved by column generation:
a knapsack dynamic program over the capacity prices new patterns with the duals until none is worth its sequence.
Patterns are used a rounded-down number of times, what remains is placed best-fit decreasing, and pieces, ranked in
their class, take the patterns' places in order. The histogram and the patterns have at most CAPACITY / 7 classes,
whatever the size of the corpus; ranks are counts by task plus sums over tasks, so no class meets in one task.

A null text counts as empty and is one piece, the end id. Repeated rows and null doc_ids are documents like others.
Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caesura.llm.store import materialize
from caesura.llm.tokens import encoder, slices

CAPACITY = 1024
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, size int, part int, rank long"


def size_class(length: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Lengths rounded up: exact to a 32nd of the capacity, by 4 to an 8th, by 8 to the half, by 16 above; never over the capacity."""
    step = np.select([length <= capacity // 32, length <= capacity // 8, length <= capacity // 2], [1, 4, 8], 16)
    return np.minimum(-(-length // step) * step, capacity)


def price(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of greatest worth: an unbounded knapsack by dynamic programming over the capacity."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes, kind="stable")
    sizes_in, worth_in = sizes[order], worth[order]
    for c in range(1, capacity + 1):
        n = int(np.searchsorted(sizes_in, c, "right"))
        best[c], pick[c] = best[c - 1], -1
        if n:
            value = worth_in[:n] + best[c - sizes_in[:n]]
            k = int(value.argmax())
            if value[k] > best[c] + 1e-12:
                best[c], pick[c] = value[k], order[k]
    pattern, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            pattern[pick[c]] += 1
            c -= int(sizes[pick[c]])
    return float(best[capacity]), pattern


def patterns(demand: dict[int, int], capacity: int, rounds: int = 1_500) -> list[tuple[int, Counter]]:
    """(times, {size: count}) that together hold exactly the demand of each size, none over the capacity."""
    sizes = np.array(sorted((s for s, n in demand.items() if n > 0), reverse=True), np.int64)
    if not len(sizes):
        return []
    need = np.array([demand[int(s)] for s in sizes], float)
    basis = np.diag((capacity // sizes).astype(float))
    inverse, use = np.linalg.inv(basis), need / (capacity // sizes)
    cost = np.ones(len(sizes))
    center, bound, pull = sizes / capacity, float(need @ sizes) / capacity, 0.9  # of the duals: the best so far, and its bound on sequences
    for step in range(rounds):
        if cost @ use - bound < max(0.5, 0.0005 * bound):
            break
        duals = cost @ inverse
        if duals.min() < -1e-9:  # making more of this size than asked for is free
            column, price_in = np.zeros(len(sizes)), 0.0
            column[duals.argmin()] = -1
        for weight in (pull, 0.5, 0.0) if duals.min() >= -1e-9 else ():  # pricing near the center keeps the duals from swinging
            mixed = weight * center + (1 - weight) * duals
            value, column = price(sizes, mixed, capacity)
            if (lower := float(need @ mixed) / max(value, 1e-12)) > bound:
                center, bound = mixed / value, lower
            price_in = 1.0
            if column @ duals > 1 + 1e-7:
                break
        else:
            if duals.min() >= -1e-9:
                break
        way = inverse @ column
        ratio = np.where(way > 1e-9, use / np.where(way > 1e-9, way, 1), np.inf)
        out = int(ratio.argmin())
        use = np.maximum(use - ratio[out] * way, 0)
        use[out] = ratio[out]
        basis[:, out], cost[out] = column, price_in
        if step % 50 == 49:
            inverse = np.linalg.inv(basis)
            use = np.maximum(inverse @ need, 0)
        else:
            row = inverse[out] / way[out]
            inverse -= np.outer(way, row)
            inverse[out] = row
    left, found = need.astype(np.int64), []
    for k in np.argsort(-use):
        column = basis[:, k].astype(np.int64)
        held = column > 0
        if not cost[k]:
            continue
        times = int(min(np.floor(use[k] + 1e-6), (left[held] // column[held]).min()))
        if times > 0:
            left -= times * column
            found.append((times, Counter({int(sizes[i]): int(column[i]) for i in np.flatnonzero(held)})))
    rooms: list[list[Counter]] = [[] for _ in range(capacity + 1)]  # the open sequences, by what room they have
    for i, size in enumerate(sizes.tolist()):
        for _ in range(int(left[i])):
            room = next((r for r in range(size, capacity + 1) if rooms[r]), None)
            held = Counter() if room is None else rooms[room].pop()
            held[size] += 1
            rooms[(capacity if room is None else room) - size].append(held)
    return found + [(1, held) for x in rooms for held in x]


def cut(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """A row a piece, with its class (size), the task that made it and its rank in the class there; with ids, the ids as well."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for i, j in slices(batch.column(1)):
                flat, edge = encoder(tokenizer).encode(batch.column(1).slice(i, j - i))
                total = np.diff(edge) + 1
                count = -(-total // capacity)
                row = np.repeat(np.arange(j - i), count)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * capacity
                length = np.minimum(total[row] - start, capacity)
                size = size_class(length, capacity)
                order = np.argsort(size, kind="stable")
                first = np.searchsorted(size[order], np.arange(len(seen)))
                rank = np.empty(len(row), np.int64)
                rank[order] = np.arange(len(row)) - first[size[order]] + seen[size[order]]
                seen += np.bincount(size, minlength=len(seen))
                flat = np.insert(flat, edge[1:], end_id).astype("<u4")
                at = edge[row] + row + start
                own = [flat[a:b] for a, b in zip(at, at + length, strict=True)]
                columns = [batch.column(0).slice(i, j - i).take(pa.array(row)), pa.array(start), pa.array(length), pa.array([zlib.crc32(x.data) for x in own], pa.int64()), pa.array(total[row])]
                columns += [pa.array(size.astype(np.int32)), pa.array(np.full(len(row), part, np.int32)), pa.array(rank)] + [pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64()))] * ids
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in PIECES.split(", ")] + ["ids"] * ids)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(pieces, PIECES + ", ids array<long>" * ids)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """A row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    pieces = materialize(cut(docs, tokenizer, end_id, capacity, ids), "pieces")
    counts = materialize(pieces.groupBy("size", "part").agg(F.count("*").alias("n")), "counts")
    demand = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}  # at most capacity / 7 rows
    full = demand.pop(capacity, 0)
    plan = [(full, Counter({capacity: 1}))] * bool(full) + patterns(demand, capacity)
    ranges: dict[int, list[tuple[int, int, int, int]]] = {}  # by size: first rank, places a sequence, first sequence, first place
    given, base = Counter(), 0
    for times, held in plan:
        place = 0
        for size in sorted(held, reverse=True):
            ranges.setdefault(size, []).append((given[size], held[size], base, place))
            given[size] += times * held[size]
            place += held[size]
        base += times
    tables = {s: np.array(x, np.int64) for s, x in ranges.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = batch.column("size").to_numpy(), batch.column("before").to_numpy() + batch.column("rank").to_numpy()
            sequence, place = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for s in np.unique(size):
                own, table = np.flatnonzero(size == s), tables[int(s)]
                first, each, start, slot = table[np.searchsorted(table[:, 0], rank[own], "right") - 1].T
                sequence[own], place[own] = start + (rank[own] - first) // each, slot + (rank[own] - first) % each
            kept = [batch.schema.get_field_index(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * ids)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), pa.array(sequence), pa.array(place)], names=[*(batch.schema.names[k] for k in kept), "sequence_id", "place"])

    before = F.coalesce(F.sum("n").over(Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    based = pieces.join(counts.select("size", "part", before.alias("before")), ["size", "part"])
    out = based.mapInArrow(assign, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<long>" * ids + ", sequence_id long, place long")
    offset = F.coalesce(F.sum("length").over(Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return out.withColumn("offset", offset).drop("place")
