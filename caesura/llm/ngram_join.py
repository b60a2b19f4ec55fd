"""Self-join of texts by the Jaccard similarity of their word shingles, through R-trees over count vectors.

A text's set is its distinct SHINGLE-word shingles, A-Z lower-cased (the whole sequence for fewer words; empty without
words, and linked with nothing). Texts link when 100 * |A & B| >= PERCENT * |A | B|. All links count: nothing is
sampled or capped.

1. Equal sets (by 128 bits) are one class from here on, whatever the number of copies.
2. Blocks. Under any one order of all shingles, two sets that link share one of their first n - ceil(t n) + 1. The order
   puts shingles of rare words first and very frequent shingles last (two lists of bounded size, from counts over all
   texts; they only shape the order, so links never depend on them). Classes with a common first shingle are a block. What lies
   behind its place in a set bounds the overlap, so a row of a block is two integers, its size and the greatest size it can link
   with, and goes on only if the sizes of another row fit. A block that counts foretell to have more than HOT rows is laid out
   in cells of two tiles each, in which every pair of its rows still meets.
3. Count vectors. A set's shingles are hashed into groups (more for larger sets); the numbers by group are a point. The
   sum of the minima of two points' coordinates bounds their overlap from above, and so does that of the maxima of the
   points below two nodes of an R-tree.
   A block gives not its pairs but what they join: a row a class.
4. Cells. What hangs together by these rows is searched again, by trees and by finer vectors; this leaves smaller groups. Such a group
   is a cell, to which each of its sets goes once. A tree finds the pairs in it, finer vectors bound them, and the sets decide; a
   pair that links have joined already can't change the result and is left out. Groups of more than cell_bytes are dealt into
   tiles. Finer vectors meet in cells of two tiles each. For sets each tile is a cell, and a sample of one tile's size is a cell
   more, which joins most of what links; then sets that it did not join to the component with the most shingles visit the
   other tiles, and pairs of a visitor and a host decide the rest.

Repeated rows are copies. Null ids are one id and come first; a component with such a row has id null. A null text is
empty. An empty table gives an empty result; extra columns are ignored. A task holds one cell's points, or one text's set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caesura.llm.components import components
from caesura.llm.memory import give_back
from caesura.llm.store import discard, materialize
from caesura.llm.vec import Chunk, U, chunks, mix

SHINGLE, PERCENT = 4, 85
#: Rows of a block beyond which it is dealt out in tiles; rows (of up to 40 bytes) up to which a table is sent to all executors.
HOT, BROADCAST_ROWS = 50_000, 200_000
#: Sizes of the two lists that shape the order of shingles.
COMMON_WORDS, COMMON_SHINGLES = 1_000, 50_000
NODE, SMALL = 16, 32
#: The greatest count of a byte in count vectors, and in trees what stands for no bound.
FULL, BOUNDLESS = 127, 16_000
#: Bytes of sets that are compared with one another in one place.
CELL_BYTES = 24_000_000
#: Bytes of text that are worked on together.
CHUNK = 1_000_000
NO_ID = -(2**63)


def need(n, m):
    """The least overlap with which sets of these sizes link."""
    return (PERCENT * (n + m) + 99 + PERCENT) // (100 + PERCENT)


def groups_of(n: int) -> int:
    """Dimensions of a set's count vector."""
    size = 64 if n < 1_024 else 256
    while n >= 16 * size:
        size *= 2
    return size


def count_vector(s: np.ndarray, groups: int) -> np.ndarray:
    """Numbers of hashes by group, in a byte each; FULL stands for any greater number too."""
    return np.minimum(np.bincount((s & U(groups - 1)).astype(np.int64), minlength=groups), FULL).astype("u1")


def fine_groups_of(n: int) -> int:
    """Dimensions of the finer count vector."""
    return min(4_096, max(256, 1 << (n - 1).bit_length()))


def _frequent(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent words, the most frequent shingles and those shingles' counts, of those met again within a chunk of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, chunk in chunks(batch.column(0), CHUNK):
                chunk.words()
                for kind, h, least in ((0, chunk.hash, 20), (1, chunk.shingles(k, True)[0], 3)):
                    value, n = np.unique(h, return_counts=True)
                    value, n = value[n >= least], n[n >= least]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), kind, np.int32)), pa.array(value.view(np.int64)), pa.array(n)], names=["kind", "h", "n"])

    counts = docs.select("text").mapInArrow(count, "kind int, h long, n long").groupBy("kind", "h").agg(F.sum("n").alias("n"))
    counts = materialize(counts.where("n >= 20"), "frequent")

    def top(kind: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        rows = counts.where(F.col("kind") == kind).orderBy(F.desc("n"), "h").limit(most).collect()
        h = np.array([r["h"] for r in rows], np.int64).view(U)
        order = np.argsort(h)
        return h[order], np.array([r["n"] for r in rows], np.int64)[order]

    out = top(0, COMMON_WORDS)[0], *top(1, COMMON_SHINGLES)
    discard(counts)
    return out


def _among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    if not len(listed):
        return np.zeros(len(values), bool)
    return listed[np.minimum(np.searchsorted(listed, values), len(listed) - 1)] == values


def ranked(chunk: Chunk, words: np.ndarray, frequent: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes, their rank in the order (before the hash), and texts' offsets. chunk: with words."""
    h, at = chunk.shingles(k, True)
    common = np.concatenate([[0], np.cumsum(_among(chunk.hash, words))])
    count = np.diff(at)
    pos = np.arange(at[-1]) + np.repeat(chunk.first[:-1] - at[:-1], count)
    last = np.minimum(pos + k, np.repeat(chunk.first[1:], count))
    return h, (common[last] - common[pos]).astype(np.uint8) + np.uint8(8) * _among(h, frequent), at


def identity(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set of hashes, as two numbers."""
    a, b = (int(mix(s ^ U(x)).sum(dtype=U)) for x in (0xA5A5, 0x5A5A5A))
    sign = lambda x: x - 2**64 if x >= 2**63 else x
    return sign(a), sign(int(mix(np.array([b], U) + U(len(s)))[0]))


def tiled(key: np.ndarray, at: np.ndarray, own: int, frequent: np.ndarray, tiles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and places, those of hot blocks once for each cell of two tiles of which one is the set's own (by its identity)."""
    place = np.minimum(np.searchsorted(frequent, key), max(len(frequent) - 1, 0))
    many = np.where(frequent[place] == key, tiles[place], 1) if len(frequent) else np.ones(len(key), np.int64)
    if (many == 1).all():
        return key, at
    row = np.repeat(np.arange(len(key)), many)
    other = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    mine = own % many[row]
    cell = (np.minimum(mine, other) * many[row] + np.maximum(mine, other)).astype(U)
    return np.where(many[row] > 1, mix(key[row] + cell * U(0x9E3779B97F4A7C15)), key[row]), at[row]


SKETCH = "doc_id long, row_key long, a long, b long, n long, vec binary, keys array<long>, at array<int>"


def row_key() -> Column:
    """Equal for rows of equal id and text: a hash of both. A null id counts as NO_ID."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.col("text").cast("string"))


def sketches(docs: DataFrame, k: int = SHINGLE, hot: int = HOT) -> DataFrame:
    words, frequent, counts = _frequent(docs, k)
    tiles = -(-counts // hot)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, chunk in chunks(batch.column(2), CHUNK):
                chunk.words()
                h, rank, at = ranked(chunk, words, frequent, k)
                ids, sizes, vecs, keys, places = [], [], [], [], []
                for x, y in zip(at[:-1], at[1:], strict=True):
                    s, first = np.unique(h[x:y], return_index=True)
                    n = len(s)
                    sizes.append(n)
                    if not n:
                        ids.append((None, None)), vecs.append(None), keys.append([]), places.append([])
                        continue
                    ids.append(identity(s))
                    vecs.append(count_vector(s, groups_of(n)).tobytes())
                    order = np.argsort(rank[x:y][first], kind="stable")[: n - (PERCENT * n + 99) // 100 + 1]
                    key, place = tiled(s[order], np.arange(len(order), dtype=np.int32), ids[-1][0], frequent, tiles)
                    keys.append(key.view(np.int64)), places.append(place)
                columns = [*(batch.column(c).slice(i, j - i) for c in (0, 1)), *(pa.array([x[c] for x in ids], pa.int64()) for c in (0, 1)), pa.array(sizes, pa.int64()), pa.array(vecs, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SKETCH.split(", ")])

    return docs.select("doc_id", row_key().alias("row_key"), "text").mapInArrow(sketch, SKETCH)


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """cid, set (sorted hashes) and finer count vector of the classes wanted (cid, a, b, row_key), made again from a text of each."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # a task gives each set once; that another gives it too does no harm
        for batch in batches:
            for _, _, chunk in chunks(batch.column(0), CHUNK):
                chunk.words()
                h, at = chunk.shingles(k, True)
                made = {identity(s): s for s in (np.unique(h[x:y]) for x, y in zip(at[:-1], at[1:], strict=True))}
                ids, found = [i for i in made if i not in seen], [s for i, s in made.items() if i not in seen]
                seen.update(ids)
                yield pa.RecordBatch.from_arrays([*(pa.array([x[c] for x in ids], pa.int64()) for c in (0, 1)), pa.array([s.tobytes() for s in found], pa.binary()), pa.array([count_vector(s, fine_groups_of(max(len(s), 1))).tobytes() for s in found], pa.binary())], names=["a", "b", "set", "fine"])

    few = wanted.count() <= BROADCAST_ROWS
    keys = wanted.select("row_key").distinct()
    keys = F.broadcast(keys) if few else keys.hint("shuffle_hash")
    found = docs.select(row_key().alias("row_key"), "text").join(keys, "row_key", "left_semi").select("text").mapInArrow(sets, "a long, b long, set binary, fine binary")
    named = wanted.select("a", "b", "cid")
    return found.join(F.broadcast(named) if few else named, ["a", "b"]).select("cid", "set", "fine")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole blocks, over rows sorted by key; each batch out ends with the end of a block."""

    def joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        wide = pa.schema([pa.field(f.name, pa.large_binary()) if pa.types.is_binary(f.type) else f for f in table.schema])  # one chunk, whatever its size
        return table.cast(wide).combine_chunks().to_batches()[0]

    held: list[pa.RecordBatch] = []
    for batch in batches:
        key = batch.column(0).to_numpy()
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1]))  # keys ascend as signed numbers
        if cut:
            yield joined([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        elif held and held[-1].column(0)[-1].as_py() != key[0]:
            yield joined(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield joined(held)
    give_back()


def reach(n: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The greatest size of a set that one of size n can link with, if the shingle at this place is the first they share."""
    return np.minimum(((100 + PERCENT) * (n - at) - PERCENT * n) // PERCENT, 100 * n // PERCENT)


def _heads(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where blocks begin, and for each row the end of its block."""
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return head, np.repeat(np.append(head[1:], len(key)), np.diff(np.append(head, len(key))))


BLOCK = "key long, cid long, n int, most int"


def live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over key, cid, n, at sorted by key, n, cid: rows to which the sizes of another row of the block fit, with the greatest size they can link with."""
    for batch in _blocks(batches):
        key, cid, n, at = (batch.column(k).to_numpy().astype(np.int64) for k in range(4))
        most = reach(n, at)
        _, end = _heads(key)
        fits = np.zeros(len(key), bool)
        row = np.arange(len(key))
        for step in range(1, SMALL + 1):
            x = np.flatnonzero(row + step < end)
            if not len(x):
                break
            y = x + step
            good = (n[y] <= most[x]) & (n[x] <= most[y]) & (cid[x] != cid[y])
            fits[x[good]] = fits[y[good]] = True
        far = np.flatnonzero(row + SMALL + 1 < end)  # of rows that far apart only the sizes are seen
        far = far[100 * n[far] >= PERCENT * n[far + SMALL + 1]]
        fits[far] = fits[far + SMALL + 1] = True
        yield pa.RecordBatch.from_arrays([pa.array(key[fits]), pa.array(cid[fits]), pa.array(n[fits].astype(np.int32)), pa.array(most[fits].astype(np.int32))], names=[x.split()[0] for x in BLOCK.split(", ")])


def _sums(x: np.ndarray) -> np.ndarray:
    """Sums of rows of bytes up to FULL: four at a time in lanes of 16 bits, of up to 512 bytes each."""
    words = np.ascontiguousarray(x).view(U)
    out = np.zeros(len(x), np.int64)
    for i in range(0, words.shape[1], 512):
        part = words[:, i : i + 512]
        for lanes in ((part & U(0x00FF00FF00FF00FF)).sum(1, dtype=U), ((part >> U(8)) & U(0x00FF00FF00FF00FF)).sum(1, dtype=U)):
            for k in range(0, 64, 16):
                out += ((lanes >> U(k)) & U(0xFFFF)).astype(np.int64)
    return out


class Vectors:
    """Count vectors of one byte a group, those of each size in a matrix."""

    def __init__(self, blobs: pa.Array):
        blobs = blobs.cast(pa.large_binary())
        edge = np.frombuffer(blobs.buffers()[1], np.int64)[blobs.offset : blobs.offset + len(blobs) + 1]
        data = np.frombuffer(blobs.buffers()[2], np.uint8)
        self.size, self.at, self.of = np.diff(edge), np.zeros(len(blobs), np.int64), {}
        for size in np.unique(self.size).tolist():
            own = np.flatnonzero(self.size == size)
            self.at[own] = np.arange(len(own))
            self.of[size] = data if len(own) == len(blobs) and edge[0] == 0 and edge[-1] == len(data) else data[edge[own][:, None] + np.arange(size)]
            self.of[size] = self.of[size].reshape(-1, size)

    def rows(self, which: np.ndarray, size: int) -> np.ndarray:
        """The vectors of these rows, all of this size."""
        return self.of[size][self.at[which]]

    def points(self, a: int, b: int) -> np.ndarray:
        """Rows a to b as points of as many dimensions as the smallest has."""
        size = int(self.size[a:b].min())
        out = np.empty((b - a, size), np.int16)
        for own in np.unique(self.size[a:b]).tolist():
            at = np.flatnonzero(self.size[a:b] == own)
            v = self.rows(at + a, own).astype(np.int16)
            v[v == FULL] = BOUNDLESS
            out[at] = np.minimum(v.reshape(len(at), -1, size).sum(1, dtype=np.int64), BOUNDLESS) if own > size else v
        return out

    def may_link(self, a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Whether the summed minima of pairs of rows leave room for enough overlap of sets of n and m."""
        keep = np.ones(len(a), bool)
        swap = self.size[a] > self.size[b]
        p, q = np.where(swap, b, a), np.where(swap, a, b)
        shape = self.size[p] * 2**32 + self.size[q]
        for kind in np.unique(shape):
            low, high = int(kind >> 32), int(kind & (2**32 - 1))
            own = np.flatnonzero(shape == kind)
            for i in range(0, len(own), max(1, 2_000_000 // high)):
                r = own[i : i + max(1, 2_000_000 // high)]
                x, y = self.rows(p[r], low), self.rows(q[r], high)
                if high > low:  # the finer one's groups fall into the other's
                    both = np.minimum(x, y.reshape(len(r), -1, low).sum(1, dtype=np.int64)).sum(1)
                else:
                    both = _sums(np.minimum(x, y))
                short = both < need(n[r], m[r])
                short[short] = ~((x[short] == FULL).any(1) | (y[short] == FULL).any(1))
                keep[r] = ~short
        return keep


class CountTree:
    """An R-tree over points (counts by group) and set sizes, packed by size and then by the widest coordinate."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        order = np.argsort(sizes, kind="stable")
        widest = int(points.std(0).argmax()) if len(points) else 0
        slabs = [s[np.argsort(points[s, widest], kind="stable")] for s in np.array_split(order, max(1, len(order) // (NODE * NODE)))]
        self.order = np.concatenate(slabs)
        self.levels = [(points[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][0]) > 1:
            box, low, high = self.levels[-1]
            cut = np.arange(0, len(box), NODE)
            self.levels.append((np.maximum.reduceat(box, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)))

    def pairs(self, part: np.ndarray, most: np.ndarray, side: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of points that may overlap enough, that part doesn't join yet and whose sizes are not above each other's most.

        part may change from one part of the result to the next. side: only pairs of unlike sides.
        """
        top = len(self.levels) - 1
        todo = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while todo:
            level, a, b = todo.pop()
            if len(a) > 20_000:
                todo += [(level, a[20_000:], b[20_000:]), (level, a[:20_000], b[:20_000])]
                continue
            box, low, high = self.levels[level]
            if level == 0:
                x, y = self.order[a], self.order[b]
                fits = (a < b) & (part[x] != part[y]) & (low[a] <= most[y]) & (low[b] <= most[x])
                if side is not None:
                    fits &= side[x] != side[y]
            else:
                fits = np.minimum(high[a], high[b]) * 100 >= PERCENT * np.maximum(low[a], low[b])
            a, b = a[fits], b[fits]
            enough = np.zeros(len(a), bool)
            for i in range(0, len(a), 2_000):
                p, q = a[i : i + 2_000], b[i : i + 2_000]
                enough[i : i + 2_000] = np.minimum(box[p], box[q]).sum(1, dtype=np.int64) >= need(low[p], low[q])
            a, b = a[enough], b[enough]
            if not len(a):
                continue
            if level == 0:
                yield self.order[a], self.order[b]
                continue
            steps = np.arange(NODE)
            a, b = (x.reshape(-1) for x in np.broadcast_arrays((a * NODE)[:, None, None] + steps[:, None], (b * NODE)[:, None, None] + steps[None, :]))
            inside = (a < len(self.levels[level - 1][0])) & (b < len(self.levels[level - 1][0])) & (a <= b)
            todo.append((level - 1, a[inside], b[inside]))


def _merge(part: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Lowers part, by row the least row known to hang together with it, by pairs of rows."""
    while True:
        low = np.minimum(part[x], part[y])
        if (part[x] == low).all() and (part[y] == low).all():
            return
        for side in (x, y):
            np.minimum.at(part, part[side], low)
            np.minimum.at(part, side, low)
        while (part[part] != part).any():
            part[:] = part[part]


PAIR = "a long, b long"


def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over key, cid, n, most, vec sorted by key, n, cid: what the pairs within the bounds join, as pairs of a class with another."""
    for batch in _blocks(batches):
        key, cid, n, most = (batch.column(k).to_numpy().astype(np.int64) for k in range(4))
        vectors = Vectors(batch.column(4))
        head, end = _heads(key)
        length = end - np.repeat(head, np.diff(np.append(head, len(key))))
        row, part = np.arange(len(key)), np.arange(len(key))
        for step in range(1, SMALL):  # small blocks, all together: every two rows
            x = np.flatnonzero((length <= SMALL) & (row + step < end))
            if not len(x):
                break
            y = x + step
            good = (part[x] != part[y]) & (n[y] <= most[x]) & (n[x] <= most[y])
            x, y = x[good], y[good]
            good = vectors.may_link(x, y, n[x], n[y])
            _merge(part, x[good], y[good])
        for a in head[length[head] > SMALL].tolist():
            b = int(end[a])
            for x, y in CountTree(vectors.points(a, b), n[a:b]).pairs(part[a:b], most[a:b]):
                _merge(part, x + a, y + a)
        at = np.flatnonzero(part != row)
        yield pa.RecordBatch.from_arrays([pa.array(cid[at]), pa.array(cid[part[at]])], names=["a", "b"])


def _sets_of(pairs: DataFrame, docs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """The sets of all classes in pairs, as a table."""
    wanted = materialize(classes.select("cid", "a", "b", "row_key").join(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), "cid", "left_semi"), "wanted")
    sets = materialize(_sets(docs, wanted, k), "sets")
    discard(wanted)
    return sets


def _overlap(s: np.ndarray, t: np.ndarray) -> int:
    if len(s) > len(t):
        s, t = t, s
    return int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over cell, cid, label, visits, set sorted by cell: links of unlike label, as far as they join what isn't joined yet. Where rows visit, of a visitor and a host only."""
    for batch in _blocks(batches):
        key, cid, label = (batch.column(k).to_numpy() for k in range(3))
        visits = batch.column(3).to_numpy(zero_copy_only=False)
        head, _ = _heads(key)
        found = []
        for a, b in zip(head.tolist(), [*head[1:].tolist(), len(key)], strict=True):
            part = np.unique(label[a:b], return_inverse=True)[1]
            if not part.any():
                continue
            sets = [np.frombuffer(x.as_buffer(), U) for x in batch.column(4).slice(a, b - a)]
            n = np.array([len(s) for s in sets])
            most = int(n.max())
            coarse, fine = groups_of(most), min(4_096, 1 << int(8 * most).bit_length())
            points = np.stack([count_vector(s, coarse) for s in sets]).astype(np.int16)
            points[points == FULL] = BOUNDLESS
            fines = np.stack([count_vector(s, fine) for s in sets])
            for x, y in CountTree(points, n).pairs(part, 100 * n // PERCENT, visits[a:b] if visits[a:b].any() else None):
                for i in range(0, len(x), 1_000):
                    p, q = x[i : i + 1_000], y[i : i + 1_000]
                    own = np.flatnonzero(part[p] != part[q])
                    p, q = p[own], q[own]
                    u, v = fines[p], fines[q]
                    may = (u == FULL).any(1) | (v == FULL).any(1) | (_sums(np.minimum(u, v)) >= need(n[p], n[q]))
                    for j, k in zip(p[may].tolist(), q[may].tolist(), strict=True):
                        if part[j] != part[k] and _overlap(sets[j], sets[k]) >= need(n[j], n[k]):
                            part[part == part[k]] = part[j]
                            found.append((int(cid[a + j]), int(cid[a + k])))
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over cell, cid, n, fine sorted by cell: what pairs within the finer vectors' bound join, as pairs of a class with another."""
    for batch in _blocks(batches):
        key, cid, n = (batch.column(k).to_numpy() for k in range(3))
        vectors, head = Vectors(batch.column(3)), _heads(key)[0]
        part = np.arange(len(key))
        for a, b in zip(head.tolist(), [*head[1:].tolist(), len(key)], strict=True):
            for x, y in CountTree(vectors.points(a, b), n[a:b]).pairs(part[a:b], 100 * n[a:b] // PERCENT):
                for i in range(0, len(x), 2_000):
                    p, q = x[i : i + 2_000] + a, y[i : i + 2_000] + a
                    own = part[p] != part[q]
                    p, q = p[own], q[own]
                    may = vectors.may_link(p, q, n[p], n[q])
                    _merge(part, p[may], q[may])
        at = np.flatnonzero(part != np.arange(len(key)))
        yield pa.RecordBatch.from_arrays([pa.array(cid[at]), pa.array(cid[part[at]])], names=["a", "b"])


def _tiles(near: DataFrame, classes: DataFrame, size: Column, cell_bytes: int) -> DataFrame:
    """group, cid, n, tiles, tile, sampled: what hangs together by near (a, b), each group in as many tiles as its size in bytes wants."""
    group = components(near).select(F.col("label").alias("group"), F.col("node").alias("cid")).join(classes.select("cid", "n"), "cid")
    sized = group.groupBy("group").agg(F.greatest(F.lit(1), F.ceil(F.sum(size) / cell_bytes)).alias("tiles"))
    deal = lambda seed: F.pmod(F.xxhash64("cid", F.lit(seed)), F.col("tiles"))
    return materialize(group.join(sized, "group").select("group", "cid", "n", "tiles", deal(0).alias("tile"), ((F.col("tiles") > 1) & (deal(1) == 0)).alias("sampled")), "tiles")


def _sent(df: DataFrame) -> DataFrame:
    """df, to be sent to all executors if it has few rows, so that what it is joined with stays in place."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _links(docs: DataFrame, classes: DataFrame, blocks: DataFrame, k: int, cell_bytes: int) -> DataFrame:
    """label by node, for the classes that link with any."""
    rows = blocks.join(classes.select("cid", "vec"), "cid").select("key", "cid", "n", "most", "vec").repartition("key").sortWithinPartitions("key", "n", "cid")
    near = materialize(rows.mapInArrow(searched, PAIR).distinct(), "searched")
    sets = _sets_of(near, docs, classes, k)
    cell = lambda *of: F.xxhash64("group", *of).alias("cell")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other")

    at = _tiles(near, classes, F.least(2 * F.col("n"), F.lit(4_096)), cell_bytes)
    two = at.select("*", each).where("tiles = 1 OR tile <> other").select(cell(F.least("tile", "other"), F.greatest("tile", "other")), "cid", "n")
    rows = sets.select("cid", "fine").join(_sent(two), "cid").select("cell", "cid", "n", "fine").repartition("cell").sortWithinPartitions("cell")
    finer = materialize(rows.mapInArrow(_finer, PAIR).distinct(), "searched")
    discard(near, at)
    at = _tiles(finer, classes, F.col("n") * 8, cell_bytes)

    def linked(cells: DataFrame) -> DataFrame:
        """cells: cell, cid, label, visits."""
        rows = sets.select("cid", "set").join(_sent(cells), "cid").select("cell", "cid", "label", "visits", "set")
        return materialize(rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(_cells, PAIR), "links")

    own = at.select(cell("tile"), "cid", F.col("cid").alias("label"), F.lit(False).alias("visits"))
    sample = at.where("sampled").select(cell(F.lit(-1).cast("long")), "cid", F.col("cid").alias("label"), F.lit(False).alias("visits"))
    links = linked(own.unionByName(sample))
    label = components(links)
    if at.where("tiles > 1").head() is not None:
        named = at.where("tiles > 1").join(label.select(F.col("node").alias("cid"), "label"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
        main = named.groupBy("group", "label").agg(F.sum("n").alias("n")).groupBy("group").agg(F.max_by("label", F.struct("n", "label")).alias("main"))
        both = named.join(main, "group").select("*", each).where("tile <> other")
        hosts = both.select(cell("tile", "other"), "cid", "label", F.lit(False).alias("visits"))
        guests = both.where("label <> main").select(cell("other", "tile"), "cid", "label", F.lit(True).alias("visits"))
        label = components(links.unionByName(linked(hosts.unionByName(guests))))
    discard(sets, at, finer)
    return label


def _labelled(docs: DataFrame, k: int, hot: int = HOT, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """A row for every row of docs: doc_id, row_key, n, cid, label (of its component; null without words) and the component's least doc_id. NO_ID stands for null."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = materialize(sketches(docs, k, hot), "sketches")
    grouped = sketch.where("n > 0").groupBy("a", "b").agg(F.min(F.struct("doc_id", "row_key")).alias("least"), *(F.first(c).alias(c) for c in ("n", "vec", "keys", "at")))
    classes = materialize(grouped.select(F.monotonically_increasing_id().alias("cid"), "a", "b", "least.doc_id", "least.row_key", "n", "vec", "keys", "at"), "classes")
    keyed = classes.select("cid", "n", F.explode(F.arrays_zip("keys", "at")).alias("k")).select(F.col("k.keys").alias("key"), "cid", F.col("n").cast("int").alias("n"), F.col("k.at").alias("at"))
    blocks = materialize(keyed.repartition("key").sortWithinPartitions("key", "n", "cid").mapInArrow(live, BLOCK), "blocks")
    label = _links(docs, classes, blocks, k, cell_bytes)
    discard(blocks)
    placed = classes.select("cid", "a", "b", "doc_id").join(label.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    least = placed.groupBy("label").agg(F.min("doc_id").alias("least"))
    known = placed.join(least, "label").select("a", "b", "cid", "label", "least")
    return sketch.select("doc_id", "row_key", "n", "a", "b").join(known, ["a", "b"], "left").select("doc_id", "row_key", "n", "cid", "label", F.coalesce("least", "doc_id").alias("least"))


def join(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """A row for every row of docs: doc_id, n_shingles, component_id, class_id (equal sets have equal ones)."""
    named_id = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return _labelled(docs, k).select(named_id("doc_id").alias("doc_id"), F.col("n").alias("n_shingles"), named_id("least").alias("component_id"), F.col("cid").alias("class_id"))


def representatives(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """A row of each component, with all its columns: of the rows with its least doc_id the one with the least row_key.

    Rows that share an id (null or repeated) but no component all stay, and so do all rows without words, which are linked with nothing.
    """
    found = _labelled(docs, k).where(F.col("doc_id") == F.col("least"))
    rows = materialize(found.groupBy("label", "row_key").agg(F.count("*").alias("copies")), "least")
    worded = rows.where(F.col("label").isNotNull())
    best = worded.groupBy("label").agg(F.min("row_key").alias("row_key")).join(worded, ["label", "row_key"])
    kept = materialize(best.select(F.col("row_key").alias("kept_key"), "copies").unionByName(rows.where(F.col("label").isNull()).select(F.col("row_key").alias("kept_key"), F.lit(1).cast("long").alias("copies"))), "kept")
    of = lambda keys: docs.join(keys.select("kept_key").hint("shuffle_hash"), row_key() == F.col("kept_key"), "left_semi")
    if kept.where("copies > 1").head() is None:
        return of(kept)
    again = of(kept.where("copies > 1")).withColumn("kept_key", row_key()).dropDuplicates(["kept_key"]).drop("kept_key")
    return of(kept.where("copies = 1")).unionByName(again)
