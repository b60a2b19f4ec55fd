"""Benchmark decontamination: documents that hold a benchmark item, by SimHash windows and exact verification.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Items are put into classes by their number of
words (within a tenth or so); for each class, windows of its size lie over every document at each 1 / STRIDE of their size (each
word, below 2 * STRIDE words). A window's 64-bit SimHash has a bit where more than half of its words' hashes have it; sums
over windows are differences of running sums. Item fingerprints are indexed in four blocks of 16 bits, each with all
values within RADIUS // 4 bits: whatever lies within RADIUS bits of an item agrees with it that closely in some block, so
the index misses no such window. Candidates are then aligned word by word and verified by the weighted Jaccard similarity of
SHINGLE-word shingles (counted with multiplicity; one of the item's weighs 1 / number of items of the whole benchmark that have it,
any other 1). An item with fewer
words than SHINGLE must occur as it stands; its windows start at each word.

No bound holds for fingerprints of edited passages between two strides, so by themselves they may miss some. Anchors make
the search whole: a window as similar as SIMILAR shares at least that part of the item's weight, so it has one of any
shingles of the item that weigh more than the rest of it. Wherever a document has one of an item's anchors (such a set, the
rarest shingles), all windows around it are verified. Windows near which too little weight is shared get no fingerprint.

Items are dealt by a hash into blocks of about ITEMS, so what the driver and a task hold does not grow with the benchmark; weights
are those of the whole benchmark, so results don't depend on the blocks. Null texts have no words; long texts are taken whole;
items without words match nothing; repeated rows and null ids are judged like others; empty tables give empty results;
extra columns are ignored (in drop(), carried).
"""

from __future__ import annotations

import itertools
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caesura.llm.store import discard, materialize
from caesura.llm.vec import Chunk, U, chunks, mix

SHINGLE, SIMILAR, RADIUS, STRIDE, ITEMS = 5, 0.8, 19, 8, 20_000
GAP = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_BITS = np.arange(256)
SPREAD = sum(((_BITS >> k) & 1).astype(U) << U(8 * k) for k in range(8))
NEAR = np.array([sum(1 << k for k in at) for n in range(RADIUS // 4 + 1) for at in itertools.combinations(range(16), n)], np.int64)
MATCHES = "doc_id long, item_id long, similarity double, first_word long, n_words long"


def _chunk(texts: list[str | None]) -> Chunk:
    chunk = next(chunks(pa.array(texts, pa.string()), 1 << 62))[2]
    chunk.words(gap=GAP)
    return chunk


class Lanes:
    """Running sums of the words' hash bits, one byte a bit, 64 bytes a word."""

    def __init__(self, h: np.ndarray):
        self.sums = np.zeros((len(h) + 1, 8), U)
        h = mix(h ^ U(0x51ED270B))
        for k in range(8):
            self.sums[1:, k] = SPREAD[((h >> U(8 * k)) & U(255)).astype(np.int64)]
        np.cumsum(self.sums, axis=0, out=self.sums)

    def simhash(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Fingerprints of the windows of size words from start."""
        end, most = start + size, int(size.max(initial=0))
        if most <= 255:  # a byte holds as many
            bits = (self.sums[end] - self.sums[start]).view(np.uint8) > (size // 2).astype(np.uint8)[:, None]
        else:
            total, at = np.zeros((len(start), 64), np.int32), start
            while (at < end).any():
                stop = np.minimum(at + 255, end)
                total += (self.sums[stop] - self.sums[at]).view(np.uint8)
                at = stop
            bits = total > (size // 2)[:, None]
        return np.packbits(bits, axis=1).view(U).reshape(-1)


class Items:
    """A block of benchmark items: by class the index of fingerprints, and what verification needs."""

    def __init__(self, rows: list[tuple[int | None, str | None]], held: dict[int, int] | None = None):
        """held: by shingle how many items of the whole benchmark have it, where that is more than one."""
        chunk = _chunk([text for _, text in rows]) if rows else None
        self.classes: list[tuple[int, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]] = []
        self.ids = [i for i, _ in rows]
        if chunk is None:
            self.words, self.shingles, self.known = [], [], np.zeros(0, U)
            return
        self.words = [chunk.hash[a:b] for a, b in zip(chunk.first[:-1], chunk.first[1:], strict=True)]
        h, at = chunk.shingles(SHINGLE, True)
        self.shingles = [Counter(h[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)]
        held = Counter(x for s in self.shingles for x in s) if held is None else held
        self.weight = {x: 1 / held.get(x, 1) for s in self.shingles for x in s}
        self.known = np.unique(h)
        self.known_weight = np.array([self.weight[x] for x in self.known.tolist()])
        self.total = np.array([sum(self.weight[x] * n for x, n in c.items()) for c in self.shingles])
        sizes = np.diff(chunk.first)
        self.sizes = sizes
        anchors = [self._anchors(k) if n >= SHINGLE else [] for k, n in enumerate(sizes.tolist())]
        at_known = np.searchsorted(self.known, np.array([x for held in anchors for x in held], U))
        self.anchored = np.repeat(np.arange(len(rows)), [len(x) for x in anchors])[np.argsort(at_known, kind="stable")]
        self.anchor_first = np.searchsorted(np.sort(at_known), np.arange(len(self.known) + 1))
        lanes, left = Lanes(chunk.hash), np.flatnonzero(sizes)
        while len(left):
            least = int(sizes[left].min())
            own = left[sizes[left] <= max(least, int(least * 1.15))]
            left = np.setdiff1d(left, own)
            prints = lanes.simhash(chunk.first[own], sizes[own])
            index = []
            for k in range(4):
                value = ((prints >> U(16 * k)) & U(0xFFFF)).astype(np.int64)
                near = (value[:, None] ^ NEAR[None, :]).reshape(-1)
                order = np.argsort(near, kind="stable")
                index.append((np.searchsorted(near[order], np.arange(65_537)).astype(np.int32), np.repeat(np.arange(len(own)), len(NEAR))[order].astype(np.int32)))
            self.classes.append((int(round((sizes[own].min() + sizes[own].max()) / 2)), own, prints, index))

    def _anchors(self, item: int) -> list[int]:
        """The rarest shingles of an item, without which a window has less than SIMILAR of its weight."""
        out, rest = [], float(self.total[item])
        for x, n in sorted(self.shingles[item].items(), key=lambda s: (self.weight[s[0]] < 1, -self.weight[s[0]], s[0])):
            if rest < SIMILAR * self.total[item] - 1e-6:
                break
            out.append(x)
            rest -= self.weight[x] * n
        return out

    def _verify(self, item: int, words: np.ndarray, shingles: np.ndarray, weights: np.ndarray, first: int, last: int, done: set[int]) -> tuple[float, int]:
        """The best similarity over windows of the item's size that start in first..last and aren't done, and its start. weights: running sums of known shingles'."""
        want, n = self.words[item], len(self.words[item])
        best = (0.0, first)
        for q in range(max(first, 0), min(last, max(len(words) - n, 0)) + 1):
            if q in done:
                continue
            done.add(q)
            stop = min(max(q + n - SHINGLE + 1, q), len(shingles))
            if n >= SHINGLE and weights[stop] - weights[q] < SIMILAR * self.total[item] - 1e-9:
                continue  # what is shared has too little weight
            if n < SHINGLE:
                found = 1.0 if len(words) - q >= n and (words[q : q + n] == want).all() else 0.0
            else:
                own, wanted = Counter(shingles[q : max(q + n - SHINGLE + 1, q)].tolist()), self.shingles[item]
                weigh = lambda x: self.weight[x] if x in wanted else 1.0
                both = sum(weigh(x) * min(c, own[x]) for x, c in wanted.items() if x in own)
                found = both / (sum(weigh(x) * c for x, c in wanted.items()) + sum(weigh(x) * c for x, c in own.items()) - both) if both else 0.0
            best = max(best, (found, -q)) if q == 0 else max(best, (found, q), key=lambda x: x[0])
        return best[0], abs(best[1])

    def matches(self, chunk: Chunk) -> dict[tuple[int, int], tuple[float, int]]:
        """(text, item) -> (similarity, first word), for a chunk without words set."""
        chunk.words(gap=GAP)
        out: dict[tuple[int, int], tuple[float, int]] = {}
        tested: dict[tuple[int, int], set[int]] = {}
        if not self.classes or not len(chunk.hash):
            return out
        lanes, size = Lanes(chunk.hash), np.diff(chunk.first)
        h, at = chunk.shingles(SHINGLE, True)
        hit = self.known[np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)] == h
        place = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        weights = np.concatenate([[0.0], np.cumsum(np.where(hit, self.known_weight[place], 0.0))])

        def shared(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
            """The weight of known shingles from start to stop of texts."""
            count = at[doc + 1] - at[doc]
            a = np.clip(start, 0, count)
            return weights[at[doc] + np.clip(stop, a, count)] - weights[at[doc] + a]

        def verify(x: int, i: int, first: int, last: int) -> None:
            got = self._verify(i, chunk.hash[chunk.first[x] : chunk.first[x + 1]], h[at[x] : at[x + 1]], weights[at[x] : at[x + 1] + 1], first, last, tested.setdefault((x, i), set()))
            if got[0] >= SIMILAR and got[0] > out.get((x, i), (0.0, 0))[0]:
                out[x, i] = got

        for length, own, prints, index in self.classes:
            step, small = max(1, length // STRIDE), len(self.words[own[0]]) < SHINGLE
            # windows of each text at 0, step, 2 step, ... and at its end; one of the whole text if that is shorter
            count = np.where(size > length, -(-(size - length) // step) + 1, (size * 5 >= length * 3).astype(np.int64))
            doc = np.repeat(np.arange(chunk.n), count)
            k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            width = np.minimum(size[doc], length)
            start = np.minimum(k * step, size[doc] - width)
            if not small:
                some = shared(doc, start - 2 * step, start + width + 2 * step) >= SIMILAR * self.total[own].min() - 1e-6
                doc, start, width = doc[some], start[some], width[some]
            for lo in range(0, len(doc), 20_000):
                d, s, w = doc[lo : lo + 20_000], start[lo : lo + 20_000], width[lo : lo + 20_000]
                marks = lanes.simhash(chunk.first[d] + s, w)
                found: list[np.ndarray] = []
                for b, (first, items) in enumerate(index):
                    v = ((marks >> U(16 * b)) & U(0xFFFF)).astype(np.int64)
                    n = first[v + 1] - first[v]
                    row = np.repeat(np.arange(len(v)), n)
                    item = items[np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + first[v][row]]
                    near = np.bitwise_count(marks[row] ^ prints[item]) <= RADIUS
                    found.append(row[near] * len(own) + item[near])
                row, item = np.divmod(np.unique(np.concatenate(found)), len(own))
                if not small:  # a similar window shares as much weight
                    some = shared(d[row], s[row] - 2 * step, s[row] + w[row] + 2 * step) >= SIMILAR * self.total[own[item]] - 1e-6
                    row, item = row[some], item[some]
                for r, i in zip(row.tolist(), own[item].tolist(), strict=True):
                    verify(int(d[r]), i, int(s[r]) - 2 * step, int(s[r]) + 2 * step)
        many = np.where(hit, self.anchor_first[place + 1] - self.anchor_first[place], 0)
        pos = np.flatnonzero(many)
        for own in np.split(pos, np.flatnonzero(np.diff(np.cumsum(many[pos]) // 1_000_000)) + 1):
            n = many[own]
            row = np.repeat(np.arange(len(own)), n)
            item = self.anchored[np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + self.anchor_first[place[own]][row]]
            doc = np.searchsorted(at, own, "right")[row] - 1
            where, reach = own[row] - at[doc], self.sizes[item] - SHINGLE
            some = shared(doc, where - reach, where + reach + 1) >= SIMILAR * self.total[item] - 1e-6
            for x, i, q, m in zip(doc[some].tolist(), item[some].tolist(), where[some].tolist(), reach[some].tolist(), strict=True):
                verify(x, i, q - m, q)
        return out


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over block, text: block and hash of each distinct shingle of each text."""
    for batch in batches:
        for i, j, chunk in chunks(batch.column(1)):
            chunk.words(gap=GAP)
            h, at = chunk.shingles(SHINGLE, True)
            own = [np.unique(h[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            block = np.repeat(batch.column(0).slice(i, j - i).to_numpy(), [len(x) for x in own])
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(np.concatenate(own).view(np.int64) if own else [], pa.int64())], names=["block", "h"])


def blocks(benchmark: DataFrame, items: int = ITEMS) -> Iterator[tuple[str, list[tuple[int | None, str | None]], dict[int, int]]]:
    """(name, items, what Items() wants as held) of the blocks; the driver holds one at a time."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    n = max(1, -(-rows.count() // items))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int"))
    table = materialize(dealt, "benchmark")
    found = table.select("block", "text").mapInArrow(_shingles, "block int, h long").groupBy("block", "h").agg(F.count("*").alias("n"))
    counts = materialize(found, "shingles")
    held = materialize(counts.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1"), "held")
    name = uuid.uuid4().hex
    for k in range(n):
        own = [(r["item_id"], r["text"]) for r in table.where(F.col("block") == k).collect()]
        shared = {r["h"] % 2**64: r["n"] for r in held.join(counts.where(F.col("block") == k).select("h"), "h", "left_semi").collect()}
        if own:
            yield f"{name}-{k}", sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")), shared
    discard(table, counts, held)


_built: dict[str, Items] = {}


def _items(key: str, rows: list, held: dict[int, int]) -> Items:
    if key not in _built:
        _built.clear()
        _built[key] = Items(rows, held)
    return _built[key]


def find(docs: DataFrame, benchmark: DataFrame, items: int = ITEMS) -> DataFrame:
    """A row a document and item it holds: doc_id, item_id, similarity, first_word, n_words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def of(key: str, block: list, held: dict[int, int]) -> DataFrame:
        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = _items(key, block, held)
            for batch in batches:
                for i, _, chunk in chunks(batch.column(1), 1_000_000):
                    got = sorted(items.matches(chunk).items())
                    ids = batch.column(0).slice(i, chunk.n).take(pa.array([x for (x, _), _ in got], pa.int64()))
                    yield pa.RecordBatch.from_arrays([ids, pa.array([items.ids[k] for (_, k), _ in got], pa.int64()), pa.array([round(s, 4) for _, (s, _) in got], pa.float64()), pa.array([q for _, (_, q) in got], pa.int64()), pa.array([len(items.words[k]) for (_, k), _ in got], pa.int64())], names=[x.split()[0] for x in MATCHES.split(", ")])

        return rows.mapInArrow(match, MATCHES)

    parts = [of(*block) for block in blocks(benchmark, items)] or [docs.sparkSession.createDataFrame([], MATCHES)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def drop(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no item, with all their columns."""
    place = docs.columns.index("text")
    for block in blocks(benchmark):

        def clean(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            items = _items(*block)
            for batch in batches:
                good = np.ones(batch.num_rows, bool)
                for i, _, chunk in chunks(batch.column(place), 1_000_000):
                    good[[i + x for x, _ in items.matches(chunk)]] = False
                yield batch.filter(pa.array(good))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
