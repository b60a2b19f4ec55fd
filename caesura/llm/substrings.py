"""Exact removal of repeated substrings: every byte covered by a string of LENGTH bytes that also starts earlier.

Texts are taken as UTF-8 bytes; earlier means a smaller doc_id, or the same document and an earlier start.

Why not a full external suffix sort: a suffix array with its common-prefix values takes 10 bytes or more a byte of
text in the queues, over five times what the check tool allows on disk, and its induction is a step a byte in one
order. Only suffixes that can share LENGTH bytes matter here, so, as induced sorting sorts the suffixes at local
minima first and derives the others from them, this sorts only suffixes at local minima and derives the rest:

1. Of each LENGTH-byte window, the least hashed K-gram (leftmost of equals) is its anchor. Equal windows have equal
   anchors at equal distances, so windows can only repeat where anchors do. An anchor stands for the run of windows
   that chose it. It is sorted, on disk, by the hash of its K-gram, then by the hash of the bytes of all its run.
2. Of anchors with equal runs, all but the first repeat it whole: their bytes are removed. If an anchor's K-gram has
   runs of one kind only, that is all.
3. For other anchors (at the borders of repeats) the first run of each kind is cut out of its text, and its single
   windows are compared with those of the same K-gram, in order.
4. Removed ranges are joined by document and applied.

Chunks of texts settle their own repeats before anything is shuffled, so a group of copies sends one row a chunk.
A task holds a chunk, and the hashes of the distinct windows around one K-gram.

Strings are compared by 64-bit hashes. Nulls: a null text counts as empty, a null doc_id comes first. Rows with the
same doc_id are ordered by text; of equal rows the first is kept. Texts under LENGTH bytes are left alone. An empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caesura.llm.store import materialize
from caesura.llm.vec import Chunk, Ranges, U, chunks, mix, powers

LENGTH, K = 100, 32
NO_ID = -(2**63)
CHUNK = 3_000_000
FOUND = "h long, g long, uid long, at long, before int, windows int"  # windows 0: a range to remove, from at to g


def least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each width consecutive values, by doubling."""
    size = 1
    while size * 2 <= width:
        x, size = np.minimum(x[:-size], x[size:]), size * 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def _lexsorted(*keys: np.ndarray) -> np.ndarray:
    return np.lexsort(keys[::-1])


def runs(chunk: Chunk) -> tuple[np.ndarray, ...]:
    """Of each run of windows with one anchor: text, start of its first window, windows, anchor's distance from it, K-gram hash, run hash."""
    n, b = len(chunk.b), chunk.b
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, U),) * 2
    if n < LENGTH:
        return none
    ranges = Ranges(b)
    h = mix((ranges.sums[K:] - ranges.sums[:-K]) * ranges.down[: n - K + 1])
    key = (h & ~U(0xFFFFFFFF)) | np.arange(len(h), dtype=U)
    anchor = (least(key, LENGTH - K + 1) & U(0xFFFFFFFF)).astype(np.int64)
    sizes = np.diff(chunk.edge)
    valid = np.arange(len(anchor)) + LENGTH <= np.repeat(chunk.edge[1:], sizes)[: len(anchor)]
    change = np.ones(len(anchor) + 1, bool)
    change[1:-1] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
    cut = np.flatnonzero(change)
    first, after = cut[:-1], cut[1:]
    keep = valid[first]
    first, after = first[keep], after[keep]
    a = anchor[first]
    g = mix(ranges.hash(first, after - 1 + LENGTH) + (a - first).astype(U) * U(0x9E3779B97F4A7C15))
    return np.searchsorted(chunk.edge, first, "right") - 1, first, after - first, a - first, h[a], g


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges by document, those that overlap or touch joined. Sorted by document and start."""
    if not len(doc):
        return doc, start, end
    order = _lexsorted(doc, start)
    doc, start, end = doc[order], start[order], end[order]
    _, d = np.unique(doc, return_inverse=True)
    shift = int(end.max()) + 2
    reach = np.maximum.accumulate(end + d * shift)
    fresh = np.ones(len(doc), bool)
    fresh[1:] = start[1:] + d[1:] * shift > reach[:-1]
    at = np.flatnonzero(fresh)
    return doc[at], start[at], reach[np.append(at[1:], len(doc)) - 1] - d[at] * shift


def _rows(h, g, uid, at, before, windows) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.int32()] * 2
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x).astype(k.to_pandas_dtype(), copy=False), k) for x, k in zip((h.view(np.int64), g.view(np.int64), uid, at, before, windows), kinds, strict=True)], names=[x.split()[0] for x in FOUND.split(", ")])


def _removed(uid: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    uid, start, end = _merged(uid, start, end)
    return _rows(mix(uid.astype(U) + start.astype(U)), end, uid, start, np.zeros(len(uid)), np.zeros(len(uid)))


def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1: anchors with their runs, and what the chunk itself repeats."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for i, j, chunk in chunks(batch.column(1), CHUNK):
            doc, first, windows, before, h, g = runs(chunk)
            uid, at = ids[i:j][doc], first - chunk.edge[doc]
            order = _lexsorted(h, g, uid, at)
            doc, at, windows, before, h, g, uid = (x[order] for x in (doc, at, windows, before, h, g, uid))
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
            yield _rows(h[fresh], g[fresh], uid[fresh], at[fresh], before[fresh], windows[fresh])
            again = ~fresh
            if again.any():
                yield _removed(uid[again], at[again], at[again] + windows[again] - 1 + LENGTH)


def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2, over rows sorted by (h, g, uid, at): ranges to remove, and the first runs of K-grams that have several kinds."""
    last_h = last_g = None
    held: pa.RecordBatch | None = None  # the first run of the last K-gram, while it has only one kind
    for batch in batches:
        windows = batch.column(5).to_numpy()
        ready = windows == 0
        if ready.any():
            yield batch.filter(pa.array(ready))
        batch = batch.filter(pa.array(~ready))
        if not batch.num_rows:
            continue
        h, g, uid, at = (batch.column(k).to_numpy() for k in range(4))
        windows = batch.column(5).to_numpy()
        new_h, new_g = np.ones(len(h), bool), np.ones(len(h), bool)
        new_h[1:] = h[1:] != h[:-1]
        new_h[0] = last_h is None or h[0] != last_h
        new_g[1:] = new_h[1:] | (g[1:] != g[:-1])
        new_g[0] = new_h[0] or g[0] != last_g
        if not new_g.all():
            old = ~new_g
            yield _removed(uid[old], at[old], at[old] + windows[old].astype(np.int64) - 1 + LENGTH)
        kinds = np.flatnonzero(new_g)
        if len(kinds):
            starts_h = new_h[kinds]
            group = np.cumsum(starts_h)  # 0: goes on with the last batch's K-gram
            size = np.bincount(group, minlength=group[-1] + 1)
            if held is not None and size[0]:
                yield held
                held = None
            several = (size[group] > 1) | (group == 0)
            alone = len(kinds) - 1 if group[-1] and size[group[-1]] == 1 else None
            if several.any():
                yield batch.take(pa.array(kinds[several]))
            if group[-1]:
                held = None if alone is None else batch.slice(int(kinds[alone]), 1)
        last_h, last_g = h[-1], g[-1]


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3a: the bytes of runs, from their texts."""
    for batch in batches:
        out: list[tuple] = []
        for uid, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            data = (text.as_py() or "").encode()
            for x in found.as_py():
                out.append((x["h"], uid, x["at"], data[x["at"] : x["at"] + x["windows"] - 1 + LENGTH]))
            if len(out) > 20_000:
                yield _cut(out)
                out = []
        if out:
            yield _cut(out)


def _cut(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["h", "uid", "at", "bytes"])


def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3b, over rows sorted by (h, uid, at): windows seen before under the same K-gram."""
    last_h, seen = None, np.zeros(0, U)
    for batch in batches:
        for i in range(0, batch.num_rows, 20_000):
            part = batch.slice(i, 20_000)
            h, uid, at = (part.column(k).to_numpy() for k in range(3))
            data = part.column(3).cast(pa.large_binary())
            edge = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
            b = np.frombuffer(data.buffers()[2], np.uint8)[edge[0] : edge[-1]]
            edge = edge - edge[0]
            count = np.diff(edge) - LENGTH + 1
            base = np.concatenate([[0], np.cumsum(count)])
            row = np.repeat(np.arange(len(h)), count)
            inside = np.arange(base[-1]) - base[row]
            sums, down = Ranges(b).sums, powers(len(b) + 1)[1]
            p = edge[row] + inside
            w = mix((sums[p + LENGTH] - sums[p]) * down[p])
            w ^= mix(h[row].view(U))
            place = np.arange(len(w))
            order = _lexsorted(w, place)
            again = np.zeros(len(w), bool)
            again[order[1:]] = w[order[1:]] == w[order[:-1]]
            if last_h is not None and h[0] == last_h and len(seen):
                own = np.flatnonzero(h[row] == last_h)
                k = np.minimum(np.searchsorted(seen, w[own]), len(seen) - 1)
                again[own] |= seen[k] == w[own]
            if again.any():
                start = at[row][again] + inside[again]
                uids, starts, ends = _merged(uid[row][again], start, start + LENGTH)
                yield pa.RecordBatch.from_arrays([pa.array(uids), pa.array(starts), pa.array(ends)], names=["uid", "start", "end"])
            mine = np.unique(w[h[row] == h[-1]])
            seen = np.union1d(seen, mine) if last_h is not None and h[-1] == last_h else mine
            last_h = h[-1]


def _numbered(docs: DataFrame) -> DataFrame:
    """uid (in the order of the documents, unique), doc_id and text. uid is doc_id where those are unique."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    uid = F.coalesce("doc_id", F.lit(NO_ID))
    if rows.groupBy(uid.alias("uid")).count().where("count > 1").head() is None:
        return rows.select(uid.alias("uid"), "doc_id", "text")
    ordered = rows.repartitionByRange("doc_id", "text").sortWithinPartitions("doc_id", "text")
    return materialize(ordered.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text"), "numbered")


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """uid, start, end (bytes) of what is to be removed; ranges of a document may overlap. docs: uid, text."""
    found = docs.select("uid", "text").mapInArrow(find, FOUND)
    settled = materialize(found.repartition("h").sortWithinPartitions("h", "g", "uid", "at").mapInArrow(settle, FOUND), "anchors")
    whole = settled.where("windows = 0").select("uid", F.col("at").alias("start"), F.col("g").alias("end"))
    wanted = settled.where("windows > 0").groupBy("uid").agg(F.collect_list(F.struct("h", "at", "windows")).alias("found"))
    pieces = docs.select("uid", "text").join(wanted.hint("shuffle_hash"), "uid").mapInArrow(cut_out, "h long, uid long, at long, bytes binary")
    parts = materialize(pieces.repartition("h").sortWithinPartitions("h", "uid", "at").mapInArrow(compare, "uid long, start long, end long"), "windows")
    return whole.unionByName(parts)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def deduplicate(docs: DataFrame, text_out: bool = False) -> DataFrame:
    """A row for every row of docs: sizes, removed runs, and the remaining bytes' hash (and themselves, as `kept`)."""
    rows = _numbered(docs)
    ranges = repeated_ranges(rows).groupBy("uid").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                data = (text.as_py() or "").encode()
                found = found.as_py() or []
                zero = np.zeros(len(found), np.int64)
                _, start, end = _merged(zero, np.array([x["start"] for x in found], np.int64), np.array([x["end"] for x in found], np.int64))
                left = b"".join(data[a:b] for a, b in zip([0, *end.tolist()], [*start.tolist(), len(data)], strict=True))
                out.append((doc_id, len(data), len(data) - len(left), len(start), hashlib.sha256(left).hexdigest()) + (left,) * text_out)
            kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * text_out
            names = [x.split()[0] for x in RESULT.split(", ")] + ["kept"] * text_out
            columns = zip(*out, strict=True) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=names)

    joined = rows.join(ranges.hint("shuffle_hash"), "uid", "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(apply, RESULT + ", kept binary" * text_out)
