"""The n-gram Jaccard join against all pairs."""

import re

import numpy as np
import pyarrow as pa
import pytest

from caesura.llm import ngram_join


def plain(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + 4]) for i in range(max(len(w) - 3, min(len(w), 1)))})
    part = list(range(len(rows)))

    def top(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                part[top(i)] = top(j)
    low = lambda x: (x is not None, x or 0)
    return sorted(((r[0], len(s), min((rows[j][0] for j in range(len(rows)) if top(j) == top(i)), key=low)) for i, (r, s) in enumerate(zip(rows, sets, strict=True))), key=str)


def made(seed):
    rnd = np.random.RandomState(seed)
    words = [f"w{i}" for i in range(300)] + ["The", "of"] * 30
    base = [list(rnd.choice(words, rnd.choice([2, 30, 120, 400]))) for _ in range(40)]
    notice = list(rnd.choice(words, 45))
    rows = []
    for i in range(220):
        b = list(base[rnd.randint(len(base)) if i % 2 else rnd.randint(3)])
        for _ in range(rnd.randint(0, 4)):
            b[rnd.randint(len(b))] = str(rnd.choice(words))
        if i % 5 == 0:
            b += notice
        rows.append((i, "  ".join(b)))
    return rows + [(500, None), (501, " \n"), (502, "Two words"), (503, "two  WORDS"), (None, rows[7][1]), (504, rows[9][1].upper()), (504, rows[9][1].upper())]


@pytest.mark.parametrize("rows", [made(1), made(2), []])
def test_components(spark, rows):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, n int, cid int").repartition(3)
    assert sorted((tuple(r)[:3] for r in ngram_join.join(docs).collect()), key=str) == plain(rows)


def test_hot_blocks_are_tiled_and_long_texts_and_families_kept_whole(spark):
    rnd = np.random.RandomState(8)
    long = [f"v{i}" for i in rnd.randint(0, 5_000, 30_000)]
    family = [f"u{i}" for i in rnd.randint(0, 200, 90)]
    rows = [(1, " ".join(long)), (2, " ".join([*long[:20_000], "x", *long[20_001:]])), (3, " ".join(long[:20_000]))]
    for i in range(150):  # a chain of copies, each a few words on from the last
        family[rnd.randint(len(family))] = str(i)
        rows.append((10 + i, " ".join(family)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = ngram_join._labelled(docs, 4, hot=7, cell_bytes=5_000).select("doc_id", "n", "least")
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows)
    key, at = ngram_join.tiled(np.array([5, 9], ngram_join.U), np.array([0, 1], np.int32), 2, np.array([9], ngram_join.U), np.array([3]))
    assert at.tolist() == [0, 1, 1, 1] and len(set(key.tolist())) == 4
    other, _ = ngram_join.tiled(np.array([9], ngram_join.U), np.array([4], np.int32), 1, np.array([9], ngram_join.U), np.array([3]))
    assert len(set(key.tolist()) & set(other.tolist())) == 1


def test_bound_is_never_below_the_overlap():
    rnd = np.random.RandomState(3)
    vector = lambda x: ngram_join.count_vector(x.astype(ngram_join.U), ngram_join.groups_of(len(x))).tobytes()
    blob = rnd.randint(0, 128, (40, 8_192)).astype("u1")
    assert (ngram_join._sums(blob) == blob.sum(1)).all() and (ngram_join._sums(np.full((2, 4_096), 127, "u1")) == 127 * 4_096).all()
    sets = [np.repeat(np.arange(4) * 64, 100) + np.tile(np.arange(100) * 4096, 4)]  # few groups
    for _ in range(50):
        a = np.unique(rnd.randint(0, 9000, rnd.randint(1, 7000)))
        sets += [a, np.unique(np.concatenate([a[: len(a) // 2], rnd.randint(0, 9000, len(a))])), np.unique(np.concatenate([a[:-1], rnd.randint(0, 9000, 3)]))]
    vectors, n = ngram_join.Vectors(pa.array([vector(x) for x in sets], pa.binary())), np.array([len(x) for x in sets])
    x, y = (z.reshape(-1) for z in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    may = vectors.may_link(x, y, n[x], n[y])
    links = np.array([len(np.intersect1d(sets[i], sets[j])) >= ngram_join.need(n[i], n[j]) for i, j in zip(x, y, strict=True)])
    assert not (links & ~may).any() and may.sum() < 5 * links.sum()
    points = rnd.poisson(3, (500, 64))
    tree, sizes = ngram_join.CountTree(points, points.sum(1)), points.sum(1)
    got = {frozenset(p) for part in tree.pairs(np.arange(500), sizes * 2) for p in zip(*(x.tolist() for x in part), strict=True)}
    want = {frozenset((i, j)) for i in range(500) for j in range(i) if np.minimum(points[i], points[j]).sum() >= ngram_join.need(sizes[i], sizes[j]) and 100 * min(sizes[i], sizes[j]) >= 85 * max(sizes[i], sizes[j])}
    assert got == want


def test_representatives_keep_a_row_of_each_component(spark):
    rnd = np.random.RandomState(12)
    text = lambda: " ".join(rnd.choice([f"w{i}" for i in range(300)], 60))
    near = lambda t: t.rsplit(" ", 1)[0] + " changed"
    a, b, c, d, e, f, g, h = (text() for _ in range(8))
    rows = [(None, a), (None, near(a)), (None, b), (None, b), (None, c), (7, d), (7, e), (7, e), (7, near(c)), (1, f), (9, near(f)), (9, g), (3, h), (3, h.upper()), (4, ""), (4, ""), (None, None), (None, " ")]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string").repartition(3)
    kept = ngram_join.representatives(docs)
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert kept.columns == docs.columns
    families = [{(None, a), (None, near(a))}, {(3, h), (3, h.upper())}]
    assert [len(x & set(got)) for x in families] == [1, 1]
    assert [r for r in got if r not in families[0] | families[1]] == sorted([(None, b), (None, c), (7, d), (7, e), (1, f), (9, g), (4, ""), (4, ""), (None, None), (None, " ")], key=str)
