"""Benchmark items in documents against a check of every window."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa

from caesura.llm import decontamination as dec


def words(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    bag = lambda w: Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1))))
    held = Counter(x for _, t in items for x in bag(words(t)))
    out = {}
    for doc_id, text in docs:
        w = words(text)
        for item_id, t in items:
            want = bag(words(t))
            n = len(words(t))
            weigh = lambda x: 1 / held[x] if x in want else 1.0  # noqa: B023, E731
            for q in range(max(len(w) - n, 0) + 1):
                own = bag(w[q : q + n]) if n >= 5 else Counter([tuple(w[q : q + n])])
                both = sum(weigh(x) * min(c, own[x]) for x, c in want.items())
                total = sum(weigh(x) * c for x, c in want.items()) + sum(weigh(x) * c for x, c in own.items()) - both
                if n and both and both / total >= 0.8:
                    out[doc_id, item_id] = max(out.get((doc_id, item_id), 0), round(both / total, 4))
    return out


def test_matches(spark):
    rnd = np.random.RandomState(6)
    vocabulary = [f"{a}{b}" for a in "bcdfghjklm" for b in ("an", "er", "ti", "on", "es")]
    text = lambda n: " ".join(rnd.choice(vocabulary, n))
    items = [(i, text(n)) for i, n in enumerate([12, 14, 20, 36, 36, 40, 61, 300])] + [(90, None), (91, "!"), (92, "Rare trio here")]
    docs = []
    for i in range(80):
        t = text(rnd.randint(0, 90))
        if i % 2:
            w = items[rnd.randint(8)][1].split()
            if i % 4 == 1:
                w[rnd.randint(len(w))] = "changed"
            t += " - " + ", ".join(w).upper() + "\n" + text(rnd.randint(0, 30))
        docs.append((i, t))
    docs += [(200, items[3][1]), (201, None), (202, ""), (None, "x " + items[4][1]), (203, "a rare  TRIO, here it is")]
    table = spark.createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, item_id int").repartition(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = plain(docs, items)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in dec.find(table, bench).collect()}
    assert got == want and len(want) > 20
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in dec.find(table, bench, items=3).collect()} == want  # whatever the blocks
    kept = {r["doc_id"] for r in dec.drop(table, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}
    assert dec.find(table.limit(0), bench).count() == 0 and dec.find(table, bench.limit(0)).count() == 0


def test_recall_on_cuts_insertions_and_deletions():
    """Edited passages of items of 12 to 160 words: every one that brute force finds is found, with its similarity, and no other."""
    rnd = np.random.RandomState(31)
    text = lambda n: [f"w{x}" for x in rnd.randint(0, 4_000, n)]
    items = [(i, " ".join(text(int(n)))) for i, n in enumerate(rnd.choice([12, 25, 50, 100, 160], 30))] + [(30, " ".join(text(40) + ["same"] * 12)), (31, " ".join(text(40) + ["same"] * 12))]
    docs = []
    for i in range(240):
        w = items[rnd.randint(32)][1].split()
        for _ in range(rnd.randint(0, 1 + len(w) // 30)):
            at, kind = rnd.randint(len(w)), rnd.randint(3)
            w[at : at + (kind != 0)] = [] if kind == 1 else text(1)
        cut = rnd.randint(0, 1 + len(w) // 12)
        docs.append((i, " ".join(text(rnd.randint(0, 150)) + w[cut:] + text(rnd.randint(0, 60)))))
    got = dec.Items(items).matches(next(dec.chunks(pa.array([t for _, t in docs])))[2])
    want = plain(docs, items)
    assert {k: round(s, 4) for k, (s, _) in got.items()} == want and len(want) > 100


def test_passages_with_far_fingerprints_are_found():
    rnd = np.random.RandomState(21)
    text = lambda n: [f"w{x}" for x in rnd.randint(0, 10**6, n)]
    items = [(i, " ".join(text(int(n)))) for i, n in enumerate([30, 60, 100, 120] * 5)]
    words = text(4_000)
    chunk = dec._chunk([" ".join(words)])
    marks = dec.Lanes(chunk.hash).simhash(np.arange(4_000), np.ones(4_000, np.int64))
    docs = []
    for _, item in items:
        w, own = item.split(), dec._chunk([item])
        far = np.argsort(-np.bitwise_count(marks ^ dec.Lanes(own.hash).simhash(np.zeros(1, np.int64), np.array([len(w)]))).astype(np.int64), kind="stable")
        n = (len(w) - 4) // 9 - 1
        other = [words[k] for k in far[: 140 + n]]
        docs.append(" ".join(other[n : n + 70] + other[:n] + w[n:] + other[n + 70 :]))
    want = {(k, k) for k, t in enumerate(docs) if plain([(k, t)], [items[k]])}
    got = dec.Items(items).matches(next(dec.chunks(pa.array(docs)))[2])
    assert len(want) == len(items) and want == set(got)
