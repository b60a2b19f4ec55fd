"""Packing and token attribution against plain versions."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from caesura.llm import attribution, packing
from caesura.llm.tokens import Encoder, default_path

NAME = default_path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, part int, size int"


def made(seed, n):
    rnd = np.random.RandomState(seed)
    words = ["the", "of", "été", "anatomical", "\n", "\n\n", "!?", "漢字", "  "]
    return [(i, " ".join(rnd.choice(words, rnd.choice([0, 3, 50, 700, 3000]))), 1, 1) for i in range(n)] + [(None, "x", 1, 1), (3, None, 1, 1), (4, "same", 1, 1), (4, "same", 1, 1)]


@pytest.mark.parametrize("rows", [made(1, 60), made(2, 5), []])
def test_pack(spark, rows):
    got = packing.pack(spark.createDataFrame(rows, DOCS).repartition(3), NAME, ids=True).collect()
    own = Encoder(NAME).whole
    want = Counter()
    for r in rows:
        ids = own.encode(r[1] or "", add_special_tokens=False).ids + [0]
        want.update((r[0], s, len(ids), tuple(ids[s : s + 1024])) for s in range(0, len(ids), 1024))
    assert Counter((r["doc_id"], r["start"], r["doc_tokens"], tuple(r["ids"])) for r in got) == want
    assert all(r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in got)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(by) == list(range(len(by)))
    for x in by.values():
        x.sort()
        assert [o for o, _ in x] == [sum(n for _, n in x[:k]) for k in range(len(x))] and sum(n for _, n in x) <= 1024
    if len(rows) > 20:
        assert len(by) <= 1.1 * -(-sum(r["length"] for r in got) // 1024) + 1


def test_patterns_hold_the_demand():
    rnd = np.random.RandomState(4)
    demand = {int(s): int(n) for s, n in zip(rnd.permutation(np.arange(1, 21))[:18], rnd.randint(0, 3000, 18), strict=True)}
    plan = packing.patterns(demand, 64)
    held = Counter()
    for times, pattern in plan:
        assert sum(s * n for s, n in pattern.items()) <= 64
        held.update({s: times * n for s, n in pattern.items()})
    assert held == Counter({s: n for s, n in demand.items() if n})
    assert sum(t for t, _ in plan) <= 1.01 * sum(s * n for s, n in demand.items()) / 64 + 1
    assert packing.patterns({}, 64) == []


def test_short_pieces_leave_little_room(spark):
    lengths = np.arange(1, 1025)
    size = packing.size_class(lengths)
    assert (size >= lengths).all() and size.max() == 1024 and (size[:32] == lengths[:32]).all() and len(set(size.tolist())) <= 1024 // 7
    assert (packing.size_class(np.arange(1, 101), 100) <= 100).all()
    rnd = np.random.RandomState(6)
    docs = spark.createDataFrame([(i, None if i % 3 == 0 else "a word " * int(rnd.randint(1, 90))) for i in range(6000)], "doc_id long, text string")
    got = packing.pack(docs, NAME).groupBy().agg(F.sum("length").alias("ids"), F.countDistinct("sequence_id").alias("n"), F.max(F.col("offset") + F.col("length")).alias("most")).head()
    assert got["most"] <= 1024 and got["ids"] > 0.97 * 1024 * got["n"]


@pytest.mark.parametrize("rule", ["first", "last", "largest"])
def test_attribution(spark, rule):
    rows = made(3, 25)
    got = {}
    for r in attribution.count_tokens(spark.createDataFrame([r for r in rows if r[0] != 4], DOCS), NAME, rule).collect():
        got.setdefault(r["doc_id"], {})[r["section"]] = tuple(r)[2:]
    own = Encoder(NAME).whole
    for doc_id, text, *_ in rows:
        if doc_id in (3, 4):
            continue
        lines = text.splitlines(keepends=True) or [""]
        starts = np.cumsum([0] + [len(x) for x in lines])
        count = np.zeros((len(lines), 2), int)
        for a, b in own.encode(text, add_special_tokens=False).offsets:
            touched = [k for k in range(len(lines)) if starts[k] < b and starts[k + 1] > a]
            k = {"first": touched[0], "last": touched[-1], "largest": max(touched, key=lambda k: (min(b, starts[k + 1]) - max(a, starts[k]), -k))}[rule]
            count[k] += (1, len(touched) > 1)
        assert got[doc_id] == {k: (starts[k], starts[k + 1], *count[k]) for k in range(len(lines))}
    assert attribution.count_tokens(spark.createDataFrame([], DOCS), NAME).count() == 0


def test_fields(spark):
    rows = [(1, "title é", "body\ntext here"), (2, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, title string, body string")
    got = {(r["doc_id"], r["section"]): r["n_tokens"] for r in attribution.count_tokens(docs, NAME, fields=["title", "body"]).collect()}
    own = Encoder(NAME).whole
    assert got[1, 0] + got[1, 1] == len(own.encode("title é\nbody\ntext here").ids) and got[1, 0] == len(own.encode("title é\n").ids)
    assert got[2, 1] == 1


def test_attribution_refuses_other_vocabularies(spark):
    with pytest.raises(ValueError, match="byte-level"):
        attribution.count_tokens(spark.createDataFrame([(1, "a")], "doc_id long, text string"), default_path("word_bpe_49k.json"))
