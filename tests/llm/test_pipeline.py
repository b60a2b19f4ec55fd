"""The pipeline on a small corpus against a plain version of its stages."""

import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from caesura.llm.tokens import Encoder, default_path


@pytest.fixture
def sf_dir(spark, tmp_path):
    rnd = np.random.RandomState(4)
    common = ["the", "of", "and", "to", "in", "is", "was", "for"]
    rare = [f"{a}{b}" for a in ("nation", "water", "run", "quick", "stone", "tree") for b in ("hood", "s", "ing", "ly", "er", "ed", "al", "ish")]
    text = lambda n: " ".join(rnd.choice(common if rnd.rand() < 0.4 else rare) for _ in range(n))
    item, key = text(30), "9c8b45435718dcc700c184a7e303cdc64c6a8f7f"
    clean = [(i, text(140)) for i in range(30)]
    near = [(100 + i, clean[i][1].replace(clean[i][1].split()[70], "changed", 1)) for i in range(3)]
    rows = clean + [(50, clean[3][1]), *near, (200, text(80) + " " + item + " " + text(40)), (201, text(100) + f' token = "{key}" ' + text(20)), (202, "##$$ &&% " * 120), (203, "short"), (204, None)]
    docs = spark.createDataFrame([(i, t, "en", "src1", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), dict(rows), key


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)}


def test_pipeline(spark, sf_dir):
    path, rows, key = sf_dir
    kept = {i: t for i, t in rows.items() if i < 200 or i in (200, 201)}
    sets = {i: shingles(t) for i, t in kept.items()}
    part = {i: i for i in kept}
    for i in sorted(kept):
        for j in sorted(kept):
            if j < i and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                low, high = sorted((part[i], part[j]))
                part = {k: low if p == high else p for k, p in part.items()}
    want = {i: t.replace(key, "[SECRET]") for i, t in kept.items() if part[i] == i and i != 200}
    got = {}
    for r in corpus_pipeline.run(spark, path).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"]))
    own = Encoder(default_path("byte_bpe_50k.json")).whole
    assert sorted(got) == sorted(want)
    for i, text in want.items():
        ids = own.encode(text, add_special_tokens=False).ids + [0]
        assert sorted(got[i]) == [(s, len(ids[s : s + 1024]), zlib.crc32(np.array(ids[s : s + 1024], "<u4").tobytes())) for s in range(0, len(ids), 1024)]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == columns
