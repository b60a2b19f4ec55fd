"""Repeated substrings against a plain scan over all windows."""

import hashlib

import numpy as np
import pytest

from caesura.llm import substrings

N = substrings.LENGTH


def plain(rows):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - N + 1):
            w = data[i : i + N]
            if w in seen:
                gone[i : i + N] = True
            seen.add(w)
        left = bytes(b for b, x in zip(data, gone, strict=False) if not x)
        out.append((doc_id, len(data), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(left).hexdigest()))
    return out


def made(seed):
    rnd = np.random.RandomState(seed)
    words = ["the", "of", "été", "anat", "with", "by", "a", "漢"]
    text = lambda n: " ".join(rnd.choice(words, n))
    shared = [text(40), text(60), "x" * 250, "ab" * 120]
    rows = []
    for i in range(60):
        t = text(rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 4)):
            s = shared[rnd.randint(4)]
            a = rnd.randint(0, len(s) // 2)
            t += ["", " "][rnd.randint(2)] + s[a : a + rnd.randint(90, 260)] + text(rnd.randint(0, 5))
        rows.append((i, t))
    rows += [(i + 100, rows[i][1]) for i in range(0, 60, 7)] + [(300, None), (301, ""), (None, rows[5][1])]
    return rows


@pytest.mark.parametrize("rows", [made(1), made(2), [*made(3), (3, "tie " * 50), (3, "tie " * 50), (3, None)], []])
def test_against_plain(spark, rows, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK", 2_000)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, uid string, h int").repartition(3)
    got = [tuple(r) for r in substrings.deduplicate(docs).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)
