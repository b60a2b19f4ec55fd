"""Secret scans: candidates by pattern, and a random forest that takes out the false ones.

A candidate is a run of 16 or more characters of keys, tokens and encodings (with or without digits), three such runs joined by
dots, what follows an assignment to a word for secrets or "Bearer", a web token (its dotted parts together), or a private key from
its BEGIN line to its END line (without one, to the end of the lines of its encoding). The last two are secrets by their form. Of
the others, the forest sees its length, the transitions between kinds of characters in it, how much of
it dictionary words cover, its path (the file or source a document came from) and the words beside it. It is trained
here, from labelled findings: a table given by the caller (at most MAX_LABELLED rows of it, by hash order) or, by default, findings
made from a seed. Scores are shares of trees; a finding with THRESHOLD or more is a secret.

Whole texts are scanned, however long. A null text has no candidates; null paths, or a table without that column, count as empty; rows are scanned one by one, so repeated
rows give repeated findings. Empty tables give empty results; extra columns are ignored (in redact(), carried).
"""

from __future__ import annotations

import functools
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TREES, DEPTH, THRESHOLD, MAX_LABELLED = 25, 8, 0.5, 5_000
HINTS = ("api_key", "apikey", "access_key", "auth", "bearer", "credential", "key", "passwd", "password", "pwd", "secret", "token")
DUMMIES = ("changeme", "checksum", "commit", "digest", "dummy", "example", "hash", "id", "placeholder", "sample", "sha", "sha1", "test", "uuid", "version", "your")
ASSIGNED = r"(?:api[_-]?key|apikey|access[_-]?key|auth|credential|passwd|password|pwd|secret|token|(?<![a-z])key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?"
#: A private key as far as its END line, if that comes before the next BEGIN; else its headers and the lines of its encoding.
_BEGIN, _LINE = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY(?: BLOCK)?-----", r"(?:[ \t]*(?:\r?\n|\\r|\\n)[ \t]*|[ \t]+)"
_PEM = rf"{_BEGIN}(?:(?:(?!-----BEGIN )[\s\S])*?-----END [A-Z ]{{0,20}}PRIVATE KEY(?: BLOCK)?-----|(?:\r?\n[A-Za-z-]+: [^\r\n]*)*(?:{_LINE}{{1,2}}[A-Za-z0-9+/]{{16,}}={{0,2}})*(?:\r?\n[A-Za-z0-9+/]{{1,15}}={{0,2}}(?=\s|$))?)"
_JWT = r"(?<![A-Za-z0-9+/_=-])eyJ[A-Za-z0-9_-]{5,}(?:\.[A-Za-z0-9_-]*){2,4}"
_DOTTED = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]{16,}"
CANDIDATE = re.compile(rf"(?P<pem>{_PEM})|(?P<jwt>{_JWT})|(?i:{ASSIGNED}|(?<![a-z])bearer\s{{1,3}})(?P<value>(?!-----BEGIN |eyJ[\w-]{{5,}}\.)[^\s\"']{{8,}})|{_DOTTED}|(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{16,}}")
KINDS = np.full(128, 4)
for _k, _members in enumerate((string.ascii_lowercase, string.ascii_uppercase, string.digits, "+/=_-")):
    KINDS[[ord(c) for c in _members]] = _k
#: Pieces of words by which candidates are taken for ordinary text.
PIECES = ("able", "and", "ation", "con", "data", "en", "er", "ers", "file", "for", "ing", "ion", "is", "ly", "ment", "name", "ness", "of", "or", "out", "pre", "re", "st", "th", "the", "ti", "tion", "user", "with")
#: Syllables of words that hold few of the pieces.
SYLLABLES = ("ado", "ber", "bil", "cate", "cer", "cha", "ción", "com", "das", "eau", "ein", "fi", "gen", "hei", "ie", "ities", "keit", "lich", "lo", "ma", "mo", "na", "per", "pol", "qui", "ra", "rou", "sa", "sch", "tifi", "tra", "tz", "un", "ung", "va", "ver", "zu")
_PIECE = re.compile("|".join(sorted(PIECES, key=len, reverse=True)))


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what may be secrets."""
    out = []
    for m in CANDIDATE.finditer(text):
        if m["value"] is not None:
            out.append((*m.span("value"), "assigned"))
        else:
            out.append((*m.span(), "private_key" if m["pem"] else "web_token" if m["jwt"] else "run"))
    return out


def features(value: str, before: str, after: str, path: str) -> list[float]:
    """What the forest sees of one candidate; before and after are the text beside it."""
    codes = KINDS[np.minimum(np.frombuffer(value.encode("latin-1", "replace"), np.uint8), 127)]
    moves = np.bincount(codes[:-1] * 5 + codes[1:], minlength=25) / max(len(codes) - 1, 1)
    lower = value.lower()
    counts = np.unique(np.frombuffer(lower.encode(), np.uint8), return_counts=True)[1] / max(len(lower.encode()), 1)
    near = re.findall(r"[a-z0-9_]+", before.lower())[-3:]
    beside = re.findall(r"[a-z0-9_]+", after.lower())[:2]
    return [
        float(len(value)), float(-(counts * np.log2(counts)).sum()), sum(map(len, _PIECE.findall(lower))) / max(len(value), 1),
        float(any(w in HINTS for w in near)), float(any(w in DUMMIES for w in near + beside)), float(before.rstrip()[-1:] in ("=", ":", '"', "'")),
        float(bool(re.search(r"test|example|sample|doc|lock", path.lower()))), float(value.count("/")), float(bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value))), float(value[:4] in ("AKIA", "ghp_", "xoxb", "eyJh", "sk_l", "----")), *moves.tolist(),
    ]


class Forest:
    """Decision trees on bootstrap samples, each split the best of a random few features by Gini impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 11):
        self.rnd, self.depth = np.random.RandomState(seed), depth
        self.trees = []
        for _ in range(trees):
            own = self.rnd.randint(0, len(x), len(x))
            self.trees.append(self._grow(x[own], y[own], 0))

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int):
        share = float(y.mean())
        if depth == self.depth or len(y) < 4 or share in (0.0, 1.0):
            return share
        best = None
        for f in self.rnd.choice(x.shape[1], max(2, int(x.shape[1] ** 0.5)), replace=False):
            order = np.argsort(x[:, f], kind="stable")
            v, up = x[order, f], np.cumsum(y[order])
            cut = np.flatnonzero(v[1:] > v[:-1]) + 1
            if len(cut):
                p, q = up[cut - 1] / cut, (up[-1] - up[cut - 1]) / (len(y) - cut)
                impurity = cut * p * (1 - p) + (len(y) - cut) * q * (1 - q)
                k = int(impurity.argmin())
                if best is None or impurity[k] < best[0]:
                    low, high = float(v[cut[k] - 1]), float(v[cut[k]])
                    best = (impurity[k], int(f), (low + high) / 2 if (low + high) / 2 < high else low)
        if best is None:
            return share
        left = x[:, best[1]] <= best[2]
        return best[1], best[2], self._grow(x[left], y[left], depth + 1), self._grow(x[~left], y[~left], depth + 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for tree in self.trees:
            todo = [(tree, np.arange(len(x)))]
            while todo:
                node, own = todo.pop()
                if not isinstance(node, tuple):
                    out[own] += node
                elif len(own):
                    left = x[own, node[0]] <= node[1]
                    todo += [(node[2], own[left]), (node[3], own[~left])]
        return out / len(self.trees)


def made_findings(n: int = 3_000, seed: int = 5) -> list[tuple[str, str, str, str, int]]:
    """(value, before, after, path, label) of findings made from a seed: half secrets, half what is mistaken for them."""
    rnd = np.random.RandomState(seed)
    pick = lambda letters, k: "".join(rnd.choice(list(letters), k))
    hexa, full = "0123456789abcdef", string.ascii_letters + string.digits
    prose = lambda: " ".join("".join(rnd.choice(PIECES, rnd.randint(1, 4))) for _ in range(4))
    out = []
    for k in range(n):
        path, before, after = str(rnd.choice(["src/app.py", "config/settings.yml", "src3", "notes.txt", ""])), prose() + " ", " " + prose()
        kind = rnd.randint(6)
        if k % 2:
            name = str(rnd.choice([h for h in HINTS if h != "bearer"]))
            before += rnd.choice([f"{name} = \"", f"{name}: ", f"{name}='", f"{name.upper()} = \""])
            value = (pick(hexa, 40), "AKIA" + pick(string.ascii_uppercase + string.digits, 16), "ghp_" + pick(full, 36), pick(full, rnd.randint(20, 64)), pick(full + "+/", 40), pick(hexa, rnd.choice([32, 64])).upper())[kind]
            if kind in (1, 2) and rnd.rand() < 0.5:
                before = prose() + " "
        else:
            value = (pick(hexa, 40), "-".join(pick(hexa, j) for j in (8, 4, 4, 4, 12)), pick(string.digits, rnd.randint(16, 20)), "_".join("".join(rnd.choice(PIECES, 2)) for _ in range(4)) + "1", "/".join("".join(rnd.choice(PIECES, 2)) for _ in range(4)) + "/v2", "".join(rnd.choice(PIECES, rnd.randint(3, 8))))[kind]
            before += ("commit ", "id: ", "", "", "see ", "token = \"" if rnd.rand() < 0.3 else "")[kind] if rnd.rand() < 0.8 else rnd.choice(["sha1 ", "checksum ", "example key = \""])
            if before.endswith("example key = \""):
                path = "docs/example.md"
        out.append((value, before, after, path, k % 2))
    return out


def made_without_digits(n: int = 4_000, seed: int = 6) -> list[tuple[str, str, str, str, int]]:
    """Like made_findings(), of runs that mostly have no digit, and of dotted ones."""
    rnd = np.random.RandomState(seed)
    pick = lambda letters, k: "".join(rnd.choice(list(letters), k))
    full, url = string.ascii_letters + string.digits, string.ascii_letters + string.digits + "-_"
    word = lambda a=1, b=4: "".join(rnd.choice(PIECES, rnd.randint(a, b)))
    prose = lambda: " ".join(word() for _ in range(4))
    foreign = lambda a, b: "".join(rnd.choice(SYLLABLES + PIECES, rnd.randint(a, b))).replace("ó", "")
    out = []
    for k in range(n):
        before, after, kind = prose() + " ", rnd.choice([" ", ". ", ", ", "!! "]) + prose(), rnd.randint(8)
        if k % 2:
            value = (pick(string.ascii_letters, rnd.randint(16, 64)), pick(string.ascii_lowercase, rnd.randint(20, 64)), pick(string.ascii_uppercase, rnd.randint(20, 64)), ".".join(pick(url, j) for j in (24, 6, 27)), pick(string.ascii_letters, 40), pick(full, 40), pick(string.ascii_letters + "+/", 44), pick(string.ascii_letters, rnd.randint(16, 30)))[kind]
            before += rnd.choice(["", "", "Bearer ", "key = ", "token: ", "secret=\""])
        else:
            value = (rnd.choice([word(6, 12), foreign(5, 10), foreign(3, 6)]), rnd.choice([word(6, 12), foreign(5, 10)]), pick("-=_", 1) * rnd.randint(16, 80), "-".join(word(1, 3) for _ in range(6)), "/".join(word(1, 4) for _ in range(7)), "_".join(word(1, 3).upper() for _ in range(6)), "".join(word(1, 3).capitalize() for _ in range(6)), f"{word(7, 10)}.{word(2, 4)}.{word(7, 10)}")[kind]
            if kind < 2 and (case := rnd.randint(4)) < 2:
                value = value.upper() if case else value.capitalize()
            before += rnd.choice(["", "", "", "bearer ", "the key = ", "auth: "], p=[0.3, 0.3, 0.2, 0.1, 0.05, 0.05])
        out.append((value, before, after, str(rnd.choice(["src/app.py", "src3", "notes.txt", ""])), k % 2))
    return out


def train(labelled: DataFrame | None = None) -> Forest:
    """A forest from labelled findings (value, before, after, path, label): at most MAX_LABELLED rows, by hash order."""
    if labelled is None:
        return _default()
    bounded = labelled.orderBy(F.xxhash64("value", "before", "after", "path", "label")).limit(MAX_LABELLED)
    rows = [(r["value"] or "", r["before"] or "", r["after"] or "", r["path"] or "", int(r["label"])) for r in bounded.collect()]
    if not rows:
        raise ValueError("no labelled findings")
    return _fitted(rows)


@functools.cache
def _default() -> Forest:
    return _fitted(made_findings() + made_without_digits())


def _fitted(rows: list[tuple[str, str, str, str, int]]) -> Forest:
    return Forest(np.array([features(*r[:4]) for r in rows]), np.array([r[4] for r in rows], float))


def judged(text: str, path: str, forest: Forest) -> list[tuple[int, int, str, float]]:
    found = candidates(text)
    if not found:
        return []
    scores = forest.score(np.array([features(text[a:b], text[max(0, a - 60) : a], text[b : b + 40], path) for a, b, _ in found]))
    return [(a, b, kind, 1.0 if kind in ("private_key", "web_token") else float(s)) for (a, b, kind), s in zip(found, scores, strict=True)]


def _path(docs: DataFrame, path: str) -> Column:
    return F.col(path).cast("string") if path in docs.columns else F.lit("")


FINDINGS = "doc_id long, start_char long, end_char long, kind string, score double, is_secret boolean"


def scan(docs: DataFrame, forest: Forest | None = None, path: str = "source", threshold: float = THRESHOLD) -> DataFrame:
    """A row a candidate, with its place (code points), its score and the verdict."""
    model = forest or train()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(doc, a, b, kind, round(s, 4), s >= threshold) for doc, text, place in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True) for a, b, kind, s in judged(text.as_py() or "", place or "", model)]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True) if out else [[]] * 6, kinds, strict=True)], names=[x.split()[0] for x in FINDINGS.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), _path(docs, path)).mapInArrow(find, FINDINGS)


def redact(docs: DataFrame, forest: Forest | None = None, path: str = "source", threshold: float = THRESHOLD, mark: str = "[SECRET]") -> DataFrame:
    """docs with each secret in text replaced by the mark; all columns and rows stay."""
    from pyspark.sql.functions import pandas_udf

    model = forest or train()

    @pandas_udf("string")
    def clean(texts, places):
        def one(text, place):
            for a, b, _, s in reversed(judged(text or "", place or "", model)):
                if s >= threshold:
                    text = text[:a] + mark + text[b:]
            return text

        return texts.combine(places, one)

    return docs.withColumn("text", clean(F.col("text").cast("string"), _path(docs, path)))
