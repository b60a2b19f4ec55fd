"""Fast exact encoding with the public tokenizer files: every distinct piece of text is encoded once.

Both tokenizers cut a text into pieces by a pattern and encode each piece on its own. The pieces are found for
many texts at once with numpy over code points; distinct pieces are found by Arrow's dictionary encoding and only
those not seen before go through the tokenizers library's model. Texts with characters outside FAST (and, for byte-level vocabularies, outside
MARKS), where case and composition depend on context or on Unicode versions, are encoded whole by the library; the other texts
of a slice don't wait for them.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from caesura.llm.memory import give_back

#: Code points below this, but U+0000 and U+0130, take the fast way.
FAST = 0x250
#: Code points that are classified at once.
BLOCK = 1 << 18
#: At most so many pieces are remembered; then all are forgotten.
CACHE = 700_000
#: Ranges of typographic marks and currency signs: neither letters nor numbers nor spaces.
MARKS = ((0x2010, 0x2027), (0x2030, 0x205E), (0x20A0, 0x20C0))
SPACES = [0x20, 0x85, 0xA0, *range(0x09, 0x0E)]


def _classes() -> np.ndarray:
    """0 space, 1 letter, 2 number, 3 other, 4 nothing: a text's end."""
    kinds = {"L": 1, "N": 2}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], 3) for c in range(FAST)], np.uint8)
    out[SPACES] = 0
    out[0] = 4
    return out


CLASS = _classes()


def _slow(marks: bool) -> str:
    """A pattern for what doesn't take the fast way."""
    return "[\\x{0}\\x{130}]|[^\\x{0}-\\x{%x}%s]" % (FAST - 1, "".join("\\x{%x}-\\x{%x}" % m for m in MARKS) if marks else "")



def default_path(name: str) -> str:
    """The installed file of a public tokenizer; other places can be given wherever a path is a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_chars() -> list[str]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Encoder:
    """ids of texts under one tokenizer file, as tokenizers.Tokenizer.encode(text, add_special_tokens=False) gives them."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.model = self.whole.model
        self.spaced = self.whole.normalizer is None  # pieces carry the space before them; else spaces are dropped and case is folded
        self.slow = _slow(self.spaced)
        self.chars = str.maketrans({b: c for b, c in enumerate(_byte_chars())})
        self.forget()

    def forget(self) -> None:
        self.slot: dict[bytes, int] = {b"": 0}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.ends, self.n_ends = np.zeros(1 << 12, np.int64), 2

    def vocabulary_bytes(self) -> np.ndarray:
        """By id, how many bytes of text a token of a byte-level vocabulary stands for."""
        vocab = self.whole.get_vocab()
        out = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            out[i] = len(token)
        return out

    def _starts(self, c: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Where pieces (and dropped gaps) begin in the code points c, texts being divided by code point 0."""
        n = len(c)
        before, after = np.full(n, 4, np.uint8), np.full(n, 4, np.uint8)
        before[1:], after[:-1] = kind[:-1], kind[1:]
        start = kind != before
        if self.spaced:
            last = (kind == 0) & (after != 0) & (after != 4)  # of a run of spaces before a word
            start |= last
            joined = np.flatnonzero(last & (c == 0x20)) + 1
            start[joined] = False
        else:
            start |= kind == 2
        start |= kind == 4
        quote = np.flatnonzero((c == 0x27) & start & (after == 1))
        for size, endings in ((2, ("s", "t", "m", "d")), (3, ("re", "ve", "ll"))):
            for x in endings:
                at = quote[quote + size <= n]
                for k, letter in enumerate(x):
                    at = at[c[at + 1 + k] == ord(letter)]
                start[at + 1] = False
                rest = at[at + size < n] + size
                start[rest] |= kind[rest] == 1
                quote = np.setdiff1d(quote, at, assume_unique=True)
        start[:1] = True
        return start

    def _learn(self, pieces: list[bytes]) -> None:
        tokenize, chars = self.model.tokenize, self.chars
        got = [[t.id for t in tokenize(p.decode("latin-1").translate(chars))] for p in pieces]
        flat = np.fromiter((i for ids in got for i in ids), np.uint32)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        first = self.n_ends - 1
        while self.n_ends + len(got) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ends[self.n_ends : self.n_ends + len(got)] = np.cumsum([len(ids) for ids in got], dtype=np.int64) + self.used
        self.n_ends += len(got)
        self.used += len(flat)
        self.slot.update(zip(pieces, range(first, first + len(pieces)), strict=True))

    def _fast(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.spaced:
            texts = pc.utf8_lower(texts)
        joined = "\0".join(texts.to_pylist()) + "\0"
        c = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind = np.empty(len(c), np.uint8)
        for i in range(0, len(c), BLOCK):  # an index takes 8 bytes a code point
            kind[i : i + BLOCK] = CLASS[np.minimum(c[i : i + BLOCK], FAST - 1)]
        kind[c >= FAST] = 3
        at = np.flatnonzero(self._starts(c, kind))
        data = joined.encode()
        place = np.zeros(len(c) + 1, np.int32 if len(data) < 2**31 else np.int64)  # of code points, in bytes
        np.cumsum(1 + (c >= 0x80).view(np.int8) + (c >= 0x800), out=place[1:])
        edges = np.append(place[at], place[-1]).astype(np.int64)
        stops = np.flatnonzero(kind[at] == 4) + 1
        del joined, c, kind, place
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(edges), pa.py_buffer(data)]).dictionary_encode()
        values = found.dictionary.to_pylist()
        empty = {b"\0"} if self.spaced else {v for v in values if v == b"\0" or not v.decode().strip("\t\n\x0b\x0c\r \x85\xa0")}
        if len(self.slot) > CACHE:
            self.forget()
        if new := [v for v in values if v not in self.slot and v not in empty]:
            self._learn(new)
        slot = np.fromiter((0 if v in empty else self.slot[v] for v in values), np.int64, len(values))
        code = slot[found.indices.to_numpy(zero_copy_only=False)]
        table = pa.LargeListArray.from_arrays(pa.array(self.ends[: self.n_ends]), pa.array(self.ids[: self.used]))
        taken = table.take(pa.array(code))
        edge = taken.offsets.to_numpy()[np.concatenate([[0], stops])]
        return taken.flatten().to_numpy(zero_copy_only=False), edge - edge[0]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the n + 1 offsets of the texts' ids. A null text counts as empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        slow = pc.match_substring_regex(texts, self.slow).to_numpy(zero_copy_only=False)
        if not slow.any():
            return self._fast(texts)
        whole = [e.ids for e in self.whole.encode_batch(texts.filter(pa.array(slow)).to_pylist(), add_special_tokens=False)]
        flat, edge = self._fast(texts.filter(pa.array(~slow))) if not slow.all() else (np.zeros(0, np.uint32), np.zeros(1, np.int64))
        size = np.zeros(len(texts), np.int64)
        size[slow], size[~slow] = [len(ids) for ids in whole], np.diff(edge)
        at = np.concatenate([[0], np.cumsum(size)])
        out, own = np.empty(at[-1], np.uint32), np.repeat(slow, size)
        out[own], out[~own] = [i for ids in whole for i in ids], flat
        return out, at


def slices(texts: pa.Array, size: int = 3_000_000) -> Iterator[tuple[int, int]]:
    """(from, to) of rows with about size bytes of text each; a longer text comes alone."""
    lengths = np.concatenate([[0], np.cumsum(pc.binary_length(texts.cast(pa.large_string())).fill_null(0).to_numpy(zero_copy_only=False))])
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(lengths, lengths[i] + size, "right")) - 1)
        yield i, j
        give_back()
        i = j


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
