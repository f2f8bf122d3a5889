"""Whole-batch text arithmetic with numpy: words, their hashes and n-grams, without a Python loop per word.

A word is a maximal run of letters and digits, compared in lower case (one code point at a time, so
that offsets stay those of the text). A word's hash is a polynomial over random 64-bit values of its code
points, taken from prefix sums; an n-gram's hash is a polynomial over the word hashes. Equal words and
n-grams have equal hashes in every process; different ones collide with probability about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

_TOP = 0x110000
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    alnum = np.fromiter((chr(c).isalnum() for c in range(_TOP)), np.bool_, _TOP)
    lower = np.arange(_TOP, dtype=np.uint32)
    for c in np.flatnonzero(alnum).tolist():
        low = chr(c).lower()
        if len(low) == 1:
            lower[c] = ord(low)
    value = mix64(lower.astype(_U) * _U(0x9E3779B97F4A7C15) + _U(0x632BE59BD9B4E019))
    return alnum, lower, value


_BASE = 0x5851F42D4C957F2D
_BASE_INV = pow(_BASE, -1, 1 << 64)


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _BASE, _U)
    down = np.full(size, _BASE_INV, _U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Words:
    """The words of a list of texts (None counts as empty).

    doc, start, end: text number and code point offsets within that text (end exclusive);
    hash: the word's hash; first: for each text the index of its first word, with a closing entry.
    """

    def __init__(self, texts: list[str | None]):
        alnum, _, value = _tables()
        texts = ["" if t is None else t for t in texts]
        joined = "\0".join(texts) + "\0"
        cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        base = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(lens + 1, out=base[1:])
        inside = alnum[cp]
        edge = np.flatnonzero(np.diff(inside, prepend=np.False_, append=np.False_))
        s, e = edge[0::2], edge[1::2]
        size = 1 << max(12, int(len(cp) + 1).bit_length())
        up, down = _powers(size)
        sums = np.zeros(len(cp) + 1, _U)
        np.cumsum(np.where(inside, value[cp], _U(0)) * up[: len(cp)], out=sums[1:])
        self.hash = mix64((sums[e] - sums[s]) * down[s] + _U(1))
        self.doc = np.searchsorted(base, s, side="right") - 1
        self.start = s - base[self.doc]
        self.end = e - base[self.doc]
        self.n_texts = len(texts)
        self.lens = lens
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        self.cp, self.base = cp, base

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every k consecutive words of one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, _U)
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 : k - 1 + n])
        h = np.zeros(n, _U)
        for j in range(k):
            h = h * _U(0xD6E8FEB86659FD93) + self.hash[j : j + n]
        return at, mix64(h[at])


def chunks(table: pa.Table | pa.RecordBatch, column: str, chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no piece holds more than about ``chars`` characters of text, one row at least."""
    col = table.column(column)
    if table.num_rows == 0:
        return
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    part = np.cumsum(size) // chars
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), table.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield table.slice(a, b - a)


def signed(x: np.ndarray) -> np.ndarray:
    """Hashes as the bigint that Spark stores."""
    return x.view(np.int64)


def distinct_per_text(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, hash) pairs, ordered by text and then hash."""
    if len(h) == 0:
        return doc, h
    order = np.lexsort((h, doc))
    d, v = doc[order], h[order]
    keep = np.ones(len(d), np.bool_)
    keep[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
    return d[keep], v[keep]
