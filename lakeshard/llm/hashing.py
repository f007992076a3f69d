"""Vectorised 64-bit hashes of words and word n-grams (numpy, inside tasks).

Words are maximal runs of bytes outside ``0x20`` and ``0x09-0x0D``, which is
the pattern ``[^\\x20\\x09-\\x0D]+`` on UTF-8 text.  A word's hash is a
polynomial over per-byte random values; it depends on the word alone, not on
its place, its batch or the machine.
"""

from __future__ import annotations

import numpy as np

_SLICE = 1 << 20
_P = 0x9E3779B97F4A7C15
_M64 = (1 << 64) - 1
_INV = pow(_P, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_RANDOM = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_FOLDED = _RANDOM.copy()
_FOLDED[65:91] = _RANDOM[97:123]
_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_WORD = (~_SEP).astype(np.int8)
_CLASS = _WORD.copy()
_CLASS[[c for c in range(128) if not chr(c).isalnum() and not _SEP[c]]] = 2
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(_SLICE, 1 << int(n - 1).bit_length())
    if size not in _powers:
        with np.errstate(over="ignore"):
            up = np.full(size, _P, dtype=np.uint64)
            down = np.full(size, _INV, dtype=np.uint64)
            up[0] = down[0] = 1
            up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size > _SLICE:  # one giant word; not worth keeping
            return up, down
        _powers[size] = (up, down)
    return _powers[size]


def _slices(buf: np.ndarray):
    """Cut ``buf`` after separators into pieces of about ``_SLICE`` bytes; words are never cut."""
    at, n = 0, len(buf)
    while at < n:
        end = min(at + _SLICE, n)
        if end < n:
            seps = np.flatnonzero(_SEP[buf[at:end]])
            if len(seps):
                end = at + int(seps[-1]) + 1
            else:
                step = _SLICE
                while end < n:
                    seps = np.flatnonzero(_SEP[buf[end:end + step]])
                    if len(seps):
                        end += int(seps[0]) + 1
                        break
                    end = min(n, end + step)
        yield at, buf[at:end]
        at = end


def word_hashes(texts, fold: bool = False, punct: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and the number of words of each text.

    ``fold`` lower-cases A-Z first; ``punct`` makes runs of ASCII punctuation
    words of their own.  Null texts have no words.
    """
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    lengths = np.fromiter((len(b) + 1 for b in raw), dtype=np.int64, count=len(raw))
    buf = np.frombuffer(b"\n".join(raw) + b"\n" if raw else b"", dtype=np.uint8)
    table, kinds = _FOLDED if fold else _RANDOM, _CLASS if punct else _WORD
    out, begins = [], []
    with np.errstate(over="ignore"):
        for at, piece in _slices(buf):
            kind = np.zeros(len(piece) + 2, dtype=np.int8)
            kind[1:-1] = kinds[piece]
            edge = np.flatnonzero(kind[1:] != kind[:-1])
            start, end = edge[kind[edge + 1] != 0], edge[kind[edge] != 0]
            up, down = _power_tables(len(piece))
            total = np.zeros(len(piece) + 1, dtype=np.uint64)
            np.cumsum(table[piece] * up[: len(piece)], out=total[1:])
            h = (total[end] - total[start]) * down[start]
            out.append(mix(h + (end - start).astype(np.uint64)))
            begins.append(start + at)
    words = np.concatenate(out) if out else np.zeros(0, np.uint64)
    begin = np.concatenate(begins) if begins else np.zeros(0, np.int64)
    cut = np.searchsorted(begin, np.concatenate(([0], np.cumsum(lengths))))
    return words, np.diff(cut)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words of one text (empty if it has fewer)."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(size, dtype=np.uint64)
        for j in range(n):
            h = h * np.uint64(0xFF51AFD7ED558CCD) + words[j: j + size]
        return mix(h + np.uint64(n))


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """The sorted set of ``k``-word shingles; a shorter text counts as one, a text without words has none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    s = np.sort(ngram_hashes(words, min(k, len(words))))
    return s[np.concatenate(([True], s[1:] != s[:-1]))]
