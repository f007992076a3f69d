"""A cache of token ids of text pieces, looked up for whole batches at once (numpy, inside tasks).

Tokens of the vocabularies used here never cross the border between a
non-space character and white space.  Texts are cut there (at ASCII white
space; other white space stays inside a piece) and each piece is known by a
128-bit hash.  Only pieces that the cache lacks become Python strings and
go to the encoder; all others are gathered from one array of ids.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from lakeshard.llm.hashing import _power_tables, mix

#: pieces kept; when there are more, those not used since the last time go
LIMIT = 1_000_000
#: bytes of text that are looked up at once, about
TEXT_BYTES = 4 << 20
_SLICE = (1 << 20) - (1 << 14)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_ONE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB))
_TWO = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x8EBC6AF09C88C6E3))


def _after_wide_space(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each of ``at`` is one of the white-space characters beyond ASCII."""
    c, b, a = (np.where(at >= k, buf[np.maximum(at - k, 0)], 0) for k in (1, 2, 3))
    two = (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
    general = (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    rest = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    return two | general | rest


def cuts(buf: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Where pieces begin: at the starts of (non-empty) texts, and at white space after other characters."""
    space = _SPACE[buf]
    begins = np.zeros(len(buf), bool)
    begins[1:] = space[1:] & ~space[:-1]
    wide = np.flatnonzero(begins[1:] & (buf[:-1] >= 0x80)) + 1
    begins[wide[_after_wide_space(buf, wide)]] = False
    begins[docs] = True
    return np.flatnonzero(begins)


def hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each piece."""
    one, two = np.empty(len(start), np.uint64), np.empty(len(start), np.uint64)
    first = 0
    with np.errstate(over="ignore"):
        while first < len(start):
            last = max(first + 1, int(np.searchsorted(start, start[first] + _SLICE)))
            lo, hi = int(start[first]), int(end[last - 1])
            piece, s, e = buf[lo:hi], start[first:last] - lo, end[first:last] - lo
            up, down = _power_tables(hi - lo)
            total = np.zeros(hi - lo + 1, np.uint64)
            for table, out in ((_ONE, one), (_TWO, two)):
                np.cumsum(table[piece] * up[: hi - lo], out=total[1:])
                out[first:last] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
            first = last
    return one, two


class ChunkCache:
    """``learn`` turns new pieces (strings) into their ids (int32 bytes, one of each piece)."""

    def __init__(self, learn: Callable[[list[str]], list[bytes]], limit: int = LIMIT):
        self._learn, self._limit = learn, limit
        self._clear()

    def _clear(self) -> None:
        self._one, self._two = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self._at, self._n, self._used = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self._ids = np.zeros(0, np.int32)

    def _purge(self) -> None:
        keep = np.flatnonzero(self._used)
        if len(keep) > 0.9 * self._limit:
            return self._clear()
        n = self._n[keep]
        self._ids = self._ids[_ranges(self._at[keep], n)]
        self._one, self._two, self._n = self._one[keep], self._two[keep], n
        self._at, self._used = np.cumsum(n) - n, np.zeros(len(keep), bool)

    def _add(self, pos: np.ndarray, one: np.ndarray, two: np.ndarray, rows: list[bytes]) -> np.ndarray:
        n = np.fromiter((len(r) >> 2 for r in rows), np.int64, len(rows))
        at = len(self._ids) + np.cumsum(n) - n
        self._ids = np.concatenate((self._ids, np.frombuffer(b"".join(rows), np.int32)))
        for name, new in (("_one", one), ("_two", two), ("_at", at), ("_n", n), ("_used", np.zeros(len(n), bool))):
            setattr(self, name, np.insert(getattr(self, name), pos, new))
        return at, n

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` in order (int32), and how many each text has; null has none."""
        raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        data = b"".join(raw)
        if not data:
            return np.zeros(0, np.int32), np.zeros(len(raw), np.int64)
        if len(self._one) > self._limit:
            self._purge()
        buf = np.frombuffer(data, np.uint8)
        docs = np.cumsum(sizes) - sizes
        start = cuts(buf, docs[sizes > 0])
        end = np.append(start[1:], len(buf))
        one, two = hashes(buf, start, end)
        key, first, which = np.unique(one, return_index=True, return_inverse=True)
        pos = np.searchsorted(self._one, key)
        near = np.minimum(pos, len(self._one) - 1)
        hit = (self._one[near] == key) if len(self._one) else np.zeros(len(key), bool)
        if not (np.array_equal(two, two[first][which]) and np.array_equal(self._two[near[hit]], two[first[hit]])):
            return self._plainly(data, start, end, docs)  # pieces that share one hash, not both
        at, n = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        at[hit], n[hit] = self._at[near[hit]], self._n[near[hit]]
        self._used[near[hit]] = True
        new = np.flatnonzero(~hit)
        if len(new):
            fresh = [data[a:b].decode("utf-8", "surrogatepass") for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)]
            at[new], n[new] = self._add(pos[new], key[new], two[first[new]], self._learn(fresh))
        size = n[which]
        ids = self._ids[_ranges(at[which], size)]
        return ids, self._counts(start, size, docs)

    def _plainly(self, data: bytes, start, end, docs) -> tuple[np.ndarray, np.ndarray]:
        rows = self._learn([data[a:b].decode("utf-8", "surrogatepass") for a, b in zip(start.tolist(), end.tolist(), strict=True)])
        return np.frombuffer(b"".join(rows), np.int32), self._counts(start, np.array([len(r) >> 2 for r in rows]), docs)

    @staticmethod
    def _counts(start: np.ndarray, size: np.ndarray, docs: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(size)))
        edge = np.append(np.searchsorted(start, docs), len(start))
        return np.diff(total[edge])


def _ranges(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The indices ``at[i], at[i] + 1, ... at[i] + n[i] - 1`` of all i, end to end."""
    out = np.repeat(at - (np.cumsum(n) - n), n)
    out += np.arange(len(out))
    return out
