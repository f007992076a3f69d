"""BPE encoding and decoding of word-end vocabularies by backtracking over longest matches.

A vocabulary file (``tokenizers`` JSON: NFC, white space, lower case, a split
pattern, byte-level letters, ``</w>`` word ends) is loaded in each task.

Encoding: an Aho-Corasick automaton over all tokens gives the longest token
at each step of a word.  A pair of neighbouring tokens is compatible if no
merge could have fired across their border before both were complete; that
is looked up in a table filled from the merge trees.  A sequence whose pairs
are all compatible is exactly what the merges give, so the longest matches
stand if all their pairs are compatible.  Otherwise the encoder takes
shorter prefixes, marks ends from which no way leads on, and steps back; each
position fails once at most, so the work is linear in the word's length.

Decoding gathers token texts from one byte table by an offset table.

Texts are cut at white space, which no token crosses; a bounded cache keeps
the ids of pieces seen before.  One pass over whole texts, no shuffle.  The
vocabulary is loaded once a task and goes with its caches when the task ends,
as Python workers live on.

Defined cases: null and empty texts have no tokens and decode to ``""``.
Special tokens written in a text become their ids, as in the library.  A
byte that the vocabulary lacks has no token, as in the library.  An empty
table gives an empty result; repeated rows and extra columns do not matter.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshard.llm.chunks import ChunkCache
from lakeshard.llm.common import pieces, release

#: bytes of text that are encoded at once, about, and pieces of text whose ids a worker keeps
TEXT_BYTES = 2 << 20
PIECES = 500_000
#: bytes of the ids of these pieces, and of the texts and ids in each generation of known words
PIECES_BYTES = 16 << 20
WORDS_BYTES = 8 << 20
#: words in each of the two generations of a cache; pairs in the table, which starts anew when full
WORDS = 80_000
PAIRS = 300_000
#: ids that the decoder gathers at once, about
RUN = 1 << 17
_END = "</w>"
_SHIFT = 0x10000
#: Unicode white space
_CHUNK = re.compile("[^\t-\r \x85\xa0  -     　]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: visible Latin-1 characters for themselves, the rest from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class WordBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str, limit: int = PIECES):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._split = regex.compile(split)
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self._special_ids = special
        self._letter = {b: c for b, c in enumerate(byte_letters())}
        self._table = str.maketrans({chr(b): c for b, c in self._letter.items()})
        names: dict[int, str] = {i: t for t, i in [*vocab.items(), *special.items()]}
        self.size = max(names) + 1
        # tokens as strings of symbols; a letter that ends a word is a symbol of its own
        self._id = {self._symbols(t): i for t, i in vocab.items()}
        self._len = {i: len(s) for s, i in self._id.items()}
        self._text = {i: s for s, i in self._id.items()}
        self._longest = max(map(len, self._id), default=1)
        self._rank: dict[int, int] = {}
        self._parts: dict[int, tuple[int, int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            a, b = vocab[left], vocab[right]
            made = vocab[left.removesuffix(_END) + right] if left.endswith(_END) else vocab[left + right]
            self._rank.setdefault(a * self.size + b, rank)
            self._parts.setdefault(made, (a, b, rank))
        self._lengths = np.array([self._len.get(i, 1) for i in range(self.size)])
        self._right: dict[int, list] = {}
        self._left: dict[int, list] = {}
        self._shorter: dict[int, int] = {}
        self._pairs: dict[int, bool] = {}
        self._chunks = ChunkCache(self._learn, limit)
        self._known: dict[str, bytes] = {}
        self._known_old: dict[str, bytes] = {}
        self._known_bytes = 0
        self._auto = ahocorasick.Automaton()
        for s, i in self._id.items():
            self._auto.add_word(s, i)
        self._auto.make_automaton()
        self._decoded = OffsetTable([names.get(i, "").encode() + b" " for i in range(self.size)])
        self._decimal = OffsetTable([b"%d " % i for i in range(self.size)])

    @staticmethod
    def _symbols(token: str) -> str:
        if token.endswith(_END) and token != _END:
            body = token[: -len(_END)]
            return body[:-1] + chr(ord(body[-1]) + _SHIFT)
        return token

    # -- compatibility -----------------------------------------------------

    def _edge(self, token: int, side: int) -> list[tuple[int, int, float]]:
        """Parts along one edge of a token's merge tree: ``(part, rank that made it, rank that used it up)``."""
        memo = self._right if side else self._left
        if token not in memo:
            out, used, at = [], float("inf"), token
            while True:
                tree = self._parts.get(at)
                out.append((at, tree[2] if tree else -1, used))
                if tree is None:
                    break
                used, at = tree[2], tree[side]
            memo[token] = out
        return memo[token]

    def compatible(self, one: int, two: int) -> bool:
        """Whether the merges leave ``one`` and ``two`` as they are when they stand side by side."""
        key = one * self.size + two
        known = self._pairs.get(key)
        if known is None:
            known = self._search(one, two)
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            self._pairs[key] = known
        return known

    def _search(self, one: int, two: int) -> bool:
        for a, made_a, used_a in self._edge(one, 1):
            for b, made_b, used_b in self._edge(two, 0):
                rank = self._rank.get(a * self.size + b)
                if rank is not None:
                    when = max(rank, made_a, made_b)
                    if when < used_a and when <= used_b:  # of equal merges the left one goes first
                        return False
        return True

    # -- words -------------------------------------------------------------

    def _prefix(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``, or -1."""
        found = self._shorter.get(token)
        if found is None:
            s = self._text[token]
            found = next((self._id[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in self._id), -1)
            self._shorter[token] = found
        return found

    def _match(self, word: str, at: int) -> int:
        """The longest token that begins at ``at``, or -1."""
        rest, ids = word[at:at + self._longest], self._id
        for end in range(self._auto.longest_prefix(rest), 0, -1):  # no longer token begins like this
            found = ids.get(rest[:end])
            if found is not None:
                return found
        return -1

    def backtrack(self, word: str, out: list[int] | None = None) -> list[int]:
        """Ids of one word of symbols; ``out`` are compatible longest matches that begin it."""
        out = [] if out is None else out
        closed: set[int] = set()
        size, known, base = self._len, self._pairs, self.size
        at = sum([size[t] for t in out])
        token = self._match(word, at)
        while at < len(word):
            last = out[-1] * base if out else -1
            while token >= 0:
                if at + size[token] not in closed:
                    fits = last < 0 or known.get(last + token)
                    if fits is None:
                        fits = self.compatible(out[-1], token)
                    if fits:
                        break
                token = self._prefix(token)
            if token >= 0:
                out.append(token)
                at += size[token]
                if at < len(word):
                    token = self._match(word, at)
            else:
                closed.add(at)
                token = out.pop()
                at -= size[token]
                token = self._prefix(token)
        return out

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids (int32) of many words of symbols: longest matches, put right where a pair is not compatible."""
        if not words:
            return []
        matches = list(self._auto.iter_long("\n".join(words)))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        at = np.fromiter((m[0] for m in matches), np.int64, len(matches))
        ids = np.fromiter((m[1] for m in matches), np.int64, len(matches))
        owner = np.searchsorted(ends, at, side="right")
        joint = owner[1:] == owner[:-1]
        keys, where = np.unique((ids[:-1] * self.size + ids[1:])[joint], return_inverse=True)
        good = np.fromiter((self.compatible(*divmod(k, self.size)) for k in keys.tolist()), bool, len(keys))
        wrong = {}  # of each word to put right, the place of the first token that does not fit
        if len(keys):
            bad = (np.flatnonzero(joint) + 1)[~good[where]]
            word, first = np.unique(owner[bad], return_index=True)
            wrong = dict(zip(word.tolist(), bad[first].tolist(), strict=True))
        # symbols without a token leave gaps, which the library drops before merging
        covered = np.bincount(owner, weights=self._lengths[ids], minlength=len(words))
        gaps = np.flatnonzero(covered != sizes)
        cut = np.searchsorted(owner, np.arange(len(words) + 1))
        raw = ids.astype("<i4").tobytes()
        cut = (cut * 4).tolist()
        out = [raw[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        flat = ids.tolist()
        for w, first in wrong.items():
            out[w] = _packed(self.backtrack(words[w], flat[cut[w] // 4:first]))
        for w in gaps.tolist():
            out[w] = _packed(self.backtrack("".join(c for c in words[w] if c in self._id)))
        return out

    # -- texts -------------------------------------------------------------

    def _words(self, chunk: str) -> list[str | int]:
        """Words of symbols of a piece without white space; special tokens as ids."""
        if self._special is not None and "<" in chunk:
            parts = self._special.split(chunk)
            if len(parts) > 1:
                out: list[str | int] = []
                for p in parts:
                    out += [self._special_ids[p]] if p in self._special_ids else self._words(p) if p else []
                return out
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        out = []
        for w in self._split.findall(chunk.lower()):
            s = w.encode("utf-8", "surrogatepass").decode("latin-1").translate(self._table)
            out.append(s[:-1] + chr(ord(s[-1]) + _SHIFT))
        return out

    def _learn(self, new: list[str]) -> list[bytes]:
        """Ids of new pieces."""
        parts = [[w for c in _CHUNK.findall(piece) for w in self._words(c)] for piece in new]
        if len(self._known) > WORDS or self._known_bytes > WORDS_BYTES:
            self._known_old, self._known, self._known_bytes = self._known, {}, 0
        known, old = self._known, self._known_old
        words = {w for p in parts for w in p if isinstance(w, str)} - known.keys()
        for w in words & old.keys():
            known[w] = old[w]
        words = list(words - known.keys())
        ids = self.encode_words(words)
        known.update(zip(words, ids, strict=True))
        self._known_bytes += sum(map(len, words)) + sum(map(len, ids))
        return [b"".join([known[w] if isinstance(w, str) else w.to_bytes(4, "little") for w in p]) for p in parts]

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` in order (int32), and how many each text has."""
        if self._chunks._ids.nbytes > PIECES_BYTES:
            self._chunks._clear()
        return self._chunks.encode(texts)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Texts (UTF-8) of runs of ids: the tokens' names, joined by spaces."""
        return self._decoded.join(ids, counts)

    def decimals(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Ids in decimal, joined by spaces."""
        return self._decimal.join(ids, counts)


class OffsetTable:
    """Byte strings laid end to end, with the place and length of each; each string ends with a separator."""

    def __init__(self, strings: list[bytes]):
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)
        self.length = np.array([len(s) for s in strings], np.int32)
        self.offset = np.concatenate(([0], np.cumsum(self.length[:-1]))).astype(np.int32)

    def join(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        out: list[bytes] = []
        ends = np.cumsum(counts)
        cut = np.flatnonzero(np.diff(ends // RUN)) + 1  # a run of texts at a time bounds the index arrays
        for a, e in zip([0, *cut.tolist()], [*cut.tolist(), len(counts)], strict=True):
            if e > a:
                out += self._join(ids[ends[a] - counts[a]:ends[e - 1]], counts[a:e])
        return out

    def _join(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        size = self.length[ids]
        end = np.cumsum(size, dtype=np.int64)
        at = np.repeat(self.offset[ids] - (end - size), size)
        at += np.arange(len(at))
        flat = self.bytes[at].tobytes()
        stop = np.concatenate(([0], end))[np.concatenate(([0], np.cumsum(counts)))].tolist()
        return [flat[a:max(a, b - 1)] for a, b in zip(stop[:-1], stop[1:], strict=True)]


@contextlib.contextmanager
def loaded(path: str) -> Iterator[WordBpe]:
    """The vocabulary at ``path`` on this machine, for one task."""
    bpe = WordBpe(path)
    try:
        yield bpe
    finally:
        bpe.__dict__.clear()  # its parts refer to each other
        release()


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` of every row; the vocabulary file lies at ``path`` on every machine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with loaded(path) as bpe:
            for b in pieces(batches, limit=TEXT_BYTES):
                ids, counts = bpe.encode(b.column("text").to_pylist())
                offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(ids))],
                                                 names=["doc_id", "ids"])

    return _narrow(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id`` and ``text`` of rows of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with loaded(path) as bpe:
            for b in batches:
                lists = b.column("ids")
                counts = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
                text = bpe.decode(np.asarray(lists.flatten()).astype(np.int64), counts)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([t.decode("utf-8", "replace") for t in text], pa.string())],
                                                 names=["doc_id", "text"])

    narrow = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return narrow.mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with loaded(path) as bpe:
            for b in pieces(batches, limit=TEXT_BYTES):
                ids, counts = bpe.encode(b.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(counts),
                     pa.array([hashlib.sha256(x).hexdigest() for x in bpe.decimals(ids, counts)], pa.string()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in bpe.decode(ids, counts)], pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _narrow(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
