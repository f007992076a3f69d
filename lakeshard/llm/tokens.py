"""Token ids of whole texts by the ``tokenizers`` library, for byte-level vocabularies.

Texts are cut into pieces at white space, and the library encodes each piece
once while it stays in a worker's cache (``chunks``); the ids are those of
the whole text.
"""

from __future__ import annotations

import os
import re

import numpy as np

from lakeshard.llm.chunks import LIMIT, ChunkCache

#: pieces that are encoded as one text
RUN = 256
_W = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PLAIN = re.compile(f" ?[^{_W}]+")


class LibraryEncoder:
    def __init__(self, path: str, special_text: bool = True, limit: int = LIMIT):
        """``special_text``: special tokens written in a text become their ids; else they are ordinary text."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        self._tok.encode_special_tokens = not special_text
        self._special = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        line = self._tok.encode("\n", add_special_tokens=False).ids
        self._line = line[0] if len(line) == 1 else None
        self.size = self._tok.get_vocab_size(with_added_tokens=True)
        self._chunks = ChunkCache(self._learn, limit)
        self.encode = self._chunks.encode

    def _learn(self, new: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(new)
        plain, odd = [], []
        for i, c in enumerate(new):
            simple = self._line is not None and _PLAIN.fullmatch(c) and not ("<" in c and any(s in c for s in self._special))
            (plain if simple else odd).append(i)
        runs = [plain[at:at + RUN] for at in range(0, len(plain), RUN)]
        # a line break between pieces is a token of its own
        texts = ["\n".join([new[i] for i in r]) for r in runs]
        for run, e in zip(runs, self._tok.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype=np.int32)
            cut = np.flatnonzero(ids == self._line)
            if len(cut) != len(run) - 1:
                odd += run
                continue
            raw, cut = ids.tobytes(), (cut * 4).tolist()
            for i, a, b in zip(run, [0, *(x + 4 for x in cut)], [*cut, len(raw)], strict=True):
                out[i] = raw[a:b]
        for i, e in zip(odd, self._tok.encode_batch_fast([new[i] for i in odd], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, dtype=np.int32).tobytes()
        return out


_loaded: dict[tuple[str, bool], LibraryEncoder] = {}


def load(path: str, special_text: bool = True) -> LibraryEncoder:
    """The encoder of the vocabulary at ``path`` on this machine, once a worker."""
    if (path, special_text) not in _loaded:
        _loaded[path, special_text] = LibraryEncoder(path, special_text)
    return _loaded[path, special_text]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to every text's ids."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1
