"""Stupid-backoff language-model scores from corpus-wide n-gram counts.

Words are ``[^\\x20\\x09-\\x0D]+``; the model is of any order from one on and
counts all documents.  With ``c`` for counts and ``N`` for all words, a word
``b`` after the ``order - 1`` words ``h`` before it scores ``c(hb) / c(h)`` if
``c(hb) >= cutoff``, else ``backoff`` times its score after ``h`` without its
first word, and so on; after no word it scores ``c(b) / N``.  The first words
of a text have the shorter contexts that the text gives them, which is no
backoff.  A document's score is the sum of the logarithms.

The work is relational: documents are dealt to blocks; each block explodes
its texts into n-grams of all orders and sends the distinct ones with their
counts, packed in arrays, to hash partitions.  There the counts of all blocks
are summed (the count tables) and joined back to each block's list.  The
counts return to the blocks, meet the exploded n-grams again, and are
summed per document.  An n-gram, however common, reaches its partition once
a block, so no partition is hot; blocks are dealt by a hash of the document.
Blocks and hash partitions are numbered, and each goes to the task of its
number, so that no task gets several of them while others get none.

Defined cases: null, empty and blank texts have no words and score 0.  Null
ids are dealt by a hash of their text.  Repeated rows count as often as they
occur.  An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshard.llm.common import pieces, release
from lakeshard.llm.hashing import mix, ngram_hashes, word_hashes

WORD = r"[^\x20\x09-\x0D]+"
ORDER = 2
CUTOFF = 2
BACKOFF = 0.4
#: words that one block holds at order two, about (fewer at higher orders)
BLOCK_WORDS = 2_500_000
#: words whose n-grams one hash partition counts at order two, about
PARTITION_WORDS = 2_000_000


def _grams(table: pa.Table, order: int):
    """N-grams of a block: ``words, counts, grams, joint``; for each order from two on, the hashes and whether they lie within a text."""
    words, counts = [], []
    for b in pieces(iter(table.combine_chunks().to_batches())):
        w, c = word_hashes(b.column("text").to_pylist())
        words.append(w)
        counts.append(c)
    words = np.concatenate(words) if words else np.zeros(0, np.uint64)
    counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)  # of each word in its text
    grams = [ngram_hashes(words, n) for n in range(2, order + 1)]
    joint = [place[n - 1:] >= n - 1 for n in range(2, order + 1)]
    return words, counts, grams, joint


def _distinct(words: np.ndarray, grams: list[np.ndarray], joint: list[np.ndarray]):
    """Sorted distinct hashes of words and n-grams, the place of each among them (a list for each order), and their counts."""
    one = mix(words + np.uint64(1))
    every = [one, *(g[ok] for g, ok in zip(grams, joint, strict=True))]
    ids, where, count = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    return ids, np.split(where, np.cumsum([len(x) for x in every])[:-1]), count


def _edges(parts: int) -> np.ndarray:
    return np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)


_SENT = "part int, block int, ids binary, counts binary"


def _ask(parts: int, order: int):
    def run(table: pa.Table) -> pa.Table:
        words, _, grams, joint = _grams(table, order)
        ids, _, count = _distinct(words, grams, joint)
        cut = np.concatenate(([0], np.searchsorted(ids, _edges(parts)), [len(ids)]))
        has = np.flatnonzero(np.diff(cut))
        count = count.astype(np.uint32)
        return pa.table({"part": pa.array(has.astype(np.int32)),
                         "block": pa.array(np.full(len(has), table.column("block")[0].as_py(), np.int32)),
                         "ids": pa.array([ids[cut[p]:cut[p + 1]].tobytes() for p in has], pa.binary()),
                         "counts": pa.array([count[cut[p]:cut[p + 1]].tobytes() for p in has], pa.binary())})

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Replace each block's counts by those of the whole corpus; the ids need not travel back."""
    ids = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("ids")]
    counts = [np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("counts")]
    every = np.concatenate(ids)
    known, where = np.unique(every, return_inverse=True)
    total = np.bincount(where, weights=np.concatenate(counts)).astype(np.int64)[where]
    cut = np.cumsum([0, *map(len, ids)]).tolist()
    return pa.table({"part": table.column("part"), "block": table.column("block"),
                     "ids": pa.array([b""] * len(ids), pa.binary()),
                     "counts": pa.array([total[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())})


def _score(total: int, order: int, cutoff: int, backoff: float):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        words, counts, grams, joint = _grams(docs, order)
        _, at, _ = _distinct(words, grams, joint)
        sent = np.argsort(answers.column("part").to_numpy(), kind="stable")
        raw = answers.column("counts").to_pylist()
        c = np.frombuffer(b"".join(raw[i] for i in sent), np.int64)
        before = c[at[0]]  # of each word, how often the n-gram that ends there occurs
        log = np.log(before) - np.log(max(total, 1)) if len(words) else np.zeros(0)
        seen = np.zeros(len(words), bool)
        for n, ok in enumerate(joint, 2):
            last = np.flatnonzero(ok) + n - 1
            whole = c[at[n - 1]]
            known = whole >= cutoff
            log[last] = np.where(known, np.log(whole) - np.log(before[last - 1]), log[last] + np.log(backoff))
            seen[last] = known
            before = np.zeros(len(words), np.int64)
            before[last] = whole
        end = np.cumsum(counts)
        run_seen = np.concatenate(([0], np.cumsum(seen)))
        # sums of each text on its own, so that they don't depend on their neighbours
        sums = np.zeros(len(counts))
        some = np.flatnonzero(counts)
        if len(some):
            sums[some] = np.add.reduceat(log, (end - counts)[some])
        release()
        return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array(counts),
                         "n_seen": pa.array((run_seen[end] - run_seen[end - counts]).astype(np.int64)), "log_score": pa.array(sums)})

    return run


def score(docs: DataFrame, *, order: int = ORDER, cutoff: int = CUTOFF, backoff: float = BACKOFF, block_words: int = BLOCK_WORDS,
          partition_words: int = PARTITION_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_seen`` (words with a context that are not backed off) and ``log_score`` of every row."""
    if order < 1:
        raise ValueError(f"order {order}")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    total = narrow.agg(F.sum(F.regexp_count("text", F.lit(WORD)).cast("long"))).first()[0] or 0
    grams = total * max(order, 2) / 2  # the sizes are meant for order two
    blocks, parts = max(4, math.ceil(grams / block_words)), max(4, math.ceil(grams / partition_words))
    deal = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    dealt = narrow.withColumn("block", F.pmod(deal, F.lit(blocks)).cast("int")).repartitionById(blocks, "block")
    asked = dealt.groupBy("block").applyInArrow(_ask(parts, order), _SENT)
    answers = asked.repartitionById(parts, "part").groupBy("part").applyInArrow(_answer, _SENT)
    back = answers.select("part", F.col("block").alias("to"), "counts").repartitionById(blocks, "to")
    return dealt.groupBy("block").cogroup(back.groupBy("to")).applyInArrow(
        _score(total, order, cutoff, backoff), "doc_id long, n_words long, n_seen long, log_score double")
