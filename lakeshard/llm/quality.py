"""Quality classifier: logistic regression over hashed word n-grams, trained with FTRL-proximal updates.

Features are words and word pairs (runs of punctuation are words; a pair
whose second word repeats one of the words just before it is one common
pair, whatever the word), hashed into ``2**bits`` coordinates; a coordinate's value is its share of the
text's n-grams times ``scale``.  Training uses a bounded sample of labelled
rows (``TRAIN_ROWS``), dealt to ``SHARDS`` tasks.  In each round every task
runs one pass of follow-the-regularised-leader updates from the common model
and the driver mixes the shards' models, each coordinate weighed by the
squared gradients it has seen; the model has a fixed size.  Scoring is a
sparse dot product over whole texts, one pass over the corpus, no shuffle.

Defined cases: null, empty and blank texts have no features and get the
score of the bias alone.  Without labelled rows every score is the prior of
0.5.  Extra columns of the tables are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshard.llm.common import held_out, labelled, pieces, stored
from lakeshard.llm.hashing import ngram_hashes, word_hashes

#: most labelled rows that are used for training
TRAIN_ROWS = 8192
SHARDS = 4
ROUNDS = 3
BITS = 18
SCALE = 16.0


#: stands for a word seen among the ``_BACK`` words before it, whatever the word
_AGAIN = np.uint64(0x5DEECE66D1234567)
_BACK = 4


def _pairs(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring words; a repetition at a short distance in its text is one common pair."""
    pairs = ngram_hashes(words, 2)
    for j in range(1, min(_BACK, len(words) - 1) + 1):
        pairs[j - 1:][(words[j:] == words[:-j]) & (doc[j:] == doc[:-j])] = _AGAIN
    return pairs


def feature_ids(texts, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of all words and word pairs of each text, and how many each text has."""
    words, counts = word_hashes(texts, punct=True)
    shift = np.uint64(64 - bits)
    ends = np.cumsum(counts)
    doc = np.repeat(np.arange(len(counts)), counts)
    pairs = _pairs(words, doc) >> shift
    inside = doc[1:] == doc[:-1]
    ids = np.concatenate((words >> shift, pairs[inside])).astype(np.int64)
    owner = np.concatenate((doc, doc[1:][inside]))
    order = np.argsort(owner, kind="stable")
    sizes = counts + np.maximum(counts - 1, 0)
    assert len(ids) == int(sizes.sum()) and (not len(ends) or ends[-1] == len(words))
    return ids[order], sizes


def margins(texts, weights: np.ndarray, bias: float, bits: int = BITS, scale: float = SCALE) -> np.ndarray:
    """Bias plus the dot product of each text's features with the weights."""
    words, counts = word_hashes(texts, punct=True)
    shift = np.uint64(64 - bits)
    one = weights[(words >> shift).astype(np.int64)].astype(np.float64)
    two = weights[(_pairs(words, np.repeat(np.arange(len(counts)), counts)) >> shift).astype(np.int64)].astype(np.float64)
    ends = np.cumsum(counts)
    begins = ends - counts
    sum1 = np.concatenate(([0.0], np.cumsum(one)))
    sum2 = np.concatenate(([0.0], np.cumsum(two), [0.0]))
    size = counts + np.maximum(counts - 1, 0)
    last = np.maximum(ends - 1, begins)
    total = sum1[ends] - sum1[begins] + np.where(counts > 1, sum2[np.minimum(last, len(two))] - sum2[np.minimum(begins, len(two))], 0.0)
    return bias + scale * total / np.maximum(size, 1)


class Ftrl:
    """Per-coordinate FTRL-proximal for logistic loss; coordinate ``2**bits`` is the bias."""

    def __init__(self, weights: np.ndarray, squares: np.ndarray, alpha=0.5, beta=1.0, l1=1e-4, l2=1e-3):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.n = squares.astype(np.float64)
        # the state z under which the leader equals the given weights
        self.z = -weights * ((beta + np.sqrt(self.n)) / alpha + l2) - np.sign(weights) * l1

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = 1.0 / (1.0 + np.exp(-np.clip(float(w @ x), -30, 30)))
        g = (p - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def _featurise(bits: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            ids, sizes = feature_ids(b.column("text").to_pylist(), bits)
            rows_at, rows_x = [], []
            for part in np.split(ids, np.cumsum(sizes)[:-1]):
                at, tf = np.unique(part, return_counts=True)
                rows_at.append(np.append(at, 1 << bits).astype(np.int32).tobytes())
                rows_x.append(np.append(tf * (scale / max(len(part), 1)), 1.0).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), pa.array(rows_at, pa.binary()), pa.array(rows_x, pa.binary())],
                names=["id", "label", "at", "x"])
    return run


def _epoch(start, r: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        model = Ftrl(*start.value)
        order = np.lexsort((pdf["id"].to_numpy(), (pdf["id"].to_numpy() * 2654435761 + r * 40503) % 1000003))
        at, x, label = pdf["at"].to_numpy(), pdf["x"].to_numpy(), pdf["label"].to_numpy()
        for i in order:
            model.learn(np.frombuffer(at[i], np.int32), np.frombuffer(x[i], np.float32).astype(np.float64), int(label[i]))
        return pd.DataFrame({"w": [model.weights().astype(np.float32).tobytes()],
                             "n": [model.n.astype(np.float32).tobytes()]})
    return run


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", *, remainder: int = 0, modulus: int = 5,
          limit: int = TRAIN_ROWS, shards: int = SHARDS, rounds: int = ROUNDS, bits: int = BITS,
          scale: float = SCALE, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, float]:
    """Weights (float32, ``2**bits``) and bias, learned from at most ``limit`` labelled rows."""
    spark = docs.sparkSession
    rows = labelled(docs, labels, label, remainder, modulus, limit, id_col, text_col)
    feats = stored(rows.mapInArrow(_featurise(bits, scale), "id long, label int, at binary, x binary"), "ftrl")
    dealt = feats.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(shards)).cast("int"))
    size = (1 << bits) + 1
    w, n = np.zeros(size), np.zeros(size)
    for r in range(rounds):
        start = spark.sparkContext.broadcast((w.astype(np.float32), n.astype(np.float32)))
        # `shards` rows of fixed size come back
        got = dealt.groupBy("shard").applyInPandas(_epoch(start, r), "w binary, n binary").collect()
        if not got:
            break
        ws = np.stack([np.frombuffer(g["w"], np.float32) for g in got]).astype(np.float64)
        seen = np.stack([np.frombuffer(g["n"], np.float32) for g in got]).astype(np.float64) - n.astype(np.float32)
        seen = np.maximum(seen, 0)
        total = seen.sum(axis=0)
        w = np.where(total > 0, (ws * seen).sum(axis=0) / np.maximum(total, 1e-30), w)
        n = n + total / len(got)
        start.unpersist()
    return w[:-1].astype(np.float32), float(w[-1])


def score(docs: DataFrame, weights: np.ndarray, bias: float, *, bits: int = BITS, scale: float = SCALE,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every row; whole texts."""
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for b in pieces(batches):
            m = margins(b.column("text").to_pylist(), w, bias, bits, scale)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(m, -40, 40))))],
                                             names=["doc_id", "score"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", *, threshold: float = 0.3,
             remainder: int = 0, modulus: int = 5, **params) -> DataFrame:
    """Train and score: ``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    weights, bias = train(docs, labels, label, remainder=remainder, modulus=modulus, **params)
    return score(docs, weights, bias).select(
        "doc_id", held_out("doc_id", remainder, modulus).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
