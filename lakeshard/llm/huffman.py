"""Token ids in binary files: canonical length-limited Huffman codes with bit-offset checkpoints.

1. Texts are encoded once (``tokens``) into a scratch table.
2. Global counts of the ids (one row an id) give code lengths of at most
   ``MAX_BITS`` by package-merge (more where over 2^16 ids are used, see
   ``bit_limit``); the canonical code follows from the lengths.
3. A range exchange brings the documents into ascending ``doc_id`` order.  In
   each range, every document's ids are coded to a bit string of its own, with
   the bit offset of every ``CHECK``-th id, and runs of documents form
   independent blocks.
4. The file format is Parquet: ``codes`` (id, length) and ``blocks`` (part,
   block, doc_ids, n_tokens, checkpoints, payload), so any store that Spark
   writes will do.
5. Reading decodes all segments between checkpoints of a batch in step, one
   table look-up an id; blocks are read alone, in any order.

The number of ranges follows the coded size (``RANGE_BYTES``), and Spark cuts
them from its own sample, so that nothing of them stands in the plan.  They are
cut by id, then a hash of the ids, then the row's place in the scratch table:
null ids, a much repeated id and many equal rows spread over ranges like all
others and still stand in order.

Defined cases: null and empty texts hold the end id alone.  Null ids come
first in order.  Rows with equal ids stand next to each other in the order
of a hash of their coded ids.  An empty table gives empty files and an empty
result.  Extra columns are ignored.  More than 2^22 used ids raise an error.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshard.llm import tokens
from lakeshard.llm.chunks import TEXT_BYTES
from lakeshard.llm.common import pieces, stored
from lakeshard.session import scratch_dir

MAX_BITS = 16
CHECK = 512
BLOCK_TOKENS = 1 << 16
#: coded bytes that are decoded side by side, about
DECODE_BYTES = 1 << 21
END_ID = 2
#: coded bytes that one range holds, about
RANGE_BYTES = 16 << 20


# -- code ------------------------------------------------------------------

def bit_limit(n_used: int) -> int:
    """Longest code for ``n_used`` ids: ``MAX_BITS``, or two bits more than the ids need where these don't suffice."""
    if n_used <= 1 << MAX_BITS:
        return MAX_BITS
    if n_used > 1 << 22:
        raise ValueError(f"{n_used} ids; the decoder reads codes of at most 24 bits")
    return (n_used - 1).bit_length() + 2


def code_lengths(counts: np.ndarray, max_bits: int | None = None) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` (default: ``bit_limit``) for ``counts`` (0: no code), by package-merge."""
    used = np.flatnonzero(counts)
    max_bits = max_bits or bit_limit(len(used))
    lengths = np.zeros(len(counts), np.int64)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids need more than {max_bits} bits")
    leaves = used[np.lexsort((used, counts[used]))]
    weight = counts[leaves].astype(np.int64)
    kinds, items = [], weight
    kinds.append(np.ones(len(weight), bool))
    for _ in range(max_bits - 1):
        pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((weight, pairs))
        leaf = np.concatenate((np.ones(len(weight), bool), np.zeros(len(pairs), bool)))
        order = np.lexsort((~leaf, both))
        items = both[order]
        kinds.append(leaf[order])
    take = 2 * len(used) - 2
    for leaf in reversed(kinds):
        n = int(leaf[:take].sum())
        lengths[leaves[:n]] += 1
        take = 2 * (take - n)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then by id."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    if len(order):
        size = lengths[order]
        top = int(size.max())
        # the next code of the longest length, shortened
        steps = np.concatenate(([0], np.cumsum(1 << (top - size))[:-1]))
        codes[order] = (steps >> (top - size)).astype(np.uint64)
    return codes


class Coder:
    """Encoder and table-driven decoder of one code."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = np.asarray(lengths, np.int64)
        self.codes = canonical(self.lengths)
        self.bits = max(MAX_BITS, int(self.lengths.max(initial=0)))
        self._id = np.zeros(1 << self.bits, np.int32)
        self._size = np.ones(1 << self.bits, np.int64)
        used = np.flatnonzero(self.lengths)
        order = used[np.lexsort((used, self.lengths[used]))]
        spans = 1 << (self.bits - self.lengths[order])
        self._id[: spans.sum()] = np.repeat(order, spans)
        self._size[: spans.sum()] = np.repeat(self.lengths[order], spans)

    def encode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[np.ndarray]]:
        """A byte string for each run of ids, and the bit offsets of its checkpoints."""
        size = self.lengths[ids]
        ends = np.cumsum(counts)
        begins = ends - counts
        total = np.concatenate(([0], np.cumsum(size)))
        bits = total[ends] - total[begins]
        room = (bits + 31) // 32 * 32
        base = np.concatenate(([0], np.cumsum(room)))
        at = total[:-1] + np.repeat(base[:-1] - total[begins], counts)
        word = at >> 5
        value = self.codes[ids] << (64 - size - (at & 31)).astype(np.uint64)
        out = np.zeros(int(base[-1] // 32) + 1, np.uint64)
        if len(ids):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            out[word[first]] += np.add.reduceat(value >> np.uint64(32), first)
            out[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
        raw = out.astype(">u4").tobytes()
        byte = (base // 8).tolist()
        rows = [raw[a:a + n] for a, n in zip(byte[:-1], ((bits + 7) // 8).tolist(), strict=True)]
        checks = [at[a:b:CHECK] - o for a, b, o in zip(begins.tolist(), ends.tolist(), base[:-1].tolist(), strict=True)]
        return rows, checks

    def decode(self, payload: bytes, checkpoints: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """All ids of a block.  ``checkpoints``: of every run of ids, the bit offsets of ids 0, CHECK, 2 CHECK..."""
        raw = np.frombuffer(payload + b"\0\0\0\0", np.uint8).astype(np.uint32)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        segments = -(-counts // CHECK)
        left = np.full(int(segments.sum()), CHECK, np.int64)
        last = np.cumsum(segments) - 1
        left[last[counts > 0]] = (counts - (segments - 1) * CHECK)[counts > 0]
        out = np.zeros(int(counts.sum()), np.int32)
        to = np.cumsum(left) - left
        order = np.argsort(-left, kind="stable")
        at, to, left = checkpoints[order].astype(np.int64), to[order], left[order]
        live = len(at)
        for step in range(int(left[0]) if live else 0):
            while live and left[live - 1] <= step:
                live -= 1
            a = at[:live]
            key = (window[a >> 3] << (a & 7).astype(np.uint32)) >> np.uint32(32 - self.bits)
            out[to[:live] + step] = self._id[key]
            a += self._size[key]
        return out


# -- Spark -----------------------------------------------------------------

def encoded(docs: DataFrame, vocabulary: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scratch table ``doc_id, n_tokens, ids`` (little-endian unsigned 16 or 32 bits), the end id appended."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.load(vocabulary)
        kind = _kind(max(enc.size, end_id + 1))
        for b in pieces(batches, limit=TEXT_BYTES):
            ids, counts = tokens.with_end(*enc.encode(b.column("text").to_pylist()), end_id)
            stop = np.concatenate(([0], np.cumsum(counts))).astype(np.int32) * np.dtype(kind).itemsize
            payload = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(stop.tobytes()), pa.py_buffer(ids.astype(kind).tobytes())])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(counts), payload], names=["doc_id", "n_tokens", "ids"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stored(narrow.mapInArrow(run, "doc_id long, n_tokens long, ids binary"), "tokens", compression="zstd")


def _kind(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def _flat(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).astype(np.int64)


def id_counts(rows: DataFrame, size: int, kind: str) -> np.ndarray:
    """How often each id occurs in all of ``rows``; one row an id reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in pieces(batches, "ids"):
            total += np.bincount(_flat(b.column("ids"), kind), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["id", "n"])

    got = rows.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(size, np.int64)
    for r in got:
        counts[r["id"]] = r["n"]
    return counts


def write(docs: DataFrame, vocabulary: str, path: str, *, size: int, end_id: int = END_ID, id_col: str = "doc_id",
          text_col: str = "text") -> None:
    """Write ``docs`` below ``path`` in the file format above; ``size``: ids of the vocabulary."""
    spark = docs.sparkSession
    size = max(size, end_id + 1)
    kind = _kind(size)
    rows = encoded(docs, vocabulary, end_id, id_col, text_col)
    counts = id_counts(rows, size, kind)
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id int, length int").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/codes")
    coder = spark.sparkContext.broadcast(lengths.astype(np.int8))

    n_bytes = int((counts * lengths).sum()) // 8
    parts = max(1, -(-n_bytes // RANGE_BYTES))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids").asc(), F.col("place").asc()]
    ranged = (rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(parts, *order)
              .sortWithinPartitions(*order).select(F.spark_partition_id().alias("part"), "doc_id", "n_tokens", "ids"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _blocks(batches, Coder(coder.value), kind)

    ranged.mapInArrow(code, _BLOCKS).write.mode("overwrite").parquet(f"{path}/blocks")


_BLOCKS = "part int, block int, doc_ids array<long>, n_tokens array<long>, checkpoints binary, payload binary"


def _blocks(batches: Iterator[pa.RecordBatch], coder: Coder, kind: str) -> Iterator[pa.RecordBatch]:
    """Code the sorted documents of a range and join them into blocks of about ``BLOCK_TOKENS`` ids."""
    part, block, docs, checks, payload, size, n_tokens = 0, 0, [], [], [], 0, 0

    def flush():
        row = [[part], [block], [[d for d, _ in docs]], [[n for _, n in docs]], [np.concatenate(checks).astype("<i8").tobytes()], [b"".join(payload)]]
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds, strict=True)],
                                          names=["part", "block", "doc_ids", "n_tokens", "checkpoints", "payload"])

    for b in pieces(batches, "ids"):
        part = b.column("part")[0].as_py()  # the same in the whole task
        coded = coder.encode(_flat(b.column("ids"), kind), np.asarray(b.column("n_tokens")))
        for d, n, x, c in zip(b.column("doc_id").to_pylist(), b.column("n_tokens").to_pylist(), *coded, strict=True):
            if docs and n_tokens >= BLOCK_TOKENS:
                yield flush()
                block += 1
                docs, checks, payload, size, n_tokens = [], [], [], 0, 0
            docs.append((d, n))
            checks.append(c.astype(np.int64) + 8 * size)
            payload.append(x)
            size += len(x)
            n_tokens += n
    if docs:
        yield flush()


def read(spark: SparkSession, path: str) -> DataFrame:
    """``part, block, doc_id, in_block`` (ids before it in its block), ``n_tokens`` and ``ids`` from the files below ``path``."""
    return _read(spark, path, False)


def _read(spark: SparkSession, path: str, digest: bool) -> DataFrame:
    got = spark.read.parquet(f"{path}/codes").collect()  # one row an id
    lengths = np.zeros(max((r["id"] for r in got), default=0) + 1, np.int8)
    for r in got:
        lengths[r["id"]] = r["length"]
    code = spark.sparkContext.broadcast(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Coder(code.value)
        for b in pieces(batches, "payload", DECODE_BYTES):
            part, block, docs, ns, checks, payload = (b.column(i).to_pylist() for i in range(6))
            # blocks are decoded side by side
            place = np.cumsum([0, *map(len, payload)])[:-1] * 8
            checks = np.concatenate([np.frombuffer(x, "<i8") + o for x, o in zip(checks, place, strict=True)])
            counts = np.array([n for own in ns for n in own], np.int64)
            ids = c.decode(b"".join(payload), checks, counts)
            stop = np.concatenate(([0], np.cumsum(counts)))
            size = np.array([len(own) for own in ns])
            first = np.concatenate(([0], np.cumsum(size)))[:-1]
            if digest:
                raw = memoryview(ids.astype("<u4").tobytes())
                last = pa.array([zlib.crc32(raw[4 * a:4 * e]) for a, e in zip(stop[:-1].tolist(), stop[1:].tolist(), strict=True)], pa.int64())
            else:
                last = pa.ListArray.from_arrays(pa.array(stop.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(part, np.int32), size)), pa.array(np.repeat(np.array(block, np.int32), size)),
                 pa.array([d for own in docs for d in own], pa.int64()), pa.array(stop[:-1] - np.repeat(stop[first], size)),
                 pa.array(counts), last],
                names=["part", "block", "doc_id", "in_block", "n_tokens", "ids_crc32" if digest else "ids"])

    kind = "ids_crc32 long" if digest else "ids array<int>"
    return spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").mapInArrow(
        run, f"part int, block int, doc_id long, in_block long, n_tokens long, {kind}")


def starts(spark: SparkSession, path: str) -> DataFrame:
    """``part, block, before``: ids in all blocks before a block; prefix sums in each range, then over the ranges."""
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").select(
        "part", "block", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = (blocks.groupBy("part").agg(F.sum("n").alias("n"))
              .select(F.col("part").alias("p"), before(Window.orderBy("part")).alias("range_start")))
    inside = blocks.select("part", "block", before(Window.partitionBy("part").orderBy("block")).alias("start"))
    return inside.join(ranges, inside["part"] == ranges["p"]).select("part", "block", (F.col("start") + F.col("range_start")).alias("before"))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read from the files below ``path``."""
    place = starts(spark, path).select(F.col("part").alias("p"), F.col("block").alias("b"), "before")
    docs = _read(spark, path, True)
    return (docs.join(place, (docs["part"] == place["p"]) & (docs["block"] == place["b"]))
            .select("doc_id", (F.col("before") + F.col("in_block")).alias("start"), "n_tokens", "ids_crc32"))


def round_trip(docs: DataFrame, vocabulary: str, *, size: int, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Write ``docs`` (to a scratch folder unless ``path`` is given), read the files back, and return their digests."""
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "huffman")
    write(docs, vocabulary, path, size=size, end_id=end_id)
    return digests(spark, path)
