"""Token counts by a separator scan of flat token files.

``write_flat`` lays the ids of all documents end to end, an end-of-document
id after each, and cuts them into blocks of a fixed number of ids: documents
cross block borders and nothing says where they begin.  A list of the
document ids in file order is kept beside the blocks.

``scan`` finds the separators of each block with one vectorised comparison;
blocks are scanned alone, in any order.  A prefix scan over a file's blocks
then gives every block the ids and documents before it and the place where
its first document began, however many blocks ago; the documents follow from
the separators.  A file is what one task wrote, so a scan's window holds the
blocks of one input split.

Defined cases: null and empty texts have no ids, only their separator.  A
separator written in a text is ordinary text.  Ids after the last separator
of a file are a document that is not ``complete``.  Null and repeated
document ids stay as they are.  An empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshard.llm import tokens
from lakeshard.llm.chunks import TEXT_BYTES
from lakeshard.llm.common import pieces
from lakeshard.session import scratch_dir

BLOCK_IDS = 1 << 18
#: the end-of-document id of the byte-level vocabulary
END_OF_DOCUMENT = 50256

_FLAT = "file int, seq int, first long, payload binary, kind string"


def _kind(id_bytes: int) -> str:
    return {2: "<u2", 4: "<u4"}[id_bytes]


def write_flat(docs: DataFrame, vocabulary: str, path: str, *, end_id: int = END_OF_DOCUMENT, block_ids: int = BLOCK_IDS,
               id_bytes: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write blocks of ``block_ids`` ids below ``path``/kind=ids and the document ids below ``path``/kind=docs."""
    dtype = _kind(id_bytes)

    def row(file, seq, first, payload, kind):
        return pa.RecordBatch.from_arrays(
            [pa.array([file], pa.int32()), pa.array([seq], pa.int32()), pa.array([first], pa.int64()),
             pa.array([payload], pa.binary()), pa.array([kind])], names=["file", "seq", "first", "payload", "kind"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.load(vocabulary, False)
        file = TaskContext.get().partitionId()
        rest, n_blocks, n_docs, n_lists = np.zeros(0, dtype), 0, 0, 0
        for b in pieces(batches, limit=TEXT_BYTES):
            ids, _ = tokens.with_end(*enc.encode(b.column("text").to_pylist()), end_id)
            rest = np.concatenate((rest, ids.astype(dtype)))
            while len(rest) >= block_ids:
                yield row(file, n_blocks, n_blocks * block_ids, rest[:block_ids].tobytes(), "ids")
                rest, n_blocks = rest[block_ids:], n_blocks + 1
            names = b.column("doc_id")
            raw = names.fill_null(0).to_numpy().astype("<i8").tobytes() + names.is_null().to_numpy(zero_copy_only=False).tobytes()
            yield row(file, n_lists, n_docs, raw, "docs")
            n_docs, n_lists = n_docs + len(names), n_lists + 1
        if len(rest):
            yield row(file, n_blocks, n_blocks * block_ids, rest.tobytes(), "ids")

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    narrow.mapInArrow(run, _FLAT).write.mode("overwrite").partitionBy("kind").parquet(path, compression="zstd")


def _rows(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(_FLAT).parquet(path).where(F.col("kind") == kind)


def scan(spark: SparkSession, path: str, *, end_id: int = END_OF_DOCUMENT, id_bytes: int = 2) -> DataFrame:
    """``file, ordinal, start, n_tokens, complete`` of every document; ``n_tokens`` is without the separator."""
    dtype = _kind(id_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, ends = [], []
            for payload in b.column("payload"):
                ids = np.frombuffer(payload.as_buffer(), dtype)
                size.append(len(ids))
                ends.append(np.flatnonzero(ids == end_id))
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("seq"), pa.array(size, pa.int64()),
                                              pa.array(ends, pa.list_(pa.int64()))], names=["file", "seq", "size", "ends"])

    blocks = (_rows(spark, path, "ids").select("file", "seq", "payload")
              .mapInArrow(run, "file int, seq int, size long, ends array<long>"))
    before = Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = (blocks.withColumn("ids_before", F.coalesce(F.sum("size").over(before), F.lit(0)))
              .withColumn("docs_before", F.coalesce(F.sum(F.size("ends").cast("long")).over(before), F.lit(0)))
              .withColumn("last", F.col("ids_before") + F.try_element_at("ends", F.lit(-1)))
              .withColumn("open", F.coalesce(F.max("last").over(before) + 1, F.lit(0))))
    spans = F.transform("ends", lambda e, i: F.struct(
        (F.col("docs_before") + i).alias("ordinal"),
        F.when(i == 0, F.col("open")).otherwise(F.col("ids_before") + F.get("ends", i - 1) + 1).alias("start"),
        (F.col("ids_before") + e).alias("end")))
    closed = placed.select("file", F.explode(spans).alias("d")).select(
        "file", "d.ordinal", "d.start", (F.col("d.end") - F.col("d.start")).alias("n_tokens"), F.lit(True).alias("complete"))
    tail = (placed.groupBy("file").agg(F.sum("size").alias("size"), F.sum(F.size("ends").cast("long")).alias("ordinal"),
                                       F.coalesce(F.max("last") + 1, F.lit(0)).alias("start"))
            .where("start < size").select("file", "ordinal", "start", (F.col("size") - F.col("start")).alias("n_tokens"),
                                          F.lit(False).alias("complete")))
    return closed.unionByName(tail)


def document_ids(spark: SparkSession, path: str) -> DataFrame:
    """``file, ordinal, doc_id`` in file order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, first, payload in zip(*(b.column(c).to_pylist() for c in ("file", "first", "payload")), strict=True):
                n = len(payload) // 9
                ids, null = np.frombuffer(payload[:8 * n], "<i8"), np.frombuffer(payload[8 * n:], bool)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, file, np.int32)), pa.array(first + np.arange(n)),
                                                  pa.array(ids, mask=null)], names=["file", "ordinal", "doc_id"])

    return _rows(spark, path, "docs").select("file", "first", "payload").mapInArrow(run, "file int, ordinal long, doc_id long")


def token_counts(docs: DataFrame, vocabulary: str, *, path: str | None = None, end_id: int = END_OF_DOCUMENT,
                 block_ids: int = BLOCK_IDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as flat files and count their tokens by a scan: ``doc_id, file, ordinal, start, n_tokens``."""
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "flat")
    write_flat(docs, vocabulary, path, end_id=end_id, block_ids=block_ids, id_col=id_col, text_col=text_col)
    return (scan(spark, path, end_id=end_id).join(document_ids(spark, path), ["file", "ordinal"])
            .select("doc_id", "file", "ordinal", "start", "n_tokens"))
