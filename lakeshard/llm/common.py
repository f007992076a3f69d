"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshard.session import ensure_checkpoint_dir, scratch_dir, ship_package


#: rows of a batch that Spark hands to Python; whole texts make the default of 10,000 too large
BATCH_ROWS = 2000


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder and Python package for the executors (both once per application), and smaller batches."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(rows)) > BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: a lineage cut that survives executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(path, **options)
    return spark.read.schema(df.schema).parquet(path)


def labelled(docs: DataFrame, labels: DataFrame, label: str, remainder: int, modulus: int,
             limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A bounded, repeatable sample of labelled rows, none of them held out.

    Held out are ids with ``crc32(id as text) mod modulus == remainder``.
    Ids are taken in the order of their hash, ``limit`` at most, and of the
    rows of an id the text with the smallest hash, so there are at most
    ``limit`` rows and the sample is the same on every run.  Columns: ``id,
    text, label``.  Null ids, null labels and null texts are left out.
    """
    lab = (labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("label"))
           .where(F.col("_id").isNotNull() & F.col("label").isin(0, 1)
                  & (F.crc32(F.col("_id").cast("string").cast("binary")) % modulus != remainder))
           .groupBy("_id").agg(F.max("label").alias("label"))
           .orderBy(F.xxhash64("_id"), "_id").limit(limit))
    d = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
         .where(F.col("text").isNotNull()))
    return (d.join(lab, d["id"] == lab["_id"]).groupBy("id", "label")
            .agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("id", "text", "label"))


def held_out(id_col: str, remainder: int, modulus: int):
    """True for ids kept from training; a null id is never held out (it has no label either)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def pieces(batches: Iterator[pa.RecordBatch], column: str | int = "text", limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about ``limit`` bytes of text each, so that work arrays stay small.

    A single longer text makes a piece of its own.
    """
    for b in batches:
        if not b.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        cut = np.flatnonzero(np.diff(size // limit)) + 1
        for a, e in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows], strict=True):
            yield b.slice(a, e - a)
    release()


def release() -> None:
    """Give freed memory back to the machine; Python workers live on after their task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries than glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)
