"""File-level sources: whole-file text, recursive listings, small-file packing.

Listings use Spark's ``binaryFile`` source selecting only ``path`` and
``length``; the ``content`` column is pruned, so no file body is read.
"""

from __future__ import annotations

import os
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshard.functions.text import doc_stem

_GLOB_CHARS = "[]{}*?"


def qualify(path: str, spark: SparkSession | None = None) -> str:
    """Fully qualified form of ``path`` (trailing ``/`` removed).

    URIs with a scheme are kept.  A bare path is resolved against the
    cluster's default filesystem (``fs.defaultFS``, e.g. ``hdfs://nn:8020``)
    when a session is given and that is not the local filesystem; otherwise
    it becomes ``file:/abs/path``.
    """
    if "://" in path or path.startswith("file:"):
        return path.rstrip("/")
    if spark is not None:
        default_fs = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
        if not default_fs.startswith("file:"):
            return default_fs.rstrip("/") + "/" + path.strip("/")
    return "file:" + os.path.abspath(path).rstrip("/")


def _path_part(col):
    """The path of a file URI without scheme and authority: ``/a/b``."""
    return F.regexp_replace(col, r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")


def local_path(uri: str) -> str:
    """Path usable by ``pyarrow.fs`` for a Spark file URI (decoded)."""
    p = unquote(uri)
    if p.startswith("file://"):
        return p[len("file://"):]
    if p.startswith("file:"):
        return p[len("file:"):]
    return p


def escape_glob(path: str) -> str:
    """Escape Hadoop glob characters so ``load(path)`` reads the literal name."""
    return "".join("\\" + c if c in _GLOB_CHARS else c for c in path)


def read_text_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """One row per file: ``(doc, path, text)``; ``doc`` is the name up to the first ``.``."""
    # as an argument: text() sets this option itself
    df = spark.read.text(escape_glob(path), wholetext=True, recursiveFileLookup=recursive or None)
    return df.select(doc_stem(F.col("_metadata.file_path")).alias("doc"),
                     F.col("_metadata.file_path").alias("path"),
                     F.col("value").alias("text"))


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Recursive listing ``(path, rel, length, modified)`` of regular files.

    ``rel`` is the path below ``root`` (``binaryFile`` paths are not
    URL-encoded, so ``rel`` is the literal name).  Spark's file sources skip names
    starting with ``_`` or ``.``.
    """
    base = _root_path_len(spark, root)
    df = (spark.read.format("binaryFile")
          .option("recursiveFileLookup", True)
          .load(escape_glob(root))
          .select("path", "length", F.col("modificationTime").alias("modified")))
    return df.select("path",
                     F.substring(_path_part(F.col("path")), base + 2, 1 << 30).alias("rel"),
                     "length", "modified")


def _root_path_len(spark: SparkSession, root: str) -> int:
    """Length of the root's path part, as it prefixes the listed file paths."""
    import re

    q = qualify(root, spark)
    return len(re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "", q))


def list_directory(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root`` in path order (the sorted flat listing)."""
    return list_files(spark, root).orderBy("path")


def pack_files(spark: SparkSession, root: str, out: str, num_files: int | None = None,
               mode: str = "errorifexists", target_bytes: int = 128 << 20) -> DataFrame:
    """Pack many small files into ``num_files`` Parquet container files (default: one for each ``target_bytes``).

    Rows are ``(path, rel, length, modified, content)``; returns the packed
    table read back.  Every file is packed: empty ones, and hidden ones (names
    starting with ``_`` or ``.``), which Spark's file sources skip, are read by
    a tree walk in tasks (``modified`` is null for them).
    """
    from lakeshard.operators.copy import read_bytes, walk_tree

    base = _root_path_len(spark, root)
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
          .load(escape_glob(root))
          .select("path",
                  F.substring(_path_part(F.col("path")), base + 2, 1 << 30).alias("rel"),
                  "length", F.col("modificationTime").alias("modified"), "content"))
    top = qualify(root, spark)
    odd = (walk_tree(spark, root).where(~F.col("is_dir") & (F.col("rel").rlike("/[._]") | (F.col("length") == 0)))
           .select(F.concat(F.lit(top), "rel").alias("path"), F.substring("rel", 2, 1 << 30).alias("rel"), "length"))
    odd = odd.mapInPandas(read_bytes, "path string, rel string, length long, content binary")
    both = df.unionByName(odd.withColumn("modified", F.lit(None).cast("timestamp")))
    if num_files is None:
        size = df.agg(F.sum("length")).first()[0] or 0  # of the listing that ``df`` holds; no content is read
        num_files = max(1, -(-size // target_bytes))
    both.repartition(num_files).write.mode(mode).parquet(out)
    return spark.read.parquet(out)
