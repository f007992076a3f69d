"""A stored index in segments: compressed posting blocks with skip data, appended and merged.

A segment holds the postings of some documents; a document lies in one
segment.  A row is a block of one word's postings in the order of documents:
``word, block, n, first_doc, last_doc, gaps, tfs``, with ``gaps`` the
distances from ``first_doc``, which Parquet packs into few bits.

New documents are a new segment; nothing that is stored is read for it.
Segments are merged from their postings, without any document.  A lookup
reads the heads of the terms' blocks first (no postings), keeps the blocks
whose ranges of documents meet a block of the rarest term, and opens only these.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshard.operators.index import DEFAULT_BLOCK, chunked, cut, index_lookup, term_frequency
from lakeshard.operators.intervals import overlap_join
from lakeshard.operators.prefix import running, stored
from lakeshard.sources.hadoop import Store

_HEAD = ["segment", "word", "block", "n", "first_doc", "last_doc"]


def _placed(tf: DataFrame, size: int) -> DataFrame:
    """``tf`` with its block of ``size`` postings; places within a word come from a two-level scan."""
    return running(tf, ["word"], ["doc"], row_number="_rn").withColumn("block", F.expr(f"(_rn - 1) div {int(size)}"))


def posting_blocks(tf: DataFrame, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Blocks of ``tf`` (``word, doc, tf``), in word order; only words beyond a chunk are placed by a scan."""
    rows, per_chunk = chunked(tf.select("word", "doc", "tf"), block_size, _placed)
    chunks = (rows.repartitionByRange("word", "_chunk").groupBy("word", "_chunk")
              .agg(F.array_sort(F.collect_list(F.struct("doc", "tf"))).alias("_p")).sortWithinPartitions("word", "_chunk"))
    first = F.col("p")[0]["doc"]
    return cut(chunks, block_size, per_chunk).select(
        "word", "block", F.size("p").cast("long").alias("n"), first.alias("first_doc"),
        F.element_at("p", -1)["doc"].alias("last_doc"), F.transform("p", lambda x: x["doc"] - first).alias("gaps"),
        F.transform("p", lambda x: x["tf"]).alias("tfs"))


def _write(blocks: DataFrame, path: str) -> str:
    """Stage a segment and rename it into place, so a reader meets whole segments only."""
    store = Store(blocks.sparkSession, path)
    name = uuid.uuid4().hex[:12]
    staged = f"{path.rstrip('/')}/_new-{name}"
    blocks.write.parquet(staged)
    store.rename(staged, f"{path.rstrip('/')}/segment={name}")
    return name


def append_segment(docs: DataFrame, path: str, doc: str = "doc", text: str = "text", block_size: int = DEFAULT_BLOCK) -> str:
    """Index ``docs`` (whole-number ids) as a new segment below ``path``; its name."""
    return _write(posting_blocks(stored(term_frequency(docs, doc, text), "tf"), block_size), path)


def read_segments(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """The blocks of all segments, or of some."""
    blocks = spark.read.option("basePath", path).parquet(path).withColumn("segment", F.col("segment").cast("string"))
    return blocks if names is None else blocks.where(F.col("segment").isin(names))


def postings(blocks: DataFrame) -> DataFrame:
    """``word, doc, tf`` of blocks."""
    pairs = F.arrays_zip(F.transform("gaps", lambda g: g + F.col("first_doc")).alias("doc"), F.col("tfs").alias("tf"))
    return blocks.select("word", F.explode(pairs).alias("p")).select("word", "p.doc", "p.tf")


def merge_segments(spark: SparkSession, path: str, names: list[str] | None = None, block_size: int = DEFAULT_BLOCK) -> str:
    """Merge segments (default: all) into one, from their postings; its name.  The old ones go when it is there.

    A reader between the two steps meets postings twice; merges are for a quiet time.
    """
    store = Store(spark, path)
    names = names or [n.split("=", 1)[1] for n in store.names(path) if n.startswith("segment=")]
    new = _write(posting_blocks(postings(read_segments(spark, path, names)), block_size), path)
    for n in names:
        store.delete(f"{path.rstrip('/')}/segment={n}")
    return new


def open_blocks(spark: SparkSession, path: str, terms: list[str]) -> DataFrame:
    """Keys of the blocks that a lookup of all ``terms`` has to open (``segment, word, block``)."""
    heads = read_segments(spark, path).where(F.col("word").isin(terms)).select(*_HEAD)
    sizes = {r["word"]: r["n"] for r in heads.groupBy("word").agg(F.sum("n").alias("n")).collect()}  # a row a term
    if len(sizes) < len(set(terms)):
        return heads.limit(0).select("segment", "word", "block")
    rare = min(sizes, key=lambda w: (sizes[w], w))
    mine = heads.where(F.col("word") == rare)
    ranges = mine.select(F.col("segment").alias("seg2"), F.col("first_doc").alias("lo"), F.col("last_doc").alias("hi"))
    met = (overlap_join(heads.where(F.col("word") != rare), ranges, ("first_doc", "last_doc"), ("lo", "hi"))
           .where("segment = seg2").select("segment", "word", "block").distinct())
    return mine.select("segment", "word", "block").unionAll(met)


def lookup_segments(spark: SparkSession, path: str, terms: list[str]) -> DataFrame:
    """Documents that hold every term: ``(doc, matched, score)``, as ``index_lookup``."""
    wanted = sorted(set(terms))
    if not wanted:
        raise ValueError("terms must not be empty")
    keys = open_blocks(spark, path, wanted)
    blocks = read_segments(spark, path).where(F.col("word").isin(wanted)).join(keys, ["segment", "word", "block"], "left_semi")
    return index_lookup(postings(blocks), wanted)
