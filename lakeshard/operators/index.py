"""Inverted index over a document DataFrame.

Plan shape (all JVM-side):

    scan(doc, text) -> [round robin if the scan has fewer splits than cores]
      -> words of a row sorted and counted in the row -> Generate   = term_frequency
      -> stored once, so no text is split again
      -> words of more postings than a chunk (few, broadcast by AQE)
      -> Exchange rangepartitioning(word, chunk) -> one array per chunk
      -> sorted and cut into blocks in the row                      = posting blocks

A posting list is never collected whole.  Postings are cut into blocks of at
most ``block_size`` entries by their rank inside the word, so a stop word
present in every document turns into many bounded rows instead of one
unbounded row.  A word of at most one chunk (a whole number of blocks, about
``CHUNK_ROWS`` postings) is gathered, sorted and cut in one row.  Only words
beyond that need ranks, which come without putting a word into one task:
the range exchange on ``(word, posting)`` splits a hot word over several
partitions, the row position inside each sorted partition is read off
``monotonically_increasing_id``, and the count of the same word in earlier
partitions comes from a per-(partition, word) segment table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshard.functions.text import DEFAULT_SPLIT, posting_key, tokens
from lakeshard.operators.prefix import stored
from lakeshard.sources.tables import ensure_parallelism

DEFAULT_BLOCK = 4096
#: postings that one row may gather before it is cut into blocks
CHUNK_ROWS = 1 << 16
#: repeated document ids that are broadcast; more of them join by a shuffle
_FEW_IDS = 100_000


def token_stream(docs: DataFrame, doc: str = "doc", text: str = "text",
                 split_on: str = DEFAULT_SPLIT) -> DataFrame:
    """One row per token occurrence: ``(doc, word)``.

    Empty tokens (leading, trailing or doubled blanks) are dropped after the
    explode, where the filter is part of the generated code.
    """
    docs = ensure_parallelism(docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")))
    return (docs.select("doc", F.explode(F.split(F.coalesce(F.col("text"), F.lit("")), split_on))
                        .alias("word"))
            .where(F.col("word") != ""))


def _counted_by_shuffle(docs: DataFrame, doc: str = "doc", text: str = "text",
                        split_on: str = DEFAULT_SPLIT) -> DataFrame:
    """``term_frequency`` of documents that may lie in several rows."""
    return (token_stream(docs, doc, text, split_on)
            .groupBy("word", "doc").agg(F.count(F.lit(1)).alias("tf")))


def _counted_in_row(docs: DataFrame, split_on: str) -> DataFrame:
    """``term_frequency`` of documents (``doc, text``) of one row each: no shuffle, no hash table.

    The words of a row are sorted; a word's count is the distance between
    its first place and that of the next word.  ``explode_outer``: for the
    plain form Catalyst would repeat the whole expression as a filter below.
    """
    words = docs.select("doc", F.sort_array(tokens("text", split_on)).alias("_w"))
    firsts = words.select("doc", "_w", F.expr(
        "filter(transform(_w, (w, i) -> if(i > 0 AND w = _w[i - 1], -1, i)), i -> i >= 0)").alias("_s"))
    pairs = firsts.select("doc", F.expr(
        "transform(_s, (i, k) -> struct(_w[i] AS word,"
        " CAST(if(k + 1 < size(_s), _s[k + 1], size(_w)) - i AS BIGINT) AS tf))").alias("_p"))
    return (pairs.select("doc", F.explode_outer("_p").alias("_p")).where("_p IS NOT NULL")
            .select("_p.word", "doc", "_p.tf"))


def term_frequency(docs: DataFrame, doc: str = "doc", text: str = "text",
                   split_on: str = DEFAULT_SPLIT) -> DataFrame:
    """``(word, doc, tf)``: occurrences of each word per document.

    A document of one row is counted within the row.  Ids that several rows
    share (found by a job over the ids alone) are counted by a shuffle of
    their ``(word, doc)`` pairs.
    """
    docs = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    repeated = (docs.groupBy("doc").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
                .select(F.col("doc").alias("_doc")))
    if repeated.limit(_FEW_IDS + 1).count() <= _FEW_IDS:
        repeated = F.broadcast(repeated)
    same = F.col("doc").eqNullSafe(F.col("_doc"))
    dealt = ensure_parallelism(docs)
    return (_counted_in_row(dealt.join(repeated, same, "left_anti"), split_on)
            .unionAll(_counted_by_shuffle(docs.join(repeated, same, "left_semi"), split_on=split_on)))


def document_frequency(tf: DataFrame) -> DataFrame:
    """``(word, df, cf)``: documents holding the word and total occurrences."""
    return tf.groupBy("word").agg(F.count(F.lit(1)).alias("df"),
                                  F.sum("tf").alias("cf"))


def _tagged_postings(tf: DataFrame, num_ranges: int | None) -> DataFrame:
    """Postings range-partitioned and sorted by ``(word, posting)``, each
    tagged with its partition ``_pid`` and its position ``_pos`` there."""
    p = tf.withColumn("posting", posting_key("doc", "tf"))
    # Without an explicit count AQE may merge adjacent small ranges (order is
    # kept: a merged task reads a contiguous run of ranges); it never merges
    # large ones, so a hot word still spans several partitions.
    ranged = (p.repartitionByRange(num_ranges, "word", "posting") if num_ranges
              else p.repartitionByRange("word", "posting"))
    s = (ranged
         .sortWithinPartitions("word", "posting")
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_pos", F.monotonically_increasing_id()))
    # The range split comes from a sampling job, and the row positions from
    # the order inside each partition: pin both by writing the tagged rows
    # once to the shared folder, so every use below sees the same rows
    # (two separately planned exchanges could sample different bounds).
    return stored(s.drop("posting"), "postings").withColumn("posting", posting_key("doc", "tf"))


def _segments(s: DataFrame) -> DataFrame:
    """One row per (range partition, word): ``_start`` (first position of the
    word there), ``_off`` (its postings in earlier partitions) and ``_df``
    (its postings overall).  A word has at most one row per partition, so the
    windows over ``word`` are bounded by the partition count."""
    seg = s.groupBy("_pid", "word").agg(F.min("_pos").alias("_start"),
                                        F.count(F.lit(1)).alias("_n"))
    by_word = Window.partitionBy("word")
    before = by_word.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return (seg.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
            .withColumn("_df", F.sum("_n").over(by_word)).drop("_n"))


def ranked_postings(tf: DataFrame, num_ranges: int | None = None) -> DataFrame:
    """``(word, doc, tf, posting, rank)``; rank is 0-based in posting-string order.

    Postings are ordered by the rendered string ``(doc,tf)`` as in the
    reference, so doc ``10`` sorts before doc ``2``.
    """
    s = _tagged_postings(tf, num_ranges)
    seg = _segments(s).drop("_df")
    return (s.join(seg, ["_pid", "word"])
            .select("word", "doc", "tf", "posting",
                    (F.col("_off") + F.col("_pos") - F.col("_start")).alias("rank")))


def posting_blocks(tf: DataFrame, block_size: int = DEFAULT_BLOCK,
                   num_ranges: int | None = None) -> DataFrame:
    """``(word, doc, tf, posting, block)`` with ``block = rank // block_size``.

    Only words with more than ``block_size`` postings need a rank; every
    other word is block 0.  The segment table is therefore joined for those
    words only: at most ``postings / block_size`` words, each with one row per
    partition it spans.  AQE measures it and broadcasts it when it is small,
    so the postings themselves are not shuffled for the join.
    """
    s = _tagged_postings(tf, num_ranges)
    hot = _segments(s).where(F.col("_df") > block_size).drop("_df")
    j = s.join(hot, ["_pid", "word"], "left")
    rank = F.col("_off") + F.col("_pos") - F.col("_start")
    block = F.when(F.col("_start").isNull(), F.lit(0)).otherwise(F.floor(rank / block_size))
    return j.select("word", "doc", "tf", "posting", block.cast("long").alias("block"))


def chunked(tf: DataFrame, block_size: int, place) -> tuple[DataFrame, int]:
    """``tf`` with the number ``_chunk`` of its chunk within the word, and the blocks of a chunk.

    A word of at most one chunk is chunk 0.  ``place(rows, size)`` numbers the
    chunks of ``size`` postings of the other words, as column ``block``; there
    are at most ``postings / size`` of these words.
    """
    per_chunk = max(1, CHUNK_ROWS // block_size)
    size = block_size * per_chunk
    hot = stored(tf.groupBy("word").agg(F.count(F.lit(1)).alias("_df")).where(F.col("_df") > size).select("word"), "hot-words")
    cold = tf.join(hot, "word", "left_anti").withColumn("_chunk", F.lit(0).cast("long"))
    if hot.isEmpty():
        return cold, per_chunk
    placed = place(tf.join(hot, "word", "left_semi"), size)
    return cold.unionAll(placed.select(*tf.columns, F.col("block").alias("_chunk"))), per_chunk


def cut(chunks: DataFrame, block_size: int, per_chunk: int) -> DataFrame:
    """Chunks ``word, _chunk, _p`` (sorted arrays) as blocks ``word, block, p``, in order."""
    pieces = F.expr(f"transform(sequence(0, (size(_p) - 1) div {int(block_size)}),"
                    f" i -> slice(_p, CAST(i * {int(block_size)} + 1 AS INT), {int(block_size)}))")
    return (chunks.select("word", "_chunk", F.posexplode_outer(pieces).alias("_i", "p"))
            .select("word", (F.col("_chunk") * per_chunk + F.col("_i")).alias("block"), "p"))


def inverted_index(docs: DataFrame, doc: str = "doc", text: str = "text",
                   block_size: int = DEFAULT_BLOCK, split_on: str = DEFAULT_SPLIT,
                   num_ranges: int | None = None) -> DataFrame:
    """``(word, block, n, postings)`` with ``postings`` an ordered
    ``array<struct<posting, doc, tf>>`` of at most ``block_size`` entries.

    Blocks of one word, read in ``block`` order, give the word's full posting
    list in the reference's order; a word in fewer than ``block_size``
    documents has the single block 0.

    Rows are in the order of ``(word, block)``: the exchange that brings a
    chunk together is one by ranges, so the order costs no further shuffle.
    """
    if block_size < 1:
        raise ValueError("block_size must be >= 1")
    tf = stored(term_frequency(docs, doc, text, split_on), "tf")
    rows, per_chunk = chunked(tf, block_size, lambda hot, size: posting_blocks(hot, size, num_ranges))
    chunks = (rows.repartitionByRange("word", "_chunk").groupBy("word", "_chunk")
              .agg(F.array_sort(F.collect_list(F.struct(posting_key("doc", "tf").alias("posting"), "doc", "tf"))).alias("_p"))
              .sortWithinPartitions("word", "_chunk"))
    return cut(chunks, block_size, per_chunk).select("word", "block", F.size("p").cast("long").alias("n"),
                                                     F.col("p").alias("postings"))


def write_index(index: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store an index as Parquet; its files hold disjoint, sorted ranges of words."""
    index.write.mode(mode).parquet(path)


def lookup_stored(spark: SparkSession, path: str, terms: list[str]) -> DataFrame:
    """``index_lookup`` on a stored index: ``(doc, matched, score)``.

    The word filter reaches the scan, where the statistics of the sorted
    files and row groups leave only those that hold a term; no document is read.
    """
    wanted = sorted(set(terms))
    if not wanted:
        raise ValueError("terms must not be empty")
    tf = (spark.read.parquet(path).where(F.col("word").isin(wanted))
          .select("word", F.explode("postings").alias("p")).select("word", "p.doc", "p.tf"))
    return index_lookup(tf, wanted)


def render_postings(index: DataFrame) -> DataFrame:
    """Add ``postings_text``: ``{(d,n),(d,n)}`` without blanks."""
    return index.withColumn(
        "postings_text",
        F.concat(F.lit("{"), F.array_join(F.transform("postings", lambda p: p["posting"]), ","),
                 F.lit("}")))


def render_lines(index: DataFrame) -> DataFrame:
    """The reference's printed form, one line per block: ``"word": {(d,n),...}``."""
    r = render_postings(index)
    return r.select("word", "block",
                    F.concat(F.lit('"'), F.col("word"), F.lit('": '), F.col("postings_text")).alias("line"))


def index_lookup(tf: DataFrame, terms: list[str]) -> DataFrame:
    """Documents containing every one of ``terms``: ``(doc, matched, score)``.

    ``score`` is the summed term frequency of the query terms.  The term list
    is a user query (a handful of words), pushed into the scan as an IN filter.
    """
    wanted = sorted(set(terms))
    if not wanted:
        raise ValueError("terms must not be empty")
    return (tf.where(F.col("word").isin(wanted))
            .groupBy("doc")
            .agg(F.count(F.lit(1)).alias("matched"), F.sum("tf").alias("score"))
            .where(F.col("matched") == len(wanted)))


def search_documents(docs: DataFrame, terms: list[str], doc: str = "doc", text: str = "text",
                     split_on: str = DEFAULT_SPLIT) -> DataFrame:
    """Like ``index_lookup`` but straight from the documents, without an index.

    A document can only hold every term as a token if its text holds every
    term as a substring, so a ``contains`` filter runs first, before any text
    is split.  Only the surviving documents are tokenised, and only tokens
    equal to a term are counted.
    """
    wanted = sorted(set(terms))
    if not wanted:
        raise ValueError("terms must not be empty")
    cond = F.lit(True)
    for t in wanted:
        cond = cond & F.col(text).contains(t)
    cand = docs.where(cond)
    tf = _counted_by_shuffle(cand, doc, text, split_on).where(F.col("word").isin(wanted))
    return index_lookup(tf, wanted)
