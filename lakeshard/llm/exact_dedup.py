"""Exact deduplication with a heavy-hitter split (DataFrame functions only).

Texts are equal when they are identical; a null text counts as empty.  Every
text is reduced to its SHA-256 digest once, in a narrow table.  A Misra-Gries
type sketch (Spark's frequent-items aggregate) names at most ``max_heavy``
digests that may be frequent.  Their exact counts are verified by a second,
pre-aggregated pass, and the verified winners, a table of at most
``max_heavy`` rows, are broadcast: rows with a heavy digest are decided map
side and never shuffled, however large their group.  All other digests go
through an ordinary shuffle.

Defined cases: an empty table gives an empty result.  A null ``doc_id`` is
smaller than any other id, and a group without ids has a null ``keep_id``.
Rows that repeat both id and text cannot be told apart: all of them are
marked ``kept`` in ``decide``, and ``deduplicate`` returns one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeshard.llm.common import stored

#: at most this many digests are treated as heavy; bounds the broadcast table
MAX_HEAVY = 1024
#: counters of the sketch
TRACKED = 16384
#: a digest with fewer rows is left to the ordinary shuffle
MIN_HEAVY = 32


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, digest)`` of every row; 32 bytes stand for the text from here on."""
    return docs.select(F.col(id_col).alias("doc_id"), _digest(text_col).alias("digest"))


def _digest(text_col: str):
    return F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))


def winners(narrow: DataFrame, max_heavy: int = MAX_HEAVY, tracked: int = TRACKED,
            min_heavy: int = MIN_HEAVY) -> DataFrame:
    """Verified heavy groups: ``(digest, keep_id, group_size, id_rows)``, at most ``max_heavy`` rows."""
    named = (narrow.agg(F.expr(f"approx_top_k(hex(digest), {int(max_heavy)}, {int(tracked)})").alias("top"))
             .select(F.explode("top").alias("t"))
             .select(F.unhex(F.col("t.item")).alias("digest")))
    found = narrow.join(F.broadcast(named), "digest")
    sums = (found.groupBy("digest", "doc_id").agg(F.count("*").alias("rows"))
            .groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("rows").alias("group_size"),
                                   F.max_by("rows", F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("id_rows")))
    return stored(sums.where(F.col("group_size") >= min_heavy), "heavy")


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, max_heavy: int = MAX_HEAVY,
           tracked: int = TRACKED, min_heavy: int = MIN_HEAVY) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256, id_rows``.

    Of equal texts the row with the largest id stays.  ``id_rows`` counts the
    rows of the group that carry ``keep_id``; it is 1 unless rows repeat.
    """
    narrow = stored(digests(docs, id_col, text_col), "digests")
    heavy = winners(narrow, max_heavy, tracked, min_heavy)
    tagged = narrow.join(F.broadcast(heavy), "digest", "left")
    group = Window.partitionBy("digest")
    light = (tagged.where(F.col("group_size").isNull())
             .select("digest", "doc_id", F.max("doc_id").over(group).alias("keep_id"),
                     F.count("*").over(group).alias("group_size"))
             .withColumn("id_rows", F.count(F.when(F.col("doc_id").eqNullSafe(F.col("keep_id")), 1)).over(group)))
    cols = ["digest", "doc_id", "keep_id", "group_size", "id_rows"]
    both = light.select(cols).unionByName(tagged.where(F.col("group_size").isNotNull()).select(cols))
    return both.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                       F.lower(F.hex("digest")).alias("text_sha256"), "id_rows")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``."""
    decided = stored(decide(docs, id_col, text_col, **params), "decided")
    gone = decided.where(~F.col("kept"))
    again = decided.where(F.col("kept") & (F.col("id_rows") > 1))
    pick = [F.col("doc_id").alias("_gone_id"), F.unhex("text_sha256").alias("_gone_digest")]
    keyed = docs.withColumn("_digest", _digest(text_col))
    out = gone.select(pick).unionByName(again.select(pick).distinct())
    match = F.col(id_col).eqNullSafe(F.col("_gone_id")) & (F.col("_digest") == F.col("_gone_digest"))
    kept = keyed.join(out, match, "left_anti").select(docs.columns)
    if again.isEmpty():
        return kept
    repeats = (keyed.join(again.select(pick).distinct(), match, "left_semi")
               .groupBy("_digest").agg(F.first(F.struct(*docs.columns)).alias("row")).select("row.*"))
    return kept.unionByName(repeats)
