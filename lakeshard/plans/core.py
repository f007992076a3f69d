"""Queries for the inverted index (survey A1) over the ``documents`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshard.functions.text import doc_stem
from lakeshard.operators import index as ix
from lakeshard.operators import segments as sg
from lakeshard.plans.registry import query
from lakeshard.session import scratch_dir
from lakeshard.sources.tables import read_table

BLOCK = ix.DEFAULT_BLOCK
# The query terms of the lookup query.
LOOKUP_TERMS = ["of", "the"]


def _docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text")


# DuckDB spelling of the tokeniser: split on CR LF or one blank, drop ''.
_TOK = r"""tok AS (
  SELECT doc_id AS doc, unnest(string_split_regex(text, '\r\n| ')) AS word FROM documents
), tf AS (
  SELECT word, doc, count(*) AS tf FROM tok WHERE word <> '' GROUP BY word, doc
)"""


@query("tokens", oracle=r"""
SELECT doc_id AS doc, word FROM (
  SELECT doc_id, unnest(string_split_regex(text, '\r\n| ')) AS word FROM documents
) WHERE word <> ''""")
def q_tokens(spark, sf_dir):
    return ix.token_stream(_docs(spark, sf_dir))


@query("term_frequency", oracle=f"WITH {_TOK} SELECT word, doc, tf FROM tf")
def q_term_frequency(spark, sf_dir):
    return ix.term_frequency(_docs(spark, sf_dir))


@query("document_frequency", oracle=f"""WITH {_TOK}
SELECT word, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf GROUP BY word""")
def q_document_frequency(spark, sf_dir):
    return ix.document_frequency(ix.term_frequency(_docs(spark, sf_dir)))


_INDEX_SQL = f"""WITH {_TOK},
p AS (SELECT word, '(' || CAST(doc AS VARCHAR) || ',' || CAST(tf AS VARCHAR) || ')' AS posting FROM tf),
r AS (SELECT word, posting, row_number() OVER (PARTITION BY word ORDER BY posting) - 1 AS rnk FROM p),
b AS (SELECT word, CAST(rnk // {BLOCK} AS BIGINT) AS block, count(*) AS n,
             '{{' || string_agg(posting, ',' ORDER BY posting) || '}}' AS postings_text
      FROM r GROUP BY word, rnk // {BLOCK})"""


@query("inverted_index", oracle=f"{_INDEX_SQL} SELECT word, block, n, postings_text FROM b")
def q_inverted_index(spark, sf_dir):
    idx = ix.inverted_index(_docs(spark, sf_dir), block_size=BLOCK)
    return ix.render_postings(idx).select("word", "block", "n", "postings_text")


@query("inverted_index_text",
       oracle=f"""{_INDEX_SQL} SELECT word, block, '"' || word || '": ' || postings_text AS line FROM b""")
def q_inverted_index_text(spark, sf_dir):
    return ix.render_lines(ix.inverted_index(_docs(spark, sf_dir), block_size=BLOCK))


@query("inverted_index_small_blocks", oracle=_INDEX_SQL.replace(str(BLOCK), "7")
       + " SELECT word, block, n, postings_text FROM b")
def q_inverted_index_small_blocks(spark, sf_dir):
    """Block size 7: every common word is cut into many ordered blocks."""
    idx = ix.inverted_index(_docs(spark, sf_dir), block_size=7)
    return ix.render_postings(idx).select("word", "block", "n", "postings_text")


@query("index_lookup", oracle=f"""WITH {_TOK}
SELECT doc, count(*) AS matched, CAST(sum(tf) AS BIGINT) AS score FROM tf
WHERE word IN ('of', 'the') GROUP BY doc HAVING count(*) = 2""")
def q_index_lookup(spark, sf_dir):
    return ix.index_lookup(ix.term_frequency(_docs(spark, sf_dir)), LOOKUP_TERMS)


@query("index_lookup_stored", oracle=f"""WITH {_TOK}
SELECT doc, count(*) AS matched, CAST(sum(tf) AS BIGINT) AS score FROM tf
WHERE word IN ('of', 'the') GROUP BY doc HAVING count(*) = 2""")
def q_index_lookup_stored(spark, sf_dir):
    """The index is written once, then looked up; only the terms' row groups are read."""
    path = scratch_dir(spark, "index") + "/words"
    ix.write_index(ix.inverted_index(_docs(spark, sf_dir)), path)
    return ix.lookup_stored(spark, path, LOOKUP_TERMS)


def _segmented(spark, sf_dir):
    """The documents indexed as three segments, by thirds of their ids."""
    path, docs = scratch_dir(spark, "segments") + "/idx", _docs(spark, sf_dir)
    lo, hi = docs.agg(F.percentile_approx("doc", [0.33, 0.66], 100)).first()[0]
    for part in (F.col("doc") <= lo, (F.col("doc") > lo) & (F.col("doc") <= hi), F.col("doc") > hi):
        sg.append_segment(docs.where(part), path, block_size=64)
    return path


@query("index_segments_lookup", oracle=f"""WITH {_TOK}
SELECT doc, count(*) AS matched, CAST(sum(tf) AS BIGINT) AS score FROM tf
WHERE word IN ('of', 'the') GROUP BY doc HAVING count(*) = 2""")
def q_index_segments_lookup(spark, sf_dir):
    """A lookup over three appended segments opens only blocks whose document ranges meet."""
    return sg.lookup_segments(spark, _segmented(spark, sf_dir), LOOKUP_TERMS)


@query("index_segments_merged", oracle=f"WITH {_TOK} SELECT word, doc, tf FROM tf")
def q_index_segments_merged(spark, sf_dir):
    """Three segments merged into one from their postings: every posting of every document."""
    path = _segmented(spark, sf_dir)
    sg.merge_segments(spark, path)
    return sg.postings(sg.read_segments(spark, path))


@query("search_documents", oracle=f"""WITH {_TOK}
SELECT doc, count(*) AS matched, CAST(sum(tf) AS BIGINT) AS score FROM tf
WHERE word IN ('of', 'the') GROUP BY doc HAVING count(*) = 2""")
def q_search_documents(spark, sf_dir):
    return ix.search_documents(_docs(spark, sf_dir), LOOKUP_TERMS)


@query("doc_stem", oracle="""
SELECT page_id, split_part(url_decode(string_split(url, '/')[-1]), '.', 1) AS stem FROM pages""")
def q_doc_stem(spark, sf_dir):
    return read_table(spark, sf_dir, "pages").select("page_id", doc_stem("url").alias("stem"))
