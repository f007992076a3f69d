"""Column expressions for tokenising text and naming documents.

All of these are built-in Spark expressions, so they stay inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the reference splits lines on CR LF, then words on one blank.
DEFAULT_SPLIT = "\r\n| "


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokens(text, split_on: str = DEFAULT_SPLIT) -> Column:
    """Array of the non-empty tokens of ``text`` (case kept, punctuation kept)."""
    parts = F.split(F.coalesce(_c(text), F.lit("")), split_on)
    return F.filter(parts, lambda t: t != F.lit(""))


def file_name(path) -> Column:
    """Last path segment of a file URI, URL-decoded (Spark encodes blanks etc.).

    A literal ``+`` is kept: the URI form leaves it unencoded, while the
    form decoder would read it as a blank.
    """
    last = F.element_at(F.split(_c(path), "/"), -1)
    return F.url_decode(F.replace(last, F.lit("+"), F.lit("%2B")))


def doc_stem(path) -> Column:
    """Document id of a file: the file name up to its first ``.`` (``a.b.txt`` -> ``a``)."""
    return F.substring_index(file_name(path), ".", 1)


def posting_key(doc, tf) -> Column:
    """The rendered posting ``(doc,tf)``; posting lists are ordered by this string."""
    return F.concat(F.lit("("), _c(doc).cast("string"), F.lit(","), _c(tf).cast("string"), F.lit(")"))
