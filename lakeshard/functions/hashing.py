"""Row hashing helpers: deterministic salts and order-insensitive fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(df: DataFrame, cols=None) -> Column:
    """``xxhash64`` over the given columns (all by default)."""
    return F.xxhash64(*[F.col(c) for c in (cols or df.columns)])


def salt_hash(cols) -> Column:
    """Hash of a row and its place in the input split.

    Take it on a scan, before any join or shuffle: there a retried task meets
    the same rows in the same order and repeats every value.
    """
    return F.xxhash64(*[F.col(c) for c in cols], F.monotonically_increasing_id())


def salt(df: DataFrame, buckets, cols=None) -> Column:
    """Repeatable salt in ``[0, buckets)`` (``buckets`` may be a Column).

    The hash covers the row and its position in the input partition, so
    identical rows are spread too.  Unlike ``rand()``, a retried task over
    the same input split puts every row in the same bucket again; see
    ``salt_hash`` for where to take it.
    """
    n = buckets if isinstance(buckets, Column) else F.lit(buckets)
    return F.pmod(salt_hash(cols or df.columns), n).cast("int")


def digest_columns(df: DataFrame, cols=None) -> list[Column]:
    """Aggregates ``rows`` and ``digest``: equal multisets of rows give equal values.

    The digest is the exact decimal sum of 64-bit row hashes, so it does not
    depend on row order or partitioning.
    """
    return [F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(row_hash(df, cols or df.columns).cast("decimal(38,0)")),
                       F.lit(0).cast("decimal(38,0)")).alias("digest")]


def fingerprint(df: DataFrame, cols=None) -> DataFrame:
    """One row ``(rows, digest)``; see ``digest_columns``."""
    return df.agg(*digest_columns(df, cols))
