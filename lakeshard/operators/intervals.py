"""Overlap join of two tables of intervals, with bins cut from the data.

Bins are cut at quantiles of the left starts, so dense stretches get narrow
bins; their number follows the rows, up to ``MAX_BINS`` (the cuts go along
with each task).  Both sides are copied into the bins that they touch, and a
pair is taken in the first bin that both touch, so it comes out once.  Where
many rows share a bin, for instance one point in time that a third of them
touch, the bin is split: the left side is dealt to salts, the right side is
copied to each salt.  The join is an equality on (bin, salt).

Bounds are closed: ``[a, b]`` and ``[b, c]`` overlap.  Rows with a NULL bound,
or whose end lies before the start, overlap with nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: bins at most, and rows of one side that a bin holds about
MAX_BINS = 10_000
BIN_ROWS = 2_000


def cuts(df: DataFrame, column: str, rows_per_bin: int = BIN_ROWS) -> list[float]:
    """Ascending quantiles of ``column`` that part its rows into bins of about ``rows_per_bin``."""
    n = df.count()
    bins = int(min(MAX_BINS, max(1, n // rows_per_bin)))
    if bins < 2:
        return []
    marks = [i / bins for i in range(1, bins)]
    found = df.agg(F.percentile_approx(F.col(column).cast("double"), marks, 4 * bins)).first()[0]
    return sorted(set(found or []))


def bin_of(value: Column, edges: list[float]) -> Column:
    """How many of the ascending ``edges`` are at most ``value``: a binary search that stays in the JVM."""
    if not edges:
        return F.lit(0)
    # the optimizer folds this to one constant
    table = F.split(F.lit(",".join(map(repr, edges))), ",").cast("array<double>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(edges).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(
        (at + s <= len(edges)) & (F.get(table, at + s - 1) <= value), at + s).otherwise(at))


def _binned(df: DataFrame, start: str, end: str, edges: list[float]) -> DataFrame:
    """A row for each bin that ``[start, end]`` touches: ``_bin``, and ``_first``, the first of them."""
    at = lambda c: bin_of(F.col(c).cast("double"), edges)
    return (df.where(F.col(start) <= F.col(end)).withColumn("_first", at(start))
            .withColumn("_bin", F.explode(F.sequence("_first", at(end)))))


def overlap_join(left: DataFrame, right: DataFrame, left_on: tuple[str, str], right_on: tuple[str, str],
                 rows_per_bin: int = BIN_ROWS, hot: int = 8) -> DataFrame:
    """Pairs of rows whose closed intervals overlap; ``left_on`` and ``right_on`` name start and end.

    A bin with more than ``hot * rows_per_bin`` left rows is split into salts
    of about ``rows_per_bin`` rows.  Column names of the two sides must not clash.
    """
    (a, b), (c, d) = left_on, right_on
    edges = cuts(left.where(F.col(a) <= F.col(b)), a, rows_per_bin)
    lb = _binned(left, a, b, edges).withColumn("_h", F.xxhash64(F.monotonically_increasing_id()))
    rb = _binned(right, c, d, edges).withColumnsRenamed({"_bin": "_bin2", "_first": "_first2"})
    # a row for each hot bin: MAX_BINS + 1 at most
    salts = (lb.groupBy(F.col("_bin").alias("_hot")).agg(F.count("*").alias("_n")).where(F.col("_n") > hot * rows_per_bin)
             .select("_hot", F.ceil(F.col("_n") / rows_per_bin).cast("int").alias("_salts")))
    lb = lb.join(F.broadcast(salts), F.col("_bin") == F.col("_hot"), "left").withColumn(
        "_salt", F.coalesce(F.pmod("_h", "_salts"), F.lit(0)).cast("int")).drop("_hot", "_salts", "_h")
    rb = rb.join(F.broadcast(salts), F.col("_bin2") == F.col("_hot"), "left").withColumn(
        "_salt2", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0))))).drop("_hot", "_salts")
    pair = ((F.col("_bin") == F.col("_bin2")) & (F.col("_salt") == F.col("_salt2"))
            & (F.greatest("_first", "_first2") == F.col("_bin")) & (F.col(a) <= F.col(d)) & (F.col(c) <= F.col(b)))
    return lb.join(rb, pair).select(*left.columns, *right.columns)


def largest_bin(left: DataFrame, left_on: tuple[str, str], rows_per_bin: int = BIN_ROWS) -> int:
    """Rows of the fullest bin before salting, for a look at the cuts."""
    edges = cuts(left, left_on[0], rows_per_bin)
    return _binned(left, *left_on, edges).groupBy("_bin").count().agg(F.max("count")).first()[0] or 0
