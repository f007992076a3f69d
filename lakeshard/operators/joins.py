"""Band (range) join with an equi bin key (survey D7).

A condition ``r + low <= l <= r + high`` alone leaves Spark a nested-loop
or, with an extra equality, a hash join that still pairs every row of a
key with every other.  Cutting the value axis into bins of ``bin_width``
turns the band into an equi-join on the bin: each left row lives in one
bin, each right row is copied into the (at most
``ceil((high - low) / bin_width) + 1``) bins its band touches, and the band
condition filters the candidates.  A pair meets in exactly one bin, the left
row's, so no output row is duplicated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def band_join(left: DataFrame, right: DataFrame, left_col: str, right_col: str,
              low: float, high: float, on: list[tuple[str, str]] = (),
              bin_width: float | None = None, how: str = "inner") -> DataFrame:
    """Rows of ``left`` and ``right`` with ``right[right_col] + low <= left[left_col]
    <= right[right_col] + high`` and ``left[a] == right[b]`` for each ``(a, b)`` in ``on``.

    ``how`` is ``inner`` or ``left``.  Column names of the two sides must not
    clash (select or rename first).
    """
    if high < low:
        raise ValueError("high must be >= low")
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    w = float(bin_width or (high - low) or 1.0)
    lb = left.withColumn("_band_bin", F.floor(F.col(left_col) / w))
    rcol = F.col(right_col)
    rb = right.withColumn("_band_bin", F.explode(F.sequence(F.floor((rcol + low) / w),
                                                             F.floor((rcol + high) / w))))
    cond = lb["_band_bin"] == rb["_band_bin"]
    for a, b in on:
        cond = cond & (lb[a] == rb[b])
    cond = cond & lb[left_col].between(rb[right_col] + low, rb[right_col] + high)
    return lb.join(rb, cond, how).drop(lb["_band_bin"]).drop(rb["_band_bin"])


def not_in(df: DataFrame, key: str, sub: DataFrame, sub_key: str) -> DataFrame:
    """Rows of ``df`` with ``key NOT IN (SELECT sub_key FROM sub)``, NULLs as in SQL.

    Spark's own null-aware anti join broadcasts the whole subquery, however
    large.  Here matching rows go by an ordinary anti join, and the two facts
    that NULLs depend on, whether the subquery has rows and whether one of
    them is NULL, come from scalar subqueries.
    """
    keys = sub.select(F.col(sub_key).alias("_sub"))
    rows = keys.agg(F.count("*")).scalar()
    nulls = keys.agg(F.count_if(F.col("_sub").isNull())).scalar()
    rest = df.join(keys, F.col(key) == F.col("_sub"), "left_anti")
    return rest.where((rows == 0) | ((nulls == 0) & F.col(key).isNotNull()))
