"""Column profiling and repeatable sampling (survey B19, B25).

``profile`` computes every column's statistics in ONE aggregate over the
scan (partial aggregation on every partition, one shuffle of tiny partial
rows), then unpivots the single result row with ``stack``.  Exact distinct
counts are an aggregate of their own for each column: together they would
expand every row once a column and hold all of that in one hash table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshard.functions.hashing import row_hash


def profile(df: DataFrame, cols: list[str] | None = None, exact: bool = False) -> DataFrame:
    """``(column, rows, nulls, distinct, min, max)`` per column.

    ``distinct`` is ``approx_count_distinct`` (HyperLogLog++, bounded state)
    unless ``exact``; min and max are rendered as strings.
    """
    cols = cols or df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"_n{i}"),
                 (F.lit(None).cast("long") if exact else F.approx_count_distinct(F.col(c))).alias(f"_d{i}"),
                 F.min(F.col(c)).cast("string").alias(f"_lo{i}"),
                 F.max(F.col(c)).cast("string").alias(f"_hi{i}")]
    one = df.agg(*aggs)
    parts = ", ".join(f"{i}, '{c}', _rows, _n{i}, _d{i}, _lo{i}, _hi{i}" for i, c in enumerate(cols))
    out = one.selectExpr(
        f"stack({len(cols)}, {parts}) AS (_i, column, rows, nulls, distinct_count, min, max)")
    if not exact:
        return out.drop("_i")
    counts = [df.select(F.col(c).alias("_v")).distinct().agg(F.lit(i).alias("_j"), F.count("_v").alias("_distinct"))
              for i, c in enumerate(cols)]
    distinct = F.broadcast(reduce(DataFrame.unionAll, counts))  # a row a column
    return (out.join(distinct, F.col("_i") == F.col("_j"))
            .select("column", "rows", "nulls", F.col("_distinct").alias("distinct_count"), "min", "max"))


def hash_sample(df: DataFrame, key: str, num: int, den: int) -> DataFrame:
    """Repeatable sample: rows whose key falls in ``num`` of ``den`` buckets.

    Integral keys use ``pmod(key, den)``; other keys are hashed first.  The
    same key always lands in the same bucket, so samples of two tables on a
    shared key join consistently.  Rows without a key are a bucket like any
    other, by the hash of NULL.
    """
    if not 0 <= num <= den or den < 1:
        raise ValueError("need 0 <= num <= den, den >= 1")
    dtype = dict(df.dtypes)[key]
    k: Column = F.col(key) if dtype in ("tinyint", "smallint", "int", "bigint") \
        else row_hash(df, [key])
    k = F.coalesce(k, F.xxhash64(F.lit(None).cast(dtype)))
    return df.where(F.pmod(k, F.lit(den)) < F.lit(num))


def sample_key(key: list[str], seed: int = 0) -> Column:
    """The hash that orders a sample: MD5 of seed and key columns as text (NULL as ``-``), the same in any engine."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in key]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))


def bottom_k(df: DataFrame, k: int, key: list[str], strata: list[str] | None = None, seed: int = 0) -> DataFrame:
    """Exactly ``k`` rows (all, if fewer) of the table or of each stratum: those with the smallest ``sample_key``.

    Repeatable whatever the partitioning as long as the keys are unique, and
    samples of two tables on one key agree.  Each task keeps its own ``k``
    smallest (of each stratum) before the shuffle, so a hot stratum costs
    ``k`` rows a task.
    """
    hashed = df.withColumn("_hash", sample_key(key, seed))
    if not strata:
        return hashed.orderBy("_hash", *key).limit(k).drop("_hash")
    w = Window.partitionBy(*strata).orderBy("_hash", *key)
    return hashed.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank", "_hash")
