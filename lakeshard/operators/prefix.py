"""Running windows over keys of any size: a two-level prefix scan.

A window with ``PARTITION BY key`` holds all rows of a key in one task.  Here
rows are dealt by ranges of (key, order), so a key that holds a third of the
table lies in many tasks.  Each range gives one small row per key it meets:
its count, its sums and its last values.  A scan over these rows (a few per
task) tells what came before; the rest of the window is local to the range.

Rows that are equal in key and order have no defined order among themselves;
they stand in that of the scan.  The ranged rows are stored in the shared
folder, so what the scan counted is what the rows are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshard.session import scratch_dir

_LOW = (1 << 33) - 1


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there."""
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _null_safe(names: list[str]) -> list[Column]:
    """Columns that join like ``names`` with NULL as a value of its own."""
    return [c for n in names for c in (F.col(n).isNull(), F.col(n))]


def running(df: DataFrame, key: list[str], order: list[str | Column], *, row_number: str | None = None,
            sums: dict[str, str] | None = None, lags: dict[str, str] | None = None) -> DataFrame:
    """``df`` with running columns for each key, in the given order.

    ``row_number`` names the row number from 1; ``sums`` maps a new column to
    the column whose running sum it is (the row itself included, NULL until
    the first value); ``lags`` maps a new column to the column whose value in
    the row before it is (NULL in the first row).
    """
    sums, lags = sums or {}, lags or {}
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    by = [*[F.col(k) for k in key], *order]
    dealt = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = (dealt.repartitionByRange(*by, "_tie").sortWithinPartitions(*by, "_tie").drop("_tie")
              .withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)))
    ranged = stored(ranged, "running")

    # level one: a row for each key and range
    last = {n: F.max_by(F.struct(F.col(c).alias("v")), "_at").alias(f"_last_{n}") for n, c in lags.items()}
    parts = ranged.groupBy(*key, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"),
                                              *[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()], *last.values())
    # level two: what lies before, over the ranges of a key
    w = Window.partitionBy(*key).orderBy("_part")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(key)], F.col("_part").alias("_p"), "_first",
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows"),
                         *[F.sum(f"_sum_{n}").over(before).alias(f"_before_{n}") for n in sums],
                         *[F.lag(f"_last_{n}").over(w).alias(f"_prev_{n}") for n in lags])
    same = [F.col("_part") == F.col("_p"), *[F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(key)]]
    rows = ranged.join(stored(parts, "running-parts"), same)

    # within the range
    here = Window.partitionBy("_part", *key).orderBy("_at")
    out = [F.col(c) for c in df.columns]
    if row_number:
        out.append((F.col("_at") - F.col("_first") + F.col("_rows") + 1).alias(row_number))
    for n, c in sums.items():
        local = F.sum(c).over(here.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        both = F.coalesce(F.col(f"_before_{n}"), F.lit(0)) + F.coalesce(local, F.lit(0))
        out.append(F.when(local.isNotNull() | F.col(f"_before_{n}").isNotNull(), both).alias(n))
    for n, c in lags.items():
        out.append(F.when(F.col("_at") == F.col("_first"), F.col(f"_prev_{n}.v")).otherwise(F.lag(c).over(here)).alias(n))
    return rows.select(*out)
