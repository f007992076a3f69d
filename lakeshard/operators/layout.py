"""Small-file-aware write layouts and compaction policies (survey A4).

Each writer decides how many write tasks (hence files) a write produces and
which rows share a file:

=====================  ==========================================  =========
writer                 distribution                                 shuffle
=====================  ==========================================  =========
write_coalesced        merge input partitions, ``coalesce(n)``       no
write_repartitioned    round robin to ``n`` partitions               yes
write_ranged           ``repartitionByRange(n, keys)``: disjoint     yes
                       key ranges per file (sampled bounds)
write_distributed      hash on the partition columns: one file       yes
                       per output partition directory
write_salted           partition columns + deterministic salt:       yes
                       ``n`` files per directory
write_skew_split       hot keys salted over ``n`` tasks, the rest    yes
                       by key, in one exchange
write_rebalanced       ``REBALANCE`` hint: AQE splits skewed and      yes
                       merges small shuffle partitions
=====================  ==========================================  =========

Salts come from ``xxhash64`` of the row, never ``rand()``, so a retried task
routes every row the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshard.functions.hashing import salt, salt_hash
from lakeshard.operators.compact import (DEFAULT_TARGET_BYTES, compact_table, file_stats, listing,
                                         table_info)


def _save(df: DataFrame, path: str, fmt: str, mode: str, partition_by=None, options=None):
    w = df.write.format(fmt).mode(mode).option("maxRecordsPerFile", 0)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def _num_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def write_coalesced(df: DataFrame, path: str, n: int, fmt: str = "parquet",
                    mode: str = "errorifexists", partition_by=None) -> str:
    """At most ``n`` files without a shuffle; the write runs with ``n`` tasks."""
    return _save(df.coalesce(n), path, fmt, mode, partition_by)


def write_repartitioned(df: DataFrame, path: str, n: int, fmt: str = "parquet",
                        mode: str = "errorifexists") -> str:
    """Exactly ``n`` files (if there are ``n`` rows); upstream parallelism is kept."""
    return _save(df.repartition(n), path, fmt, mode)


def write_ranged(df: DataFrame, path: str, n: int, keys: list[str], fmt: str = "parquet",
                 mode: str = "errorifexists") -> str:
    """``n`` files holding disjoint, sorted key ranges (good for history merges)."""
    return _save(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys), path, fmt, mode)


def write_distributed(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet",
                      mode: str = "errorifexists") -> str:
    """``DISTRIBUTE BY`` the partition columns: one file per partition directory,
    more where a directory's rows outgrow Spark's advisory partition size."""
    return _save(df.hint("rebalance", *partition_by), path, fmt, mode, partition_by)


def write_salted(df: DataFrame, path: str, partition_by: list[str], n: int,
                 fmt: str = "parquet", mode: str = "errorifexists") -> str:
    """``DISTRIBUTE BY cols, salt``: up to ``n`` files per partition directory, over ``n`` tasks at least."""
    s = salt(df, n)
    return _save(df.repartition(max(_num_partitions(df), n), *partition_by, s), path, fmt, mode, partition_by)


def hot_keys(df: DataFrame, key: str, share: float = 0.1) -> DataFrame:
    """Keys holding at least ``share`` of all rows: ``(key, rows, share)``.

    At most ``1/share`` keys qualify, so the result is small by construction.
    The per-key counts use partial aggregation; the total is one scalar.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = df.count()
    return (counts.where(F.col("rows") >= F.lit(share * total))
            .withColumn("share", F.col("rows") / F.lit(max(total, 1))))


def skew_split_key(df: DataFrame, key: str, hot, n: int = 8) -> Column:
    """Routing column: a salt for hot keys, 0 for the rest.

    ``hot`` is a list of keys (each split ``n`` ways) or a dict
    ``key -> salt count``.
    """
    if not hot:
        return F.lit(0)
    if isinstance(hot, dict):
        counts = F.create_map(*[x for k, v in hot.items() for x in (F.lit(k), F.lit(int(v)))])
        salts = F.element_at(counts, F.col(key))
        return F.when(salts.isNull(), F.lit(0)).otherwise(salt(df, salts))
    return F.when(F.col(key).isin(list(hot)), salt(df, n)).otherwise(F.lit(0))


def write_skew_split(df: DataFrame, path: str, key: str, n: int | None = None, hot=None,
                     share: float | None = None, max_rows_per_task: int = 10_000_000,
                     partition_by=None, fmt: str = "parquet", mode: str = "errorifexists") -> str:
    """Hot keys spread over several tasks each, other keys one task per key.

    ``hot`` defaults to every key with more than ``max_rows_per_task`` rows,
    whatever its share: there are at most ``rows / max_rows_per_task``.  With
    ``share``, keys of at least that share of all rows are hot too.  Each
    gets ``n`` salts, or, when ``n`` is None, ``ceil(rows /
    max_rows_per_task)`` from its own row count, so its files stay the same
    size at any scale.  The row's hash is taken before the join with them.
    """
    partitions = _num_partitions(df)
    if hot is not None:
        routed = df.repartition(partitions, F.col(key), skew_split_key(df, key, hot, n or 8))
        return _save(routed, path, fmt, mode, partition_by)
    salts = F.lit(n) if n else F.ceil(F.col("_rows") / F.lit(max_rows_per_task))
    hot_rows = F.col("_rows") > max_rows_per_task
    if share is not None:
        hot_rows = hot_rows | (F.col("_rows") >= share * df.count())
    big = (df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
           .where(hot_rows).select("_key", salts.cast("int").alias("_salts")))
    hashed = df.withColumn("_h", salt_hash(df.columns))
    joined = hashed.join(big, F.col(key).eqNullSafe(F.col("_key")), "left")
    # An explicit partition count: AQE must not merge the salted hot-key
    # partitions back into one.
    routed = joined.repartition(partitions, F.col(key), F.coalesce(F.pmod(F.col("_h"), F.col("_salts")), F.lit(0)))
    return _save(routed.select(*df.columns), path, fmt, mode, partition_by)


def write_rebalanced(df: DataFrame, path: str, partition_by: list[str] | None = None,
                     fmt: str = "parquet", mode: str = "errorifexists") -> str:
    """Let AQE size the output partitions (``REBALANCE`` hint)."""
    cols = partition_by or []
    return _save(df.hint("rebalance", *cols), path, fmt, mode, partition_by)


def small_file_report(df: DataFrame, partition_by=(), small_bytes: int = 32 << 20) -> DataFrame:
    """Per partition of a scan: ``files, bytes, rows, small_files, avg_file_bytes``.

    Counts what rows come from; ``table_file_report`` also sees files without rows.
    """
    per_file = (df.select(*partition_by, F.col("_metadata.file_path").alias("_f"),
                          F.col("_metadata.file_size").alias("_s"))
                .groupBy(*partition_by, "_f")
                .agg(F.max("_s").alias("_s"), F.count(F.lit(1)).alias("_r")))
    return (per_file.groupBy(*partition_by)
            .agg(F.count(F.lit(1)).alias("files"), F.sum("_s").alias("bytes"),
                 F.sum("_r").alias("rows"),
                 F.sum(F.when(F.col("_s") < small_bytes, 1).otherwise(0)).alias("small_files"))
            .withColumn("avg_file_bytes", (F.col("bytes") / F.col("files")).cast("long")))


def table_file_report(spark: SparkSession, table: str, small_bytes: int = 32 << 20) -> DataFrame:
    """Per partition of catalog ``table``: ``files, bytes, small_files, avg_file_bytes``.

    Counted from a listing, so files without rows are there too and no data is read.
    """
    info = table_info(spark, table)
    files = listing(spark, info.location, info.partition_cols, dict(spark.table(table).dtypes))
    return (files.groupBy(*info.partition_cols)
            .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"),
                 F.sum(F.when(F.col("length") < small_bytes, 1).otherwise(0)).alias("small_files"))
            .where("files > 0")
            .withColumn("avg_file_bytes", (F.col("bytes") / F.col("files")).cast("long")))


def auto_compact(spark: SparkSession, table: str, min_small_files: int = 16,
                 small_bytes: int = 32 << 20, major: bool = False,
                 target_bytes: int = DEFAULT_TARGET_BYTES) -> list[DataFrame]:
    """Compact the partitions (or the table) that crossed the small-file trigger.

    Minor (default): partitions with more than ``min_small_files`` files under
    ``small_bytes``; only those files are merged, larger ones stay in place.
    Major: every partition with more than one file, all of its files.
    Returns the compaction reports.
    """
    info = table_info(spark, table)
    pcols = info.partition_cols
    rep = table_file_report(spark, table, small_bytes)
    trig = F.col("files") > 1 if major else F.col("small_files") > min_small_files
    # One row per partition that crossed the trigger: catalog-sized.
    due = rep.where(trig).select(*pcols).collect() if pcols else rep.where(trig).collect()
    if not due:
        return []
    small = None if major else small_bytes
    if not pcols:
        return [compact_table(spark, table, target_bytes=target_bytes, small_bytes=small)]
    return [compact_table(spark, table, target_bytes=target_bytes, small_bytes=small,
                          where=partitions_in(spark.table(table), pcols, due))]


def partitions_in(df: DataFrame, pcols: list[str], values: list) -> Column:
    """Predicate ``struct(pcols) IN (...)`` for a list of partition rows.

    It references partition columns only, so it prunes partitions at the
    scan; with more than a few values Catalyst turns it into a hash-set test.
    """
    types = dict(df.dtypes)

    def lit_struct(r):
        return F.struct(*[F.lit(r[c]).cast(types[c]).alias(c) for c in pcols])

    return F.struct(*[F.col(c) for c in pcols]).isin([lit_struct(r) for r in values])


def compact_history(spark: SparkSession, table: str, before: dict,
                    num_files: int | None = None,
                    target_bytes: int = DEFAULT_TARGET_BYTES) -> list[DataFrame]:
    """Offline merge of old partitions: every partition with ``col < value``
    for each ``col: value`` in ``before``."""
    info = table_info(spark, table)
    pcols = info.partition_cols
    cond = F.lit(True)
    for k, v in before.items():
        if k not in pcols:
            raise ValueError(f"{k} is not a partition column of {table}")
        cond = cond & (F.col(k) < F.lit(v))
    return [compact_table(spark, table, num_files=num_files, target_bytes=target_bytes, where=cond)]


def file_count(spark: SparkSession, path: str, fmt: str = "parquet", partition_by=()) -> DataFrame:
    """Files and rows per partition directory of a written path."""
    return file_stats(spark.read.format(fmt).load(path), partition_by)


def append_and_compact(df: DataFrame, table: str, min_small_files: int = 16,
                       small_bytes: int = 32 << 20, major: bool = False) -> list[DataFrame]:
    """Append ``df`` to ``table``, then run the small-file trigger on it.

    Checking right after the write catches small files where they appear,
    instead of in one large offline merge.
    """
    df.write.insertInto(table)
    return auto_compact(df.sparkSession, table, min_small_files=min_small_files,
                        small_bytes=small_bytes, major=major)
