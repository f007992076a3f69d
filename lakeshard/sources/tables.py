"""Readers for the driver's Parquet tables.

Every read is a lazy parquet scan, so Catalyst pushes filters and column
pruning into it.  ``register_views`` names them as temp views (metadata
only, no data is read) for the SQL-form queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register each table as a temp view named after it."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


class Tables:
    """Attribute access to the tables of one scale factor: ``t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self._spark, self._dir, name)


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over ``min_partitions`` tasks if its scan is far too narrow for them.

    A file with one row group is read by one task; CPU-heavy per-row work
    (tokenising) after it would then run on one core.  The scan's splits are
    estimated from its files and size, without running or planning a job;
    only a scan with at most half the splits asked for is dealt anew, so a
    large input never is.  What does not come straight from files keeps its
    partitions.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    files = df.inputFiles()
    if not files:
        return df
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return df.repartition(target) if 2 * max(len(files), size // split) <= target else df
