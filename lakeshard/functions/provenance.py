"""Provenance columns (survey A5): who ran a job and on which Spark.

Both are built-in SQL expressions evaluated by Spark, not driver values
baked into the plan: ``current_user()`` and ``version()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_user():
    return F.current_user()


def spark_version():
    return F.version()


def with_provenance(df: DataFrame) -> DataFrame:
    """Add ``run_user`` and ``spark_version`` columns."""
    return df.withColumn("run_user", run_user()).withColumn("spark_version", spark_version())


def session_info(df: DataFrame) -> DataFrame:
    """One row per input row of ``df`` reduced to one row: ``(user, version, rows)``.

    Counts the rows of ``df`` so the report is tied to the data it describes.
    """
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        run_user().alias("user"), spark_version().alias("version"), "rows")
