"""DELETE, UPDATE and MERGE on a stored table that rewrite only the files with a hit.

1. A narrow pass over the columns of the condition (or the keys of a MERGE,
   semi-joined with the source's) names the files that hold a row to change;
   it is stored with the files' sizes and times.
2. Only these files are read in full, changed and staged, a batch of files a
   job, without a shuffle for DELETE and UPDATE.
3. The files must still be as recorded; then tasks swap them for the staged
   ones.  Untouched files keep their names and times.

Rows that a MERGE inserts are the source rows without a match, found against
the target's distinct keys; they are staged beside the changed files.  A
``not_matched_by_source`` clause concerns every target row without a match,
so it touches all files that hold one.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshard.operators.binpack import _stored, batches, same_state, swap_files
from lakeshard.operators.compact import _own, listing, table_info
from lakeshard.operators.rows import MergeError, When, _inserted, _true, delete_rows, merge_rows, update_rows
from lakeshard.sources.hadoop import Store

#: files that one job rewrites
FILES = 2000


def touched_files(rows: DataFrame, cond: Column) -> DataFrame:
    """``path`` of the files of ``rows`` with a row for which ``cond`` is true; reads the columns of ``cond`` only."""
    return rows.where(_true(cond)).select(F.col("_metadata.file_path").alias("path")).distinct()


def _keys_hit(rows: DataFrame, source: DataFrame, on: list[str], clauses: list[When]) -> DataFrame:
    narrow = rows.select(*on, F.col("_metadata.file_path").alias("path"))
    keys = source.select(*on).distinct()
    out = narrow.join(keys, on, "left_semi").select("path")
    if any(c.kind == "not_matched_by_source" for c in clauses):
        out = out.unionAll(narrow.join(keys, on, "left_anti").select("path"))
    return out.distinct()


class _Rewrite:
    """One change of a table: the recorded files, and the staged rows that take their place."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table, self.info = spark, table, table_info(spark, table)
        self.schema = spark.table(table).schema
        self.store = Store(spark, self.info.location)
        self.root = self.store.qualified(self.info.location).rstrip("/")
        self.staged = f"{self.root}/_touched-{int(time.time() * 1000)}"

    def live(self) -> DataFrame:
        pcols = self.info.partition_cols
        types = {f.name: f.dataType.simpleString() for f in self.schema}
        return _own(listing(self.spark, self.root, pcols, types), self.root, pcols).select("path", "length", "modified")

    def stage(self, rows: DataFrame) -> None:
        rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        w = rows.write.format(self.info.provider).options(**self.info.options).option("maxRecordsPerFile", 0).mode("append")
        (w.partitionBy(*self.info.partition_cols) if self.info.partition_cols else w).save(self.staged)

    def read(self, paths: list[str]) -> DataFrame:
        return (self.spark.read.format(self.info.provider).schema(self.schema).options(**self.info.options)
                .option("basePath", self.root).load(paths))

    def run(self, hit: DataFrame, change, extra: DataFrame | None = None) -> DataFrame:
        """Rewrite the files of ``hit`` (URIs as ``_metadata`` gives them) by ``change``; ``(files, untouched)``."""
        live = self.live()
        # _metadata writes paths as URIs: %XX stands for a byte
        plain = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
        bare = lambda c: F.regexp_replace(c, r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")
        named = hit.select(bare(plain).alias("_bare"))
        recorded = _stored(live.join(named, bare(F.col("path")) == F.col("_bare"), "left_semi"), "touched")
        n, all_files = recorded.count(), live.count()
        try:
            for some in batches(recorded.select("path"), FILES):
                self.stage(change(self.read([r["path"] for r in some])))
            if extra is not None:
                self.stage(extra)
            if not self.store.exists(self.staged):
                return self.spark.createDataFrame([(0, all_files)], "files bigint, untouched bigint")
            swap_files(self.spark, self.root, recorded, self.staged, self.info.partition_cols, lambda: same_state(recorded, self.live()))
            if self.info.partition_cols:  # partitions that are new
                self.spark.catalog.recoverPartitions(self.table)
        finally:
            self.store.delete(self.staged)
            self.spark.catalog.refreshTable(self.table)
        return self.spark.createDataFrame([(n, all_files - n)], "files bigint, untouched bigint")


def delete_from(spark: SparkSession, table: str, cond: Column) -> DataFrame:
    """``DELETE FROM table WHERE cond``; returns ``(files, untouched)``: files rewritten and left alone."""
    return _Rewrite(spark, table).run(touched_files(spark.table(table), cond), lambda rows: delete_rows(rows, cond))


def update_table(spark: SparkSession, table: str, assignments: dict[str, Column], cond: Column | None = None) -> DataFrame:
    """``UPDATE table SET ... WHERE cond``; returns ``(files, untouched)``."""
    hit = touched_files(spark.table(table), F.lit(True) if cond is None else cond)
    return _Rewrite(spark, table).run(hit, lambda rows: update_rows(rows, assignments, cond))


def merge_into(spark: SparkSession, table: str, source: DataFrame, on: list[str], clauses: list[When]) -> DataFrame:
    """``MERGE INTO table USING source ON equal keys``; returns ``(files, untouched)``.

    The source is stored first, as it is read once a batch.
    """
    target = spark.table(table)
    source = _stored(source, "merge-source")
    if any(c.kind == "matched" for c in clauses):
        many = source.dropna(subset=on).groupBy(*on).agg(F.count("*").alias("_c")).where("_c > 1")
        if not many.isEmpty() and not target.select(*on).join(many, on, "left_semi").isEmpty():
            raise MergeError("a target row matches more than one source row")
    changing = [c for c in clauses if c.kind != "not_matched"]
    inserts = any(c.kind == "not_matched" for c in clauses)
    extra = _stored(_inserted(target, source, on, clauses), "merge-inserts") if inserts else None  # before files move
    if extra is not None and extra.isEmpty():
        extra = None
    hit = _keys_hit(target, source, on, changing) if changing else target.select(F.col("_metadata.file_path").alias("path")).limit(0)
    return _Rewrite(spark, table).run(hit, lambda rows: merge_rows(rows, source, on, changing, check_duplicates=False), extra)
