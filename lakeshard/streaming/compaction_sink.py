"""Keep a streamed table compact (survey A4.11: compaction callable from
``foreachBatch``; small files mostly come from frequent writes).

``compacting_sink(table, ...)`` returns a ``foreachBatch`` function that
appends each micro-batch to a catalog table and, every ``every`` batches,
runs the small-file trigger of ``auto_compact`` on it.

Appending is idempotent by itself.  A batch is staged in a hidden folder and
its files are renamed into the table under names that begin with the epoch.
A replayed epoch, after a crash at any point, first removes the files of its
earlier attempt.  A marker of the last finished epoch (one file, replaced each
time) lets compaction merge files of finished epochs only, and tells replays
of those apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshard.operators.compact import _rel, listing, partition_spec_sql, table_info
from lakeshard.operators.layout import auto_compact
from lakeshard.sources.hadoop import Store


def append_epoch(batch: DataFrame, table: str, epoch_id: int) -> None:
    """Append ``batch`` to ``table`` as ``epoch_id``; repeating it changes nothing."""
    spark = batch.sparkSession
    info = table_info(spark, table)
    root, pcols, types = info.location.rstrip("/"), info.partition_cols, dict(spark.table(table).dtypes)
    store, mark, staged = Store(spark, root), f"epoch-{epoch_id}-", f"{root}/_epoch-{epoch_id}"
    store.delete(staged)
    for r in listing(spark, root, [], {}).where(F.col("path").contains(f"/{mark}")).select("path").collect():
        store.delete(r["path"])
    schema = spark.table(table).schema
    rows = batch.select(*[F.col(c).cast(f.dataType).alias(c) for c, f in zip(schema.names, schema.fields)])
    w = rows.write.format(info.provider).options(**info.options)
    (w.partitionBy(*pcols) if pcols else w).save(staged)
    for r in listing(spark, staged, pcols, types).collect():
        folder = root + _rel(r["dir"], staged)
        if pcols:
            spec = partition_spec_sql({c: r[c] for c in pcols})
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec})")
        store.rename(r["path"], f"{folder}/{mark}{r['path'].rsplit('/', 1)[1]}")
    store.delete(staged)
    spark.catalog.refreshTable(table)


def compacting_sink(table: str, marker_dir: str, every: int = 1, min_small_files: int = 8,
                    small_bytes: int = 32 << 20, major: bool = False):
    """``foreachBatch`` callback: append, then compact when the trigger fires."""

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        store = Store(spark, marker_dir)
        done = [n for n in store.names(marker_dir) if n.startswith("epoch-")]
        if any(int(n.removeprefix("epoch-")) >= epoch_id for n in done):  # replayed, finished before
            return
        append_epoch(batch, table, epoch_id)
        store.make_dirs(marker_dir)
        store.touch(f"{marker_dir}/epoch-{epoch_id}")
        for n in done:
            store.delete(f"{marker_dir}/{n}")
        if (epoch_id + 1) % every == 0:
            auto_compact(spark, table, min_small_files=min_small_files,
                         small_bytes=small_bytes, major=major)

    return write_batch


def run_to_completion(stream_df: DataFrame, table: str, checkpoint: str, marker_dir: str,
                      **kw) -> None:
    """Drive a bounded stream (``availableNow``) through the compacting sink."""
    q = (stream_df.writeStream.foreachBatch(compacting_sink(table, marker_dir, **kw))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
