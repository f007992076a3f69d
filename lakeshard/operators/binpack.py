"""Compaction by bin packing: small files are merged without a shuffle.

1. The files to merge are chosen by size tiers: files below ``small_bytes``
   whose tier (a power of ``fan``) holds at least ``min_files`` of them, so a
   row is rewritten once a tier and not with every merge.
2. Each partition's files are packed into bins of ``target_bytes`` by first
   fit, largest first.  Packing runs in groups of at most ``GROUP`` files.
3. Each bin is scanned by one task, which writes one file: a union of
   single-task scans without an Exchange, in batches, so that neither the
   plan nor the driver's list of paths grows with the table.
4. Row counts and digests of the staged files must equal those of the bins.
5. The recorded state of the chosen files is a table; it must still be the
   state of the table's folder (an anti join), else nothing changes.
6. Tasks move the old files aside and the new ones in, from a stored table of
   moves that is undone in reverse order on any error.

Files that are not chosen, large ones among them, keep their names and times.
A file alone in its bin is left alone too.
"""

from __future__ import annotations

import bisect
import contextlib
import time
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from lakeshard.functions.hashing import fingerprint
from lakeshard.operators.compact import (DEFAULT_TARGET_BYTES, CompactionError, TableInfo, _own, _report, listing, observed,
                                         table_info)
from lakeshard.operators.copy import _fs_and_path
from lakeshard.session import scratch_dir, ship_package
from lakeshard.sources.hadoop import Store

#: files that one group of the packing step holds at most, about
GROUP = 10_000
#: bins that one job writes
BATCH = 128


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def due_files(files: DataFrame, by: list[str], small_bytes: int, fan: int = 4, min_files: int = 4) -> DataFrame:
    """The rows of ``files`` (``length``) below ``small_bytes`` whose partition and size tier hold ``min_files`` or more.

    Tier ``i`` reaches from ``small_bytes / fan^(i + 1)`` to ``small_bytes / fan^i``.
    """
    tier = F.floor(F.log(float(fan), F.lit(float(small_bytes)) / F.greatest("length", F.lit(1)))).cast("int")
    small = files.where(F.col("length") < small_bytes).withColumn("_tier", tier)
    keys = [*by, "_tier"]
    full = small.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= min_files).drop("_n")
    same = [small[k].eqNullSafe(full[k]) for k in keys]
    return small.join(full, same, "left_semi").drop("_tier")


def first_fit(sizes: list[int], target: int) -> list[int]:
    """Bin of each size; sizes come largest first, a bin holds ``target`` at most unless one size alone is above it."""
    room: list[tuple[int, int]] = []  # room left and bin, ascending: the fullest bin that fits is taken
    out = []
    for s in sizes:
        at = bisect.bisect_left(room, (s, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = max(target, s), len(out) and max(out) + 1
        out.append(b)
        bisect.insort(room, (left - s, b))
    return out


def packed(files: DataFrame, by: list[str], target_bytes: int, group: int = GROUP) -> DataFrame:
    """``by..., paths, bytes, bin``: bins of two or more files of one partition."""
    names = {c: f"_by{i}" for i, c in enumerate(by)}
    counts = files.groupBy(*[F.col(c).alias(n) for c, n in names.items()]).agg(F.ceil(F.count("*") / group).alias("_groups"))
    cond = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    joined = files.join(counts, cond) if by else files.withColumn("_groups", counts.select("_groups").scalar())
    dealt = joined.select(*by, "path", "length", F.pmod(F.xxhash64("path"), "_groups").alias("_group"))
    schema = StructType(dealt.select(*by).schema.fields).add("paths", ArrayType(StringType())).add("bytes", LongType())

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "path"], ascending=[False, True])
        pdf["_bin"] = first_fit(pdf["length"].tolist(), target_bytes)
        out = pdf.groupby("_bin", sort=True).agg(paths=("path", list), bytes=("length", "sum"))
        out = out[out["paths"].map(len) > 1]
        first = pdf.iloc[0]
        return pd.DataFrame({**{c: [first[c]] * len(out) for c in by}, "paths": out["paths"].tolist(), "bytes": out["bytes"].tolist()})[[*by, "paths", "bytes"]]

    done = dealt.groupBy(*by, "_group").applyInPandas(pack, schema)
    return done.withColumn("bin", F.monotonically_increasing_id())


def batches(bins: DataFrame, size: int = BATCH) -> Iterator[list]:
    """Rows of ``bins``, ``size`` at a time; the driver holds one batch."""
    out = []
    for r in bins.toLocalIterator():
        out.append(r)
        if len(out) == size:
            yield out
            out = []
    if out:
        yield out


def scan_bins(spark: SparkSession, info: TableInfo, schema: StructType, rows: list) -> DataFrame:
    """The rows of some bins; each bin is one task."""
    data = StructType([f for f in schema if f.name not in info.partition_cols])
    out = None
    for r in rows:
        part = spark.read.format(info.provider).schema(data).options(**info.options).load(list(r["paths"])).coalesce(1)
        for c in info.partition_cols:
            part = part.withColumn(c, F.lit(r[c]).cast(schema[c].dataType))
        part = part.select(*schema.names)
        out = part if out is None else out.unionAll(part)
    return out


@contextlib.contextmanager
def tasks_apart(spark: SparkSession):
    """Unions keep the tasks of their parts; else single-task parts are run as one task."""
    name = "spark.sql.unionOutputPartitioning"
    was = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.unset(name) if was is None else spark.conf.set(name, was)


# -- moves ---------------------------------------------------------------------

def move_files(moves: DataFrame) -> None:
    """Rename ``src`` to ``dst`` in tasks.  A move that was made already is left alone, so a repeated task does no harm."""
    ship_package(moves.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as pafs

        for pdf in batches:
            for src, dst in zip(pdf["src"], pdf["dst"], strict=True):
                fs, old = _fs_and_path(src)
                _, new = _fs_and_path(dst)
                there, made = (i.type != pafs.FileType.NotFound for i in fs.get_file_info([old, new]))
                if there and made:
                    raise FileExistsError(f"cannot rename {src}: {dst} exists")
                if there:
                    fs.create_dir(new.rsplit("/", 1)[0], recursive=True)
                    fs.move(old, new)
                elif not made:
                    raise FileNotFoundError(src)
            yield pdf[["src"]]

    n = moves.sparkSession.sparkContext.defaultParallelism
    (moves.select("src", "dst").repartition(n, "src").mapInPandas(run, "src string")
     .write.format("noop").mode("overwrite").save())


def undo_moves(moves: DataFrame) -> None:
    """Take back what ``move_files`` has done, as far as it came."""
    ship_package(moves.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as pafs

        for pdf in batches:
            for src, dst in zip(pdf["src"], pdf["dst"], strict=True):
                fs, old = _fs_and_path(src)
                _, new = _fs_and_path(dst)
                there, made = (i.type != pafs.FileType.NotFound for i in fs.get_file_info([old, new]))
                if made and not there:
                    fs.move(new, old)
            yield pdf[["src"]]

    moves.select("src", "dst").mapInPandas(run, "src string").write.format("noop").mode("overwrite").save()


def same_state(recorded: DataFrame, now: DataFrame) -> None:
    """Every recorded file (``path, length, modified``) must still be there as it was."""
    gone = recorded.select("path", "length", "modified").join(now.select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")
    lost = [r["path"] for r in gone.limit(3).collect()]
    if lost:
        raise CompactionError(f"files changed while the work was under way: {lost}")


def swap_files(spark: SparkSession, root: str, recorded: DataFrame, staged: str, pcols: list[str], check) -> None:
    """The staged files take the place of the recorded ones; ``check()`` runs before the first move.

    Readers between the two moves miss rows; on any error all moves are undone.
    """
    store, stamp = Store(spark, root), f"{int(time.time() * 1000)}-{uuid.uuid4().hex[:6]}"
    backup = f"{root}/_old-{stamp}"
    place = lambda base: F.concat(F.lit(base), F.substring("path", F.lit(len(root) + 1), F.lit(1 << 30)))
    old = _stored(recorded.select(F.col("path").alias("src"), place(backup).alias("dst")), "moves-old")
    fresh = listing(spark, staged, [], {}).select("path")
    new = _stored(fresh.select(F.col("path").alias("src"), F.concat(F.lit(root), F.substring("path", F.lit(len(staged) + 1), F.lit(1 << 30))).alias("dst")), "moves-new")
    check()
    try:
        move_files(old)
        move_files(new)
    except BaseException:
        undo_moves(new)
        undo_moves(old)
        store.delete(backup)
        raise
    store.delete(backup)


def compact_bins(spark: SparkSession, table: str, target_bytes: int = DEFAULT_TARGET_BYTES, small_bytes: int | None = None,
                 min_files: int = 4, fan: int = 4, where: Column | None = None, verify: str = "digest", batch: int = BATCH,
                 fail_before_publish: bool = False) -> DataFrame:
    """Merge the small files of ``table`` (of the partitions ``where`` selects) by bin packing; returns a report row.

    ``small_bytes`` (default: ``target_bytes``) and the tiers choose the
    files; ``verify`` is ``digest`` or ``count``.
    """
    info = table_info(spark, table)
    schema, pcols = spark.table(table).schema, info.partition_cols
    store = Store(spark, info.location)
    root = store.qualified(info.location).rstrip("/")
    types = {f.name: f.dataType.simpleString() for f in schema}

    def live() -> DataFrame:
        files = _own(listing(spark, root, pcols, types), root, pcols)
        return files if where is None else files.where(where)

    files = _stored(live(), "file-state")
    bins = _stored(packed(due_files(files, pcols, small_bytes or target_bytes, fan, min_files), pcols, target_bytes), "bins")
    chosen = bins.select(F.explode("paths").alias("path"))
    recorded = _stored(files.join(chosen, "path", "left_semi"), "file-state-chosen")
    total = files.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("b")).first()
    if recorded.isEmpty():
        return _report(spark, table, None, total["n"], total["n"], total["b"], total["b"], 0, "nothing to compact")
    staged = f"{root}/_bins-{int(time.time() * 1000)}"
    rows, digest = 0, 0
    try:
        for some in batches(bins, batch):
            watched, seen = observed(scan_bins(spark, info, schema, some), schema.names)
            w = watched.write.format(info.provider).options(**info.options).option("maxRecordsPerFile", 0).mode("append")
            with tasks_apart(spark):
                (w.partitionBy(*pcols) if pcols else w).save(staged)
            rows, digest = rows + seen.get["rows"], digest + seen.get["digest"]
        made = spark.read.format(info.provider).schema(schema).options(**info.options).option("basePath", staged).load(staged)
        if verify == "count":
            got = (made.count(), digest)
        else:
            got = tuple(fingerprint(made, schema.names).first())
        if got != (rows, digest):
            raise CompactionError(f"staged data differs: {got} vs {(rows, digest)}")
        if fail_before_publish:
            raise CompactionError("injected failure before publish")
        swap_files(spark, root, recorded, staged, pcols, lambda: same_state(recorded, live()))
    finally:
        store.delete(staged)
        spark.catalog.refreshTable(table)
    after = live().agg(F.count("*").alias("n"), F.sum("length").alias("b")).first()
    return _report(spark, table, None, total["n"], after["n"], total["b"], after["b"], rows,
                   f"{table}: {total['n']} files, {after['n']} now")
