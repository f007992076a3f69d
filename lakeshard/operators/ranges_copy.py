"""Copy of large files by byte ranges (survey A2.6).

    manifest -> ranges (src, dst, part, offset, size)   one row a range
      -> tasks copy a range each into ``<dst>.parts-<run>/<part>`` and digest it
      -> ranges of a file, in order, are joined into the target
      -> tasks read the target's ranges again and compare digests

A range that is there with its length and digest is not copied again, so a
task that is repeated after a lost executor copies the one range that it was
working on, and a run that broke off goes on where it was (``run`` names it).
Local and mounted stores take each range at its place in one file; on others a
task a file joins the parts in order, which reads and writes them once more.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshard.functions.provenance import with_provenance
from lakeshard.operators.copy import _fs_and_path, copy_manifest
from lakeshard.session import scratch_dir, ship_package

RANGE_BYTES = 256 << 20
_CHUNK = 4 << 20
_DONE = "src string, dst string, length bigint, part int, offset bigint, size bigint, sha256 string, copied boolean"


def byte_ranges(manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``src, dst, length, part, offset, size``: the byte ranges of each file; an empty file has one."""
    parts = F.greatest(F.ceil(F.col("length") / range_bytes), F.lit(1)).cast("int")
    offset = F.col("part").cast("long") * range_bytes
    return (manifest.select("src", "dst", "length", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
            .withColumn("offset", offset).withColumn("size", F.least(F.lit(range_bytes), F.col("length") - offset)))


def _digest(fs, path: str, offset: int, size: int, out=None) -> str:
    """SHA-256 of a range; ``out`` takes a copy of it."""
    h, left = hashlib.sha256(), size
    with fs.open_input_file(path) as f:
        f.seek(offset)
        while left > 0:
            buf = f.read(min(_CHUNK, left))
            if not len(buf):
                raise EOFError(f"{path} ends {left} bytes early")
            h.update(buf)
            left -= len(buf)
            if out is not None:
                out.write(buf)
    return h.hexdigest()


def _write_range(run: str, src: str, dst: str, part: int, offset: int, size: int, length: int, tag: str) -> tuple[str, bool]:
    """Copy one range unless it is there; its digest, and whether it was copied."""
    from pyarrow import fs as pafs

    sfs, sp = _fs_and_path(src)
    dfs, dp = _fs_and_path(dst)
    folder = f"{dp}.parts-{run}"
    name = f"{folder}/{part:08d}"
    found = dfs.get_file_info(f"{name}.sha256")
    if found.type != pafs.FileType.NotFound:
        with dfs.open_input_stream(f"{name}.sha256") as f:
            return f.read().decode(), False
    dfs.create_dir(folder, recursive=True)
    if isinstance(dfs, pafs.LocalFileSystem):  # at its place in one file; ranges do not meet
        import os

        fd = os.open(f"{folder}/whole", os.O_RDWR | os.O_CREAT, 0o644)
        with os.fdopen(fd, "r+b", buffering=0) as out:
            out.seek(offset)
            digest = _digest(sfs, sp, offset, size, out)
    else:
        with dfs.open_output_stream(f"{name}.{tag}") as out:
            digest = _digest(sfs, sp, offset, size, out)
        dfs.move(f"{name}.{tag}", name)
    with dfs.open_output_stream(f"{name}.sha256-{tag}") as f:
        f.write(digest.encode())
    dfs.move(f"{name}.sha256-{tag}", f"{name}.sha256")
    return digest, True


def copy_ranges(ranges: DataFrame, run: str, max_concurrency: int) -> DataFrame:
    """Copy every range; the rows of ``ranges`` with ``sha256`` and ``copied``, stored."""
    spark = ranges.sparkSession
    ship_package(spark)

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        ctx = TaskContext.get()
        tag = f"{ctx.stageId()}-{ctx.partitionId()}-{ctx.attemptNumber()}"
        for pdf in batches:
            got = [_write_range(run, r.src, r.dst, r.part, r.offset, r.size, r.length, tag) for r in pdf.itertuples()]
            yield pdf.assign(sha256=[g[0] for g in got], copied=[g[1] for g in got])

    path = scratch_dir(spark, "copy-ranges")
    # ranges of one file go to different tasks
    (ranges.repartition(max_concurrency, F.xxhash64("dst", "part")).mapInPandas(copy, _DONE)
     .write.mode("overwrite").parquet(path))
    return spark.read.schema(_DONE).parquet(path)


def _join_parts(run: str, dst: str, length: int) -> None:
    """The parts of a file become the file; nothing happens if that was done."""
    from pyarrow import fs as pafs

    fs, path = _fs_and_path(dst)
    folder = f"{path}.parts-{run}"
    if fs.get_file_info(folder).type == pafs.FileType.NotFound:
        return
    if isinstance(fs, pafs.LocalFileSystem):
        import os

        if os.path.exists(f"{folder}/whole"):
            os.truncate(f"{folder}/whole", length)
            os.replace(f"{folder}/whole", path)
    else:
        names = sorted(i.path for i in fs.get_file_info(pafs.FileSelector(folder)) if "." not in i.base_name)
        with fs.open_output_stream(f"{folder}/whole") as out:
            for n in names:
                with fs.open_input_stream(n) as f:
                    while buf := f.read(_CHUNK):
                        out.write(buf)
        fs.move(f"{folder}/whole", path)
    fs.delete_dir(folder)


def stitch(done: DataFrame, run: str) -> None:
    """Join the ranges of each file in order, one task a file."""

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dst, length in zip(pdf["dst"], pdf["length"], strict=True):
                _join_parts(run, dst, length)
            yield pdf[["dst"]]

    files = done.select("dst", "length").distinct()
    n = done.sparkSession.sparkContext.defaultParallelism
    files.repartition(n, "dst").mapInPandas(join, "dst string").write.format("noop").mode("overwrite").save()


def checked(done: DataFrame, max_concurrency: int) -> DataFrame:
    """``done`` with ``ok``: whether the target's range has the digest of what was copied."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = []
            for r in pdf.itertuples():
                fs, path = _fs_and_path(r.dst)
                ok.append(_digest(fs, path, r.offset, r.size) == r.sha256)
            yield pdf.assign(ok=ok)

    return done.repartition(max_concurrency, F.xxhash64("dst", "part")).mapInPandas(check, _DONE + ", ok boolean")


def split_copy(spark: SparkSession, source: str, target: str, range_bytes: int = RANGE_BYTES, max_concurrency: int = 8,
               run: str | None = None, verify: bool = True) -> DataFrame:
    """Copy the files below ``source`` to the same relative paths below ``target``, large ones by many tasks.

    Returns ``(src, dst, length, ranges, copied, status, run_user,
    spark_version)``, a row a file; ``copied`` counts the ranges that this run
    copied itself, ``status`` is ``ok`` or ``differs``.  A target that exists
    is replaced.
    """
    if max_concurrency < 1 or range_bytes < 1:
        raise ValueError("max_concurrency and range_bytes must be >= 1")
    run = run or uuid.uuid4().hex[:12]
    ranges = byte_ranges(copy_manifest(spark, source, target), range_bytes)
    done = copy_ranges(ranges, run, max_concurrency)
    stitch(done, run)
    good = checked(done, max_concurrency) if verify else done.withColumn("ok", F.lit(True))
    files = good.groupBy("src", "dst", "length").agg(
        F.count("*").alias("ranges"), F.count_if("copied").alias("copied"),
        F.when(F.bool_and("ok"), "ok").otherwise("differs").alias("status"))
    out = scratch_dir(spark, "copy-manifest")
    with_provenance(files).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)
