"""Distributed directory copy with a manifest (survey A2).

    walk (tasks list the tree level by level; hidden and empty files too)
      -> manifest (src, dst)           column expressions, no driver list
      -> repartition(max_concurrency)  at most that many copy tasks
      -> mapInPandas(copy)             streams each file, one row per file

Each file is written to ``<dst>.tmp-<stage>-<task>-<attempt>`` and renamed
into place, so a retried or speculative task never leaves a half-written
target.  The result is written once to the manifest path (or the scratch
folder), so later actions read the manifest instead of copying again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshard.functions.provenance import with_provenance
from lakeshard.session import scratch_dir, ship_package
from lakeshard.sources.files import list_files, qualify

MANIFEST_SCHEMA = "src string, dst string, length bigint, status string, error string"
_CHUNK = 8 << 20


#: fixed values: other spellings of a scheme that pyarrow knows
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def _fs_and_path(uri: str):
    """File system and literal path of a URI; names are not decoded."""
    from pyarrow import fs as pafs

    if uri.startswith("file:") or "://" not in uri:
        p = uri
        if p.startswith("file://"):
            p = p[len("file://"):]
        elif p.startswith("file:"):
            p = p[len("file:"):]
        return pafs.LocalFileSystem(), p
    scheme, rest = uri.split("://", 1)
    authority, _, path = rest.partition("/")
    fs, base = pafs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{authority}/")
    return fs, f"{base.rstrip('/')}/{path}"


def _copy_partitions(ignore_failures: bool, overwrite: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        from pyarrow import fs as pafs

        ctx = TaskContext.get()
        tag = f"{ctx.stageId()}-{ctx.partitionId()}-{ctx.attemptNumber()}" if ctx else "0"
        for pdf in batches:
            status, error = [], []
            for src, dst in zip(pdf["src"], pdf["dst"]):
                try:
                    sfs, sp = _fs_and_path(src)
                    dfs, dp = _fs_and_path(dst)
                    info = dfs.get_file_info(dp)
                    if info.type != pafs.FileType.NotFound and not overwrite:
                        # Kept as it is; a retried task also lands here for
                        # files its earlier attempt already placed.
                        status.append("skipped")
                        error.append("target exists")
                        continue
                    parent = dp.rsplit("/", 1)[0]
                    if parent:
                        dfs.create_dir(parent, recursive=True)
                    tmp = f"{dp}.tmp-{tag}"
                    if sfs.equals(dfs):
                        # same filesystem: its own copy (server-side on object stores)
                        sfs.copy_file(sp, tmp)
                    else:
                        with sfs.open_input_stream(sp) as fin, dfs.open_output_stream(tmp) as fout:
                            while True:
                                buf = fin.read(_CHUNK)
                                if not buf:
                                    break
                                fout.write(buf)
                    dfs.move(tmp, dp)
                    status.append("ok")
                    error.append(None)
                except Exception as e:  # noqa: BLE001
                    if not ignore_failures:
                        raise
                    status.append("failed")
                    error.append(f"{type(e).__name__}: {e}")
            yield pdf.assign(status=status, error=error)

    return run


_FOUND = "rel string, is_dir boolean, length bigint"


def _list_level(root: str, recursive: bool):
    """mapInPandas body: entries of each listed folder (``rel``), or of its whole subtree."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as pafs

        fs, base = _fs_and_path(root)
        for pdf in batches:
            for rel in pdf["rel"]:
                found = fs.get_file_info(pafs.FileSelector(base + rel, recursive=recursive, allow_not_found=True))
                for at in range(0, len(found), 10_000):
                    part = [i for i in found[at:at + 10_000] if i.type in (pafs.FileType.Directory, pafs.FileType.File)]
                    yield pd.DataFrame({"rel": [i.path[len(base):] for i in part],
                                        "is_dir": [i.type == pafs.FileType.Directory for i in part],
                                        "length": pd.array([0 if i.type == pafs.FileType.Directory else i.size for i in part], "int64")})

    return run


def walk_tree(spark: SparkSession, root: str, levels: int = 2) -> DataFrame:
    """Every entry below ``root``, hidden and empty ones too: ``rel, is_dir, length``.

    Spark tasks list ``levels`` levels one by one, so wide trees are spread
    over many tasks, and then the subtrees below; a level without folders is
    the last.  The driver lists nothing.
    """
    ship_package(spark)
    root = qualify(root, spark)
    n = spark.sparkContext.defaultParallelism
    found, folders = [], spark.createDataFrame([("",)], "rel string")
    for level in range(levels + 1):
        last = level == levels
        path = scratch_dir(spark, "copy-walk")
        folders.repartition(n).mapInPandas(_list_level(root, last), _FOUND).write.mode("overwrite").parquet(path)
        found.append(spark.read.schema(_FOUND).parquet(path))
        folders = found[-1].where("is_dir").select("rel")
        if not last and folders.isEmpty():
            break
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def read_bytes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """mapInPandas body: add the ``content`` of each file ``path``."""
    for pdf in batches:
        content = []
        for path in pdf["path"]:
            fs, p = _fs_and_path(path)
            with fs.open_input_stream(p) as f:
                content.append(f.read())
        yield pdf.assign(content=content)


def _make_dirs(target_root: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _fs_and_path(target_root)
        for pdf in batches:
            for rel in pdf["rel"]:
                fs.create_dir(base + rel, recursive=True)
            yield pdf

    return run


def copy_manifest(spark: SparkSession, source: str, target: str, include_hidden: bool = True) -> DataFrame:
    """``(src, dst, length)`` of every file below ``source``, empty ones too; relative paths kept."""
    return _manifest(walk_tree(spark, source), qualify(source, spark), qualify(target, spark), include_hidden)


def _manifest(tree: DataFrame, source: str, target: str, include_hidden: bool) -> DataFrame:
    files = tree.where("NOT is_dir")
    if not include_hidden:
        files = files.where(~F.col("rel").rlike("/[._]"))
    return files.select(F.concat(F.lit(source), "rel").alias("src"), F.concat(F.lit(target), "rel").alias("dst"), "length")


def dist_copy(spark: SparkSession, source: str, target: str, ignore_failures: bool = False,
              max_concurrency: int = 1, overwrite: bool = True, copy_dirs: bool = True,
              manifest_path: str | None = None, extra_files: DataFrame | None = None,
              include_hidden: bool = True) -> DataFrame:
    """Copy every file below ``source`` to the same relative path below ``target``.

    Returns the manifest ``(src, dst, length, status, error, run_user,
    spark_version)`` read back from where it was written, a row for every
    file.  Empty and hidden files are files like any other;
    ``include_hidden=False`` leaves out names starting with ``.`` or ``_``.
    With ``ignore_failures=False`` a failed file fails the job; otherwise it
    is a ``failed`` row.  With ``overwrite=False`` existing targets are left
    alone (status ``skipped``).  ``copy_dirs`` also re-creates empty
    directories.  ``extra_files`` adds ``(src, dst, length)`` rows.
    """
    if max_concurrency < 1:
        raise ValueError("max_concurrency must be >= 1")
    tree = walk_tree(spark, source)
    src, tgt = qualify(source, spark), qualify(target, spark)
    if copy_dirs:
        dirs = tree.where("is_dir").select("rel").union(spark.createDataFrame([("",)], "rel string"))
        (dirs.repartition(spark.sparkContext.defaultParallelism).mapInPandas(_make_dirs(tgt), "rel string")
         .write.format("noop").mode("overwrite").save())
    man = _manifest(tree, src, tgt, include_hidden)
    if extra_files is not None:
        man = man.unionByName(extra_files.select("src", "dst", "length"))
    # sorted by size first, round robin deals files of like size to all tasks
    done = (man.sort(F.desc("length"), "src").repartition(max_concurrency)
            .mapInPandas(_copy_partitions(ignore_failures, overwrite), MANIFEST_SCHEMA))
    out = manifest_path or scratch_dir(spark, "copy-manifest")
    with_provenance(done).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def tree_equal(spark: SparkSession, a: str, b: str) -> DataFrame:
    """Files that differ between two trees: ``(rel, length_a, length_b)``.

    Compares relative names and sizes with a full outer join on ``rel``.
    """
    la = list_files(spark, a).select("rel", F.col("length").alias("length_a"))
    lb = list_files(spark, b).select("rel", F.col("length").alias("length_b"))
    return (la.join(lb, "rel", "full")
            .where(~F.col("length_a").eqNullSafe(F.col("length_b"))))
