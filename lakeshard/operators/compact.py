"""Small-file compaction of catalog tables, single partitions and paths (survey A3).

Flow of ``compact_table``:

1. file counts and sizes per folder from a listing (files without rows count
   too); one row per table partition comes back to the driver;
2. file count ``n`` per partition: the requested count, or
   ``ceil(bytes / target_bytes)``;
3. staged write of the selected rows into a hidden folder, partition ``p``
   getting exactly ``n_p`` write tasks through
   ``repartitionById(offset_p + salt(row, n_p))`` (one shuffle).  Row count and
   an order-insensitive digest of the source are observed by this very write;
4. verification: the staged files, read once, must give the same count and digest;
5. the list of source files must still be the one recorded at the start,
   else the work is given up and nothing changes;
6. staged folders are renamed into the place of the live ones, so table and
   path readers both see them where they always were.  Any error renames
   everything back;
7. only the files recorded at the start are deleted.  A file that came in
   between the check and the rename is put back beside the new ones.

With ``small_bytes`` only smaller files are merged (minor compaction); larger
ones stay in place under their names.

All storage work goes through Hadoop's file systems, so it works wherever
Spark does.  Bucketed tables are refused: their file names carry meaning.
"""

from __future__ import annotations

import math
import re
import time
from dataclasses import dataclass, field
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeshard.functions.hashing import digest_columns, fingerprint, salt_hash
from lakeshard.sources.files import list_files, qualify
from lakeshard.sources.hadoop import Store, Swap

DEFAULT_TARGET_BYTES = 128 * 1024 * 1024

REPORT_SCHEMA = ("table string, partition string, files_before bigint, files_after bigint, "
                 "bytes_before bigint, bytes_after bigint, rows bigint, COMPACT_TABLE string")


class CompactionError(RuntimeError):
    pass


@dataclass
class TableInfo:
    name: str
    location: str
    provider: str
    partition_cols: list[str]
    data_cols: list[str]
    options: dict = field(default_factory=dict)


def _storage_props(text: str | None) -> dict:
    if not text:
        return {}
    body = text.strip()[1:-1]
    out = {}
    for part in body.split(", "):
        if "=" in part:
            k, v = part.split("=", 1)
            out[k] = v
    return out


def table_info(spark: SparkSession, table: str) -> TableInfo:
    cols = spark.catalog.listColumns(table)
    desc = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if desc.get("Num Buckets", "").strip().isdigit() and int(desc["Num Buckets"]) > 0:
        raise CompactionError(f"{table} is bucketed; its files can't be merged")
    provider = (desc.get("Provider") or "").lower()
    if provider in ("", "hive"):
        raise CompactionError(f"{table}: only data source tables are supported (provider {provider!r})")
    opts = {k: v for k, v in _storage_props(desc.get("Storage Properties")).items()
            if k not in ("path", "serialization.format")}
    return TableInfo(table, desc["Location"], provider,
                     [c.name for c in cols if c.isPartition],
                     [c.name for c in cols if not c.isPartition], opts)


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_spec_sql(spec: dict) -> str:
    return ", ".join(f"`{k}` = {_sql_literal(v)}" for k, v in spec.items())


def partition_predicate(spec: dict):
    cond = F.lit(True)
    for k, v in spec.items():
        cond = cond & (F.col(k).isNull() if v is None else (F.col(k) == F.lit(v)))
    return cond


def file_stats(df: DataFrame, group_cols=()) -> DataFrame:
    """Per group: ``files, bytes, rows`` from the ``_metadata`` of the scanned files.

    Files without rows are invisible here (they contribute no ``_metadata``).
    """
    per_file = (df.select(*group_cols, F.col("_metadata.file_path").alias("_f"),
                          F.col("_metadata.file_size").alias("_s"))
                .groupBy(*group_cols, "_f")
                .agg(F.max("_s").alias("_s"), F.count(F.lit(1)).alias("_r")))
    return per_file.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("files"),
                                             F.sum("_s").alias("bytes"),
                                             F.sum("_r").alias("rows"))


def files_for(bytes_: int, num_files: int | None, target_bytes: int) -> int:
    if num_files is not None:
        return max(1, int(num_files))
    return max(1, math.ceil(bytes_ / max(1, target_bytes)))


def spread(num_files: int, weights: list[int]) -> list[int]:
    """Split ``num_files`` over groups by weight, each at least 1 (largest remainder)."""
    k = len(weights)
    if num_files <= k:
        return [1] * k
    total = sum(weights) or k
    raw = [num_files * (w or 1) / total for w in weights]
    base = [max(1, int(x)) for x in raw]
    rest = num_files - sum(base)
    order = sorted(range(k), key=lambda i: raw[i] - int(raw[i]), reverse=True)
    i = 0
    while rest > 0:
        base[order[i % k]] += 1
        rest -= 1
        i += 1
    while rest < 0:
        j = max(range(k), key=lambda i: base[i])
        if base[j] <= 1:
            break
        base[j] -= 1
        rest += 1
    return base


def _writer(df: DataFrame, info_provider: str, options: dict):
    w = df.write.format(info_provider).option("maxRecordsPerFile", 0)
    for k, v in options.items():
        w = w.option(k, v)
    return w


def observed(df: DataFrame, cols: list[str]) -> tuple[DataFrame, Observation]:
    """``df``, and an observation of its row count and digest that the next write fills."""
    seen = Observation()
    return df.observe(seen, *digest_columns(df, cols)), seen


def _verify(seen: dict, staged: DataFrame, cols: list[str], mode: str = "digest") -> None:
    """``digest``: row count and order-insensitive hash of the staged files;
    ``count``: row counts only (Parquet answers from footers)."""
    if mode == "count":
        n = staged.count()
        if n != seen["rows"]:
            raise CompactionError(f"staged rows {n} != source rows {seen['rows']}")
        return
    b = fingerprint(staged.select(*cols)).first()
    if seen["rows"] != b["rows"] or seen["digest"] != b["digest"]:
        raise CompactionError(f"staged data differs: {seen} vs {b}")


def _read_staged(spark: SparkSession, info: TableInfo, schema, path: str) -> DataFrame:
    return spark.read.format(info.provider).schema(schema).options(**info.options).option("basePath", path).load(path)


def _staged_partitioned_write(spark: SparkSession, sel: DataFrame, pcols: list[str],
                              data_cols: list[str], stats: list, counts: list[int],
                              fmt: str, options: dict, staged_root: str) -> dict:
    """Write ``sel`` partitioned by ``pcols`` with exactly ``counts[i]`` write
    tasks for the partition of ``stats[i]``: one shuffle through
    ``repartitionById(offset_p + salt(row, n_p))``.  The row's hash is taken on
    the scan, before any join, so a retried task repeats it.  The (partition ->
    offset, count) table has one row per partition; Spark broadcasts it if it is
    small.  Returns the row count and digest of ``sel``."""
    offsets, acc = [], 0
    for c in counts:
        offsets.append(acc)
        acc += c
    plan_rows = [tuple(r[c] for c in pcols) + (o, c) for r, o, c in zip(stats, offsets, counts)]
    plan_df = spark.createDataFrame(
        plan_rows, sel.select(*pcols).schema.add("_off", "long").add("_n", "long"))
    hashed, seen = observed(sel.withColumn("_h", salt_hash(data_cols)), sel.columns)
    # eqNullSafe keeps rows of the null partition.
    cond = [hashed[c].eqNullSafe(plan_df[c]) for c in pcols]
    tagged = hashed.join(plan_df, cond, "inner").select(
        *[hashed[c] for c in sel.columns],
        (plan_df["_off"] + F.pmod(hashed["_h"], plan_df["_n"])).cast("int").alias("_pid"))
    (_writer(tagged.repartitionById(acc, "_pid").drop("_pid"), fmt, options)
     .partitionBy(*pcols).save(staged_root))
    return seen.get


def _unescaped(value: Column) -> Column:
    """A partition value from its folder name (``%XX`` stands for a byte)."""
    text = F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    return F.when(value != "__HIVE_DEFAULT_PARTITION__", text)


def listing(spark: SparkSession, root: str, pcols: list[str], types: dict[str, str]) -> DataFrame:
    """Files below ``root`` with their partition values: ``pcols..., dir, path, length, modified``."""
    files = list_files(spark, root)
    folder = F.regexp_replace("path", "/[^/]*$", "")
    values = [_unescaped(F.regexp_extract("rel", f"(?:^|/){re.escape(c)}=([^/]*)/", 1)).cast(types[c]).alias(c) for c in pcols]
    if pcols:
        files = files.where(F.col("rel").contains("="))
    return files.select(*values, folder.alias("dir"), "path", "length", "modified")


def _own(files: DataFrame, root: str, pcols: list[str]) -> DataFrame:
    """Without partition columns, a table's files lie directly below its root."""
    depth = _path_part(root).rstrip("/").count("/") + 1
    return files if pcols else files.where(F.size(F.split(F.regexp_replace("path", r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", ""), "/")) == depth + 1)


def recorded(files: DataFrame) -> dict[str, tuple]:
    """Path to size and time of files; as many rows as a scan of them plans with."""
    return {r["path"]: (r["length"], r["modified"]) for r in files.select("path", "length", "modified").collect()}


def _known_names(files: dict[str, tuple]) -> dict[str, set[str]]:
    out: dict[str, set[str]] = {}
    for p in files:
        folder, name = p.rsplit("/", 1)
        out.setdefault(folder, set()).add(name)
    return out


def _same_files(before: dict[str, tuple], files: DataFrame) -> None:
    now = recorded(files)
    if now != before:
        moved = sorted(set(now.items()) ^ set(before.items()))[:3]
        raise CompactionError(f"files changed while the work was under way: {moved}")


def _rel(path: str, root: str) -> str:
    """The part of ``path`` below ``root``, whatever the spelling of the scheme."""
    return _path_part(path)[len(_path_part(root).rstrip("/")):]


def _path_part(uri: str) -> str:
    return re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "", uri)


def _rewrite(spark: SparkSession, name: str, root: str, src: DataFrame, pcols: list[str], fmt: str, options: dict, *,
             cond: Column | None, num_files: int | None, spread_total: bool, target_bytes: int, verify: str,
             small_bytes: int | None, fail_before_publish: bool, spec_text: str | None, refresh) -> DataFrame:
    """Compact the files of ``src`` below ``root``; returns a report row."""
    root = root.rstrip("/")
    types = dict(src.dtypes)
    files = _own(listing(spark, root, pcols, types), root, pcols)
    sel = src
    if cond is not None:
        files, sel = files.where(cond), sel.where(cond)
    if small_bytes is not None:
        files = files.where(F.col("length") < small_bytes)
        sel = sel.where(F.col("_metadata.file_size") < small_bytes)
    before = recorded(files)
    stats = (files.groupBy(*pcols, "dir").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
             .orderBy(*pcols, "dir").collect())
    if not stats:
        return _report(spark, name, spec_text, 0, 0, 0, 0, 0, "nothing to compact")
    if spread_total and num_files is not None and pcols:
        counts = spread(int(num_files), [r["bytes"] for r in stats])
    else:
        counts = [files_for(r["bytes"], num_files, target_bytes) for r in stats]
    store = Store(spark, root)
    stamp = f"{int(time.time() * 1000)}"
    # beside an unpartitioned table, hidden inside a partitioned one
    staged, backup = (f"{root}/_compact-{stamp}", f"{root}/_old-{stamp}") if pcols else (f"{root}.compact-{stamp}", f"{root}.old-{stamp}")
    swap = Swap(store, backup)
    try:
        if pcols:
            data_cols = [c for c in src.columns if c not in pcols]
            seen = _staged_partitioned_write(spark, sel, pcols, data_cols, stats, counts, fmt, options, staged)
        else:
            watched, seen = observed(sel, sel.columns)
            _writer(watched.repartition(counts[0]), fmt, options).save(staged)
            seen = seen.get
        r = spark.read.format(fmt).schema(src.schema).options(**options)
        _verify(seen, r.option("basePath", staged).load(staged), src.columns, verify)
        if fail_before_publish:
            raise CompactionError("injected failure before publish")
        new = {_rel(r["dir"], staged): r["dir"] for r in listing(spark, staged, [], {}).select("dir").distinct().collect()}
        now = _own(listing(spark, root, pcols, types), root, pcols)
        now = now if cond is None else now.where(cond)
        _same_files(before, now if small_bytes is None else now.where(F.col("length") < small_bytes))
        known = _known_names(before)
        pairs = [(r["dir"], new[_rel(r["dir"], root)]) for r in stats if _rel(r["dir"], root) in new]
        if small_bytes is None:
            for live, fresh in pairs:
                swap.put(live, fresh)
        else:  # the small files give way one by one; the folder and its other files stay
            for live, fresh in pairs:
                for n in sorted(known[live]):
                    swap.put(f"{live}/{n}", None)
                for n in store.names(fresh):
                    if n[0] not in "._":
                        swap.put(f"{live}/{n}", f"{fresh}/{n}")
    except BaseException:
        swap.undo()
        store.delete(staged)
        raise
    refresh()
    swap.finish(known if small_bytes is None else None)
    store.delete(staged)
    after_files = _own(listing(spark, root, pcols, types), root, pcols)
    after = (after_files if cond is None else after_files.where(cond)).agg(F.count("*").alias("files"), F.sum("length").alias("bytes")).first()
    fb, bb = sum(r["files"] for r in stats), sum(r["bytes"] for r in stats)
    return _report(spark, name, spec_text, fb, after["files"], bb, after["bytes"], seen["rows"],
                   f"{name}: {fb} files merged, {after['files']} files ({after['bytes']} bytes) now")


def compact_table(spark: SparkSession, table: str, partition: dict | None = None,
                  num_files: int | None = None, target_bytes: int = DEFAULT_TARGET_BYTES,
                  fail_before_publish: bool = False, verify: str = "digest",
                  where: Column | None = None, small_bytes: int | None = None) -> DataFrame:
    """Rewrite ``table`` (or the partitions matching ``partition`` and
    ``where``) into fewer files.

    ``partition`` is a ``PARTITION (k=v, ...)`` spec; ``where`` is any
    predicate on partition columns (both prune partitions at the scan).  All
    selected partitions are compacted by one staged write.

    ``num_files`` is the file count of an unpartitioned table, of each
    selected partition when ``partition`` or ``where`` is given, or the total
    spread over the partitions by size for a whole partitioned table.
    Without it each partition gets ``ceil(bytes / target_bytes)`` files.

    ``verify`` is ``digest`` (default) or ``count``; see ``_verify``.
    ``small_bytes`` merges only files smaller than that.

    Returns one report row (``REPORT_SCHEMA``).
    """
    if verify not in ("digest", "count"):
        raise ValueError("verify must be 'digest' or 'count'")
    info = table_info(spark, table)
    partition = dict(partition or {})
    unknown = set(partition) - set(info.partition_cols)
    if unknown:
        raise CompactionError(f"{table}: not partition columns: {sorted(unknown)}")
    if (partition or where is not None) and not info.partition_cols:
        raise CompactionError(f"{table} is not partitioned")
    cond = partition_predicate(partition) if partition else None
    if where is not None:
        cond = where if cond is None else cond & where
    return _rewrite(spark, table, info.location, spark.table(table), info.partition_cols, info.provider, info.options,
                    cond=cond, num_files=num_files, spread_total=cond is None, target_bytes=target_bytes, verify=verify,
                    small_bytes=small_bytes, fail_before_publish=fail_before_publish,
                    spec_text=partition_spec_sql(partition) if partition else None,
                    refresh=lambda: spark.catalog.refreshTable(table))


def _report(spark, table, part, fb, fa, bb, ba, rows, msg) -> DataFrame:
    return spark.createDataFrame([(table, part, fb, fa, bb, ba, rows, msg)], REPORT_SCHEMA)


def compact_path(spark: SparkSession, path: str, fmt: str = "parquet",
                 num_files: int | None = None, target_bytes: int = DEFAULT_TARGET_BYTES,
                 options: dict | None = None, fail_before_publish: bool = False,
                 partition_by: list[str] | None = None, where: Column | None = None,
                 small_bytes: int | None = None) -> DataFrame:
    """Compact a path-only table by verified directory swaps.

    ``partition_by`` names the ``k=v`` directory levels; ``where`` may select
    partitions; ``small_bytes`` merges only files smaller than that.  The work
    is that of ``compact_table``; a failure leaves the path as it was.
    """
    options = options or {}
    path = qualify(path, spark)
    pcols = list(partition_by or [])
    src = spark.read.format(fmt).options(**options).option("basePath", path).load(path)
    missing = set(pcols) - set(src.columns)
    if missing:
        raise CompactionError(f"{path}: no partition columns {sorted(missing)}")
    return _rewrite(spark, path, path, src, pcols, fmt, options, cond=where if pcols else None, num_files=num_files,
                    spread_total=False, target_bytes=target_bytes, verify="digest", small_bytes=small_bytes,
                    fail_before_publish=fail_before_publish, spec_text=None, refresh=lambda: None)
