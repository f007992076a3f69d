"""Row-level DELETE, UPDATE and MERGE for plain (non-transactional) tables
(survey B22-B24).

The operators are DataFrame -> DataFrame rewrites; ``publish`` writes the
result through the staged, verified location swap used by compaction.

MERGE plan, chosen to stay skew-safe when one target key holds a large
share of the rows:

    target LEFT OUTER JOIN source  -> matched / not-matched-by-source rows
    source LEFT ANTI JOIN distinct(target keys) -> not-matched rows

A full outer join would put a hot key in one task with no AQE skew
handling; the left outer join can be split by AQE on the target side, and
the anti join only sees one row per distinct target key.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeshard.operators.compact import (_known_names, _read_staged, _rel, _same_files, listing,
                                         partition_spec_sql, recorded, table_info)
from lakeshard.sources.hadoop import Store, Swap


class MergeError(RuntimeError):
    pass


def _true(c: Column | None) -> Column:
    return F.lit(True) if c is None else F.coalesce(c, F.lit(False))


def delete_rows(df: DataFrame, cond: Column) -> DataFrame:
    """Rows for which ``cond`` is not true (rows where it is NULL are kept)."""
    return df.where(~_true(cond))


def update_rows(df: DataFrame, assignments: dict[str, Column], cond: Column | None = None) -> DataFrame:
    """``UPDATE df SET col = expr, ... WHERE cond``; column order and types are kept."""
    unknown = set(assignments) - set(df.columns)
    if unknown:
        raise ValueError(f"unknown columns {sorted(unknown)}")
    hit = _true(cond)
    types = dict(df.dtypes)
    return df.select(*[
        (F.when(hit, assignments[c].cast(types[c])).otherwise(F.col(c)).alias(c)
         if c in assignments else F.col(c)) for c in df.columns])


@dataclass
class When:
    """One MERGE clause.

    kind: ``matched`` | ``not_matched`` | ``not_matched_by_source``
    action: ``update`` | ``delete`` | ``insert``
    set: column -> expression over ``t.<col>`` / ``s.<col>``; ``None`` = ``*``
    """

    kind: str
    action: str
    cond: Column | None = None
    set: dict | None = field(default=None)


def matched_update(set=None, cond=None) -> When:
    return When("matched", "update", cond, set)


def matched_delete(cond=None) -> When:
    return When("matched", "delete", cond)


def not_matched_insert(set=None, cond=None) -> When:
    return When("not_matched", "insert", cond, set)


def not_matched_by_source_update(set, cond=None) -> When:
    return When("not_matched_by_source", "update", cond, set)


def not_matched_by_source_delete(cond=None) -> When:
    return When("not_matched_by_source", "delete", cond)


def merge_rows(target: DataFrame, source: DataFrame, on: list[str], clauses: list[When],
               check_duplicates: bool = True) -> DataFrame:
    """``MERGE INTO target t USING source s ON t.k = s.k ...`` with SQL semantics.

    The first clause of a kind whose condition is true applies; a NULL
    condition does not match.  Expressions refer to ``t.<col>`` and
    ``s.<col>``.  A target row matched by more than one source row raises
    ``MergeError`` (as the SQL standard requires).
    """
    cols = target.columns
    types = dict(target.dtypes)
    t = target.alias("t")
    s = source.alias("s")
    if check_duplicates and any(c.kind == "matched" for c in clauses):
        any_null = F.lit(False)
        for k in on:
            any_null = any_null | F.col(k).isNull()
        dup = (source.where(~any_null)
               .groupBy(*on).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1")
               .join(target.select(*on), on, "left_semi"))
        if dup.limit(1).count():
            raise MergeError("a target row matches more than one source row")

    if not any(c.kind != "not_matched" for c in clauses):  # no target row changes
        return target.unionByName(_inserted(target, source, on, clauses))

    keys = F.lit(True)
    for k in on:
        keys = keys & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    s_flag = s.withColumn("_s_present", F.lit(True)).alias("s")
    joined = t.join(s_flag, keys, "left")
    matched = F.col("s._s_present").isNotNull()

    m_cl = [c for c in clauses if c.kind == "matched"]
    b_cl = [c for c in clauses if c.kind == "not_matched_by_source"]
    i_cl = [c for c in clauses if c.kind == "not_matched"]
    a_m = _first_clause(m_cl, matched)
    a_b = _first_clause(b_cl, ~matched)
    joined = joined.withColumn("_am", a_m).withColumn("_ab", a_b)

    def value(c: str) -> Column:
        v = F.col(f"t.{c}")
        for i, cl in enumerate(m_cl):
            if cl.action == "update":
                e = F.col(f"s.{c}") if cl.set is None else cl.set.get(c)
                if e is not None:
                    v = F.when(F.col("_am") == i, e.cast(types[c])).otherwise(v)
        for i, cl in enumerate(b_cl):
            if cl.action == "update" and cl.set and c in cl.set:
                v = F.when(F.col("_ab") == i, cl.set[c].cast(types[c])).otherwise(v)
        return v.alias(c)

    deleted = F.lit(False)
    for i, cl in enumerate(m_cl):
        if cl.action == "delete":
            deleted = deleted | F.coalesce(F.col("_am") == i, F.lit(False))
    for i, cl in enumerate(b_cl):
        if cl.action == "delete":
            deleted = deleted | F.coalesce(F.col("_ab") == i, F.lit(False))
    kept = joined.where(~deleted).select(*[value(c) for c in cols])

    return kept.unionByName(_inserted(target, source, on, clauses)) if i_cl else kept


def _first_clause(clauses: list[When], base_ok: Column) -> Column:
    """Index of the first clause whose condition holds, else NULL."""
    action = F.lit(None).cast("int")
    for i, c in reversed(list(enumerate(clauses))):
        action = F.when(base_ok & _true(c.cond), F.lit(i)).otherwise(action)
    return action


def _inserted(target: DataFrame, source: DataFrame, on: list[str], clauses: list[When]) -> DataFrame:
    """Source rows that match no target row, as the ``not_matched`` clauses insert them."""
    cols, types, s = target.columns, dict(target.dtypes), source.alias("s")
    i_cl = [c for c in clauses if c.kind == "not_matched"]
    tkeys = target.select(*on).distinct()
    unmatched = s.join(tkeys.alias("k"), [F.col(f"s.{k}") == F.col(f"k.{k}") for k in on], "left_anti")
    a_i = _first_clause(i_cl, F.lit(True))
    unmatched = unmatched.withColumn("_ai", a_i).where(F.col("_ai").isNotNull())
    ins_val = {}
    for c in cols:
        v = F.lit(None).cast(types[c])
        for i, cl in enumerate(i_cl):
            e = F.col(f"s.{c}") if cl.set is None else cl.set.get(c)
            if e is not None:
                v = F.when(F.col("_ai") == i, e.cast(types[c])).otherwise(v)
        ins_val[c] = v.alias(c)
    return unmatched.select(*[ins_val[c] for c in cols])


def publish(spark: SparkSession, table: str, new_rows: DataFrame,
            partitions: Column | None = None) -> DataFrame:
    """Replace rows of catalog ``table`` with ``new_rows``; returns ``(rows)``.

    The new rows are staged once, counted by the write itself and checked
    against the staged files; then staged folders are renamed into the place
    of the live ones, so path readers see what table readers see.  It is given
    up if the table's files changed meanwhile.

    Partitioned: ``partitions`` (a predicate on partition columns, default
    all) names the partitions being replaced, and ``new_rows`` must only hold
    rows of those partitions.  New partitions are added to the catalog,
    replaced ones left without rows are dropped.  Any error restores folders
    and catalog; old files are deleted only at the end.
    """
    info = table_info(spark, table)
    src_schema = spark.table(table).schema
    pcols, root = info.partition_cols, info.location.rstrip("/")
    types = dict(spark.table(table).dtypes)
    new_rows = new_rows.select(*[F.col(c).cast(f.dataType).alias(c) for c, f in
                                 zip(src_schema.names, src_schema.fields)])
    scope = F.lit(True) if partitions is None else F.coalesce(partitions, F.lit(False))
    store, stamp = Store(spark, root), int(time.time() * 1000)
    staged, backup = (f"{root}/_rewrite-{stamp}", f"{root}/_old-{stamp}") if pcols else (f"{root}.rewrite-{stamp}", f"{root}.old-{stamp}")
    swap, undo = Swap(store, backup), []
    # the rewrite is evaluated once: rows, and rows outside its partitions, are observed by the staged write
    seen = Observation()
    watched = new_rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(~scope).alias("outside"))
    files = lambda: listing(spark, root, pcols, types).where(scope)
    before = recorded(files())
    try:
        w = watched.write.format(info.provider).options(**info.options)
        (w.partitionBy(*pcols) if pcols else w).save(staged)
        if seen.get["outside"]:
            raise MergeError("new_rows holds rows outside the partitions being replaced")
        got = _read_staged(spark, info, src_schema, staged).count()
        if seen.get["rows"] != got:
            raise MergeError(f"staged rows {got} != expected {seen.get['rows']}")
        _same_files(before, files())
        if not pcols:
            swap.put(root, staged)
        else:
            # one row per partition on both sides: catalog-sized, not data-sized
            spec = lambda r: partition_spec_sql({c: r[c] for c in pcols})
            fresh = {_rel(r["dir"], staged): r for r in listing(spark, staged, pcols, types).select(*pcols, "dir").distinct().collect()}
            old = {_rel(r["dir"], root): r for r in files().select(*pcols, "dir").distinct().collect()}
            listed = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
            for rel, r in sorted(fresh.items()):
                swap.put(root + rel, r["dir"])
                if rel.strip("/") not in listed:
                    undo.append(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec(r)})")
                    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec(r)})")
            for rel, r in sorted(old.items()):
                if rel not in fresh:
                    swap.put(root + rel, None)
                    undo.append(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec(r)})")
                    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec(r)})")
    except BaseException:
        swap.undo()
        for stmt in reversed(undo):
            spark.sql(stmt)
        store.delete(staged)
        spark.catalog.refreshTable(table)
        raise
    spark.catalog.refreshTable(table)
    swap.finish(_known_names(before))
    store.delete(staged)
    return spark.createDataFrame([(got,)], "rows bigint")
