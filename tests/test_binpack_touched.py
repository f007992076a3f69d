import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from lakeshard.operators import binpack, touched
from lakeshard.operators import rows as rw
from lakeshard.operators.compact import CompactionError
from sf_dir import SF


def _table(spark, df, pieces=20, partition_by=None):
    from lakeshard.session import scratch_dir

    name = f"bp_{uuid.uuid4().hex[:10]}"
    w = df.repartition(pieces).write.format("parquet").option("path", scratch_dir(spark, name) + "/data")
    (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)
    return name


def _files(spark, table):
    """Path to size and time of a table's files, straight from the disk."""
    root = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()[1].removeprefix("file:")
    out = {}
    for folder, dirs, names in os.walk(root):
        dirs[:] = [d for d in dirs if d[0] not in "._"]
        for n in names:
            if n[0] not in "._":
                s = os.stat(f"{folder}/{n}")
                out[f"{folder}/{n}"[len(root):]] = (s.st_size, s.st_mtime_ns)
    return out, root


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_first_fit_packs_within_bounds():
    rng = random.Random(3)
    for _ in range(50):
        sizes = sorted((rng.randint(1, 120) for _ in range(rng.randint(0, 60))), reverse=True)
        got = binpack.first_fit(sizes, 100)
        load = {}
        for s, b in zip(sizes, got, strict=True):
            load.setdefault(b, []).append(s)
        assert all(sum(x) <= 100 or len(x) == 1 for x in load.values())
        assert sorted(load) == list(range(len(load)))
        assert len(load) <= 2 * max(1, -(-sum(sizes) // 100)) + sum(s > 50 for s in sizes)


def test_tiers_choose_files_of_like_size(spark):
    files = spark.createDataFrame([("a", f"p{i}", n) for i, n in enumerate([10] * 5 + [300] * 3 + [900] * 4 + [2000] * 9)] + [("b", "q", 10), (None, "r", 0)],
                                  "k string, path string, length long")
    got = {r["path"] for r in binpack.due_files(files, ["k"], 1000, fan=4, min_files=4).collect()}
    assert got == {f"p{i}" for i in [0, 1, 2, 3, 4, 8, 9, 10, 11]} | {f"p{i}" for i in (5, 6, 7)}  # 300 and 900 share the first tier


def test_compact_without_a_shuffle(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    t = _table(spark, orders, 24)
    before, _ = _files(spark, t)
    size = sum(n for n, _ in before.values())
    want = _rows(spark.table(t))
    target = size // 4 + 1
    bins = len(set(binpack.first_fit(sorted((n for n, _ in before.values()), reverse=True), target)))
    report = binpack.compact_bins(spark, t, target_bytes=target, batch=2).first()
    after, root = _files(spark, t)
    assert _rows(spark.table(t)) == want
    assert report["files_before"] == 24 and report["files_after"] == len(after) == bins > 2
    assert report["rows"] == len(want) and not set(after) & set(before)
    assert not [n for n in os.listdir(root) if n.startswith("_") and n != "_SUCCESS"]


def test_the_data_plan_has_no_exchange(spark):
    t = _table(spark, spark.read.parquet(f"{SF}/orders.parquet"), 8, ["o_orderstatus"])
    info = binpack.table_info(spark, t)
    files = binpack.listing(spark, info.location, info.partition_cols, dict(spark.table(t).dtypes))
    bins = binpack.packed(files, info.partition_cols, 1 << 30).collect()
    df = binpack.scan_bins(spark, info, spark.table(t).schema, bins)
    with binpack.tasks_apart(spark):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.rdd.getNumPartitions() == len(bins) == 3
    assert _rows(df) == _rows(spark.table(t))


def test_compact_partitions_and_leave_large_files(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    odd = orders.withColumn("k", F.when(F.col("o_orderkey") % 3 == 0, None).when(F.col("o_orderkey") % 3 == 1, "a b%/ü").otherwise("x"))
    t = _table(spark, odd.where("o_orderkey % 5 <> 0"), 1, ["k"])
    large, _ = _files(spark, t)
    odd.where("o_orderkey % 5 = 0").repartition(6).write.insertInto(t)
    want = _rows(spark.table(t))
    limit = min(n for n, _ in large.values())
    binpack.compact_bins(spark, t, target_bytes=1 << 30, small_bytes=limit, min_files=2, fan=1000)
    after, _ = _files(spark, t)
    assert {p: after[p] for p in large} == large  # names, sizes and times
    assert len(after) == 6 and _rows(spark.table(t)) == want
    assert _rows(spark.read.parquet(_files(spark, t)[1]).select(*spark.table(t).columns)) == want


def test_failures_leave_the_table_as_it_was(spark, monkeypatch):
    t = _table(spark, spark.read.parquet(f"{SF}/orders.parquet"), 6)
    before, root = _files(spark, t)
    with pytest.raises(CompactionError, match="injected"):
        binpack.compact_bins(spark, t, fail_before_publish=True)
    assert _files(spark, t)[0] == before
    real = binpack.move_files

    def broken(moves):  # the new files can't be moved in
        if moves.where("src LIKE '%/_bins-%'").isEmpty():
            return real(moves)
        raise OSError("store went away")

    monkeypatch.setattr(binpack, "move_files", broken)
    with pytest.raises(OSError, match="went away"):
        binpack.compact_bins(spark, t)
    assert _files(spark, t)[0] == before and os.listdir(root) == [n for n in os.listdir(root) if not n.startswith("_old")]


def test_a_file_that_changes_meanwhile_stops_the_swap(spark, monkeypatch):
    t = _table(spark, spark.read.parquet(f"{SF}/orders.parquet"), 6)
    before, root = _files(spark, t)
    real = binpack.same_state

    def late(recorded, now):
        first = sorted(before)[0]
        os.utime(root + first, (1, 1))
        real(recorded, now)

    monkeypatch.setattr(binpack, "same_state", late)
    with pytest.raises(CompactionError, match="files changed"):
        binpack.compact_bins(spark, t)
    assert set(_files(spark, t)[0]) == set(before)


def test_nothing_to_compact(spark):
    t = _table(spark, spark.read.parquet(f"{SF}/orders.parquet"), 1)
    before, _ = _files(spark, t)
    assert binpack.compact_bins(spark, t).first()["COMPACT_TABLE"] == "nothing to compact"
    assert _files(spark, t)[0] == before


# -- rows ----------------------------------------------------------------------

def _ranged(spark, partition_by=None):
    """Orders in ten files with disjoint keys."""
    from lakeshard.session import scratch_dir

    name = f"tf_{uuid.uuid4().hex[:10]}"
    w = (spark.read.parquet(f"{SF}/orders.parquet").repartitionByRange(10, "o_orderkey").write.format("parquet")
         .option("path", scratch_dir(spark, name) + "/data"))
    (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)
    return name


@pytest.mark.parametrize("by", [None, ["o_orderstatus"]])
def test_delete_rewrites_only_files_with_a_hit(spark, by):
    t = _ranged(spark, by)
    low = spark.table(t).agg(F.min("o_orderkey")).first()[0]
    cond = (F.col("o_orderkey") < low + 60) & (F.col("o_orderstatus") != "P")
    want = _rows(rw.delete_rows(spark.table(t), cond))
    before, _ = _files(spark, t)
    got = touched.delete_from(spark, t, cond).first()
    after, _ = _files(spark, t)
    assert _rows(spark.table(t)) == want
    kept = {p: s for p, s in before.items() if p in after}
    assert len(kept) == got["untouched"] == len(before) - got["files"] and 0 < got["files"] <= 2
    assert all(after[p] == s for p, s in kept.items())


def test_delete_without_a_hit_changes_nothing(spark):
    t = _ranged(spark)
    before, _ = _files(spark, t)
    assert tuple(touched.delete_from(spark, t, F.col("o_orderkey") < -1).first()) == (0, 10)
    assert _files(spark, t)[0] == before


def test_update_may_move_rows_to_new_partitions(spark):
    t = _ranged(spark, ["o_orderstatus"])
    low = spark.table(t).agg(F.min("o_orderkey")).first()[0]
    cond = F.col("o_orderkey") < low + 30
    change = {"o_orderstatus": F.lit("new"), "o_totalprice": F.col("o_totalprice") * 2}
    want = _rows(rw.update_rows(spark.table(t), change, cond))
    got = touched.update_table(spark, t, change, cond).first()
    assert _rows(spark.table(t)) == want and got["untouched"] > got["files"]


def test_merge_rewrites_matched_files_and_appends_the_rest(spark):
    t = _ranged(spark)
    hi = spark.table(t).agg(F.max("o_orderkey")).first()[0]
    source = spark.table(t).where(F.col("o_orderkey") > hi - 40).withColumn("o_totalprice", F.lit(1.5))
    source = source.unionAll(source.withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000))
    clauses = [rw.matched_delete(F.col("s.o_orderstatus") == "F"), rw.matched_update(), rw.not_matched_insert()]
    want = _rows(rw.merge_rows(spark.table(t), source, ["o_orderkey"], clauses))
    before, _ = _files(spark, t)
    got = touched.merge_into(spark, t, source, ["o_orderkey"], clauses).first()
    after, _ = _files(spark, t)
    assert _rows(spark.table(t)) == want and got["untouched"] >= 8
    assert sum(after.get(p) == s for p, s in before.items()) == got["untouched"]


def test_merge_by_source_and_duplicates(spark):
    t = _ranged(spark)
    source = spark.table(t).where("o_orderkey % 2 = 0").select("o_orderkey")
    clauses = [rw.not_matched_by_source_update({"o_orderpriority": F.lit("none")})]
    want = _rows(rw.merge_rows(spark.table(t), source, ["o_orderkey"], clauses))
    touched.merge_into(spark, t, source, ["o_orderkey"], clauses)
    assert _rows(spark.table(t)) == want
    with pytest.raises(rw.MergeError):
        touched.merge_into(spark, t, source.unionAll(source), ["o_orderkey"], [rw.matched_delete()])
    assert _rows(spark.table(t)) == want
