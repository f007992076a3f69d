"""Publishing keeps paths valid, loses no rows and leaves nothing behind."""

import os

import pytest
from pyspark.sql import functions as F

import lakeshard.operators.compact as cp
from lakeshard.operators import layout as lo
from lakeshard.operators import rows as rw
from lakeshard.streaming.compaction_sink import compacting_sink

VALUES = ["10:00", "it's", "b/c", "a b", "p%q", "x+y", None]


def _table(spark, tmp, name, rows, schema, by=(), pieces=4):
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    w = spark.createDataFrame(rows, schema).repartition(pieces).write.option("path", f"{tmp}/{name}")
    (w.partitionBy(*by) if by else w).saveAsTable(name)
    return f"{tmp}/{name}"


def _left_over(path):
    return [n for n in os.listdir(path) if n.startswith(("_compact", "_old", "_rewrite", "_epoch"))] + \
        [n for n in os.listdir(os.path.dirname(path)) if os.path.basename(path) + "." in n]


@pytest.mark.parametrize("by", [(), ("k",)])
def test_path_readers_see_what_table_readers_see(spark, tmpdir_path, by):
    rows = [(i, VALUES[i % len(VALUES)]) for i in range(70)]
    path = _table(spark, tmpdir_path, "safe_p", rows, "id int, k string", by)
    for _ in range(2):
        cp.compact_table(spark, "safe_p", num_files=1 if not by else 7)
        assert sorted(map(tuple, spark.table("safe_p").collect()), key=str) == sorted(rows, key=str)
        assert spark.read.parquet(path).count() == 70
        assert not _left_over(path)
    assert cp.compact_path(spark, path, partition_by=list(by) or None).first().rows == 70
    assert spark.read.parquet(path).count() == 70 and not _left_over(path)


@pytest.mark.parametrize("by", [(), ("k",)])
def test_rows_appended_meanwhile_stay(spark, tmpdir_path, by, monkeypatch):
    path = _table(spark, tmpdir_path, "safe_a", [(i, "a") for i in range(10)], "id int, k string", by)
    real = cp._verify

    def verify(*a, **b):
        real(*a, **b)
        spark.createDataFrame([(100 + i, "a") for i in range(5)], "id int, k string").write.insertInto("safe_a")

    monkeypatch.setattr(cp, "_verify", verify)
    with pytest.raises(cp.CompactionError, match="changed"):
        cp.compact_table(spark, "safe_a", num_files=1)
    spark.catalog.refreshTable("safe_a")
    assert spark.table("safe_a").count() == 15 and not _left_over(path)


def test_files_that_come_in_during_the_swap_are_put_back(spark, tmpdir_path, monkeypatch):
    path = _table(spark, tmpdir_path, "safe_w", [(i, "a") for i in range(10)], "id int, k string", ("k",))
    real = cp._same_files

    def same(*a):
        real(*a)
        spark.createDataFrame([(200, "a")], "id int, k string").write.insertInto("safe_w")

    monkeypatch.setattr(cp, "_same_files", same)
    cp.compact_table(spark, "safe_w", num_files=1)
    spark.catalog.refreshTable("safe_w")
    assert spark.table("safe_w").count() == 11 and spark.read.parquet(path).count() == 11


def test_bucketed_tables_are_refused(spark, tmpdir_path):
    spark.sql("DROP TABLE IF EXISTS safe_b")
    spark.range(50).write.bucketBy(2, "id").option("path", f"{tmpdir_path}/safe_b").saveAsTable("safe_b")
    with pytest.raises(cp.CompactionError, match="bucketed"):
        cp.compact_table(spark, "safe_b")
    assert spark.table("safe_b").join(spark.table("safe_b"), "id").count() == 50


def test_failed_verification_leaves_nothing(spark, tmpdir_path, monkeypatch):
    path = _table(spark, tmpdir_path, "safe_f", [(i, "a") for i in range(10)], "id int, k string", ("k",))
    before = sorted(os.listdir(f"{path}/k=a"))
    monkeypatch.setattr(cp, "fingerprint", lambda df: df.agg(F.lit(0).alias("rows"), F.lit(0).alias("digest")))
    with pytest.raises(cp.CompactionError, match="differs"):
        cp.compact_table(spark, "safe_f", num_files=1)
    assert sorted(os.listdir(f"{path}/k=a")) == before and not _left_over(path)


def test_files_without_rows_count(spark, tmpdir_path):
    spark.sql("DROP TABLE IF EXISTS safe_e")
    spark.sql(f"CREATE TABLE safe_e (id int) USING parquet LOCATION '{tmpdir_path}/safe_e'")
    for _ in range(7):
        spark.createDataFrame([], "id int").coalesce(1).write.insertInto("safe_e")
    files = lo.table_file_report(spark, "safe_e").first()["files"]
    assert files == 7
    lo.auto_compact(spark, "safe_e", min_small_files=4)
    assert lo.table_file_report(spark, "safe_e").first()["files"] == 1 and spark.table("safe_e").count() == 0


@pytest.mark.parametrize("by", [(), ("k",)])
def test_minor_compaction_keeps_large_files(spark, tmpdir_path, by):
    path = _table(spark, tmpdir_path, "safe_m", [(i, "a") for i in range(20000)], "id int, k string", by, pieces=1)
    leaf = f"{path}/k=a" if by else path
    large = [n for n in os.listdir(leaf) if n.endswith(".parquet")]
    for i in range(6):
        spark.createDataFrame([(i, "a")], "id int, k string").coalesce(1).write.insertInto("safe_m")
    lo.auto_compact(spark, "safe_m", min_small_files=4, small_bytes=10_000)
    after = [n for n in os.listdir(leaf) if n.endswith(".parquet")]
    assert set(large) < set(after) and len(after) == 2
    spark.catalog.refreshTable("safe_m")
    assert spark.table("safe_m").count() == 20006 and not _left_over(path)


def test_publish_into_registered_empty_and_dropped_partitions(spark, tmpdir_path):
    path = _table(spark, tmpdir_path, "safe_r", [(1, "a"), (2, "it's")], "id int, k string", ("k",))
    spark.sql("ALTER TABLE safe_r ADD PARTITION (k='10:00')")
    new = spark.createDataFrame([(3, "10:00"), (4, "n/w")], "id int, k string")
    assert rw.publish(spark, "safe_r", new).first()["rows"] == 2
    assert sorted(map(tuple, spark.table("safe_r").collect())) == [(3, "10:00"), (4, "n/w")]
    assert spark.read.parquet(path).count() == 2 and not _left_over(path)
    assert len(spark.sql("SHOW PARTITIONS safe_r").collect()) == 2
    with pytest.raises(rw.MergeError, match="outside"):
        rw.publish(spark, "safe_r", new, F.col("k") == "n/w")
    assert spark.table("safe_r").count() == 2 and not _left_over(path)


def test_insert_only_merge_has_no_cardinality_rule(spark):
    target = spark.createDataFrame([(1, "t"), (2, "t")], "id int, v string")
    source = spark.createDataFrame([(1, "s"), (1, "s2"), (3, "s"), (3, "s2"), (None, "s")], "id int, v string")
    got = rw.merge_rows(target, source, ["id"], [rw.not_matched_insert()])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "t"), (2, "t"), (3, "s"), (3, "s2"), (None, "s")], key=str)
    with pytest.raises(rw.MergeError):
        rw.merge_rows(target, source, ["id"], [rw.matched_update()])


@pytest.mark.parametrize("by", [(), ("k",)])
def test_replayed_epoch_without_marker_writes_once(spark, tmpdir_path, by, monkeypatch):
    import lakeshard.streaming.compaction_sink as sink

    _table(spark, tmpdir_path, "safe_s", [], "id int, k string", by, pieces=1)
    batch = spark.createDataFrame([(i, VALUES[i % 3]) for i in range(10)], "id int, k string")
    write = compacting_sink("safe_s", f"{tmpdir_path}/marks", every=1, min_small_files=2)
    monkeypatch.setattr(sink.Store, "touch", lambda self, path: (_ for _ in ()).throw(RuntimeError("crash")))
    for _ in range(2):
        with pytest.raises(RuntimeError):
            write(batch, 0)
    monkeypatch.undo()
    write(batch, 0)
    write(batch, 0)
    assert spark.table("safe_s").count() == 10
    write(batch, 1)
    assert spark.table("safe_s").count() == 20
    assert [n for n in os.listdir(f"{tmpdir_path}/marks") if not n.startswith(".")] == ["epoch-1"]
