"""Catalog statements used by the maintenance operators (survey B16, B17, B20, A4.13)."""

import os

import pytest

from lakeshard.sources.files import list_directory, pack_files


def test_truncate_and_like(spark, tmpdir_path):
    spark.sql("DROP TABLE IF EXISTS tr_a")
    spark.sql("CREATE TABLE tr_a (id int, k string) USING parquet PARTITIONED BY (k)")  # managed: TRUNCATE needs it
    spark.sql("INSERT INTO tr_a VALUES (1, 'x'), (2, 'y'), (3, 'y')")
    spark.sql("DROP TABLE IF EXISTS tr_b")
    spark.sql(f"CREATE TABLE tr_b LIKE tr_a LOCATION '{tmpdir_path}/b'")
    assert [c.name for c in spark.catalog.listColumns("tr_b")] == ["id", "k"]
    spark.sql("TRUNCATE TABLE tr_a PARTITION (k = 'y')")
    assert [r.id for r in spark.table("tr_a").collect()] == [1]
    spark.sql("TRUNCATE TABLE tr_a")
    assert spark.table("tr_a").count() == 0


def test_partition_add_rename_drop(spark, tmpdir_path):
    spark.sql("DROP TABLE IF EXISTS pt")
    spark.sql(f"CREATE TABLE pt (id int, k string) USING parquet PARTITIONED BY (k) LOCATION '{tmpdir_path}/pt'")
    spark.sql("INSERT INTO pt VALUES (1, 'x')")
    spark.sql("ALTER TABLE pt ADD PARTITION (k = 'z')")
    spark.sql("ALTER TABLE pt PARTITION (k = 'x') RENAME TO PARTITION (k = 'w')")
    parts = sorted(r[0] for r in spark.sql("SHOW PARTITIONS pt").collect())
    assert parts == ["k=w", "k=z"]
    spark.sql("ALTER TABLE pt DROP PARTITION (k = 'z')")
    assert [r[0] for r in spark.sql("SHOW PARTITIONS pt").collect()] == ["k=w"]
    assert [(r.id, r.k) for r in spark.table("pt").collect()] == [(1, "w")]


def test_pack_files_and_listing(spark, tmpdir_path):
    src = f"{tmpdir_path}/small"
    os.makedirs(f"{src}/sub")
    for i in range(20):
        with open(f"{src}/{'sub/' if i % 2 else ''}f{i}.txt", "w") as f:
            f.write("x" * i)
    packed = pack_files(spark, src, f"{tmpdir_path}/packed", num_files=2)
    with_crc = packed
    packed = packed.where("rel NOT LIKE '%.crc'")
    assert packed.count() == 20 and with_crc.count() >= 20  # the zero-length f0.txt too
    assert sum(r.length for r in packed.collect()) == sum(range(20))
    assert len([f for f in os.listdir(f"{tmpdir_path}/packed") if f.endswith(".parquet")]) == 2
    rels = [r.rel for r in list_directory(spark, src).collect()]
    assert rels == sorted(rels) and "sub/f1.txt" in rels


def test_insert_hints_set_file_count(spark, tmpdir_path):
    from lakeshard.operators.compact import file_stats
    from lakeshard.operators.layout import append_and_compact

    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    li.createOrReplaceTempView("li_hint")
    spark.sql("DROP TABLE IF EXISTS hinted")
    spark.sql(f"CREATE TABLE hinted (l_orderkey BIGINT, l_linenumber INT) USING parquet LOCATION '{tmpdir_path}/h'")
    spark.sql("INSERT INTO hinted SELECT /*+ REPARTITION(3) */ l_orderkey, l_linenumber FROM li_hint")
    assert file_stats(spark.table("hinted")).first()["files"] == 3
    spark.sql("INSERT INTO hinted SELECT /*+ COALESCE(1) */ l_orderkey, l_linenumber FROM li_hint")
    assert file_stats(spark.table("hinted")).first()["files"] == 4
    append_and_compact(li.select("l_orderkey", "l_linenumber").repartition(4), "hinted",
                       min_small_files=2, small_bytes=1 << 30)
    st = file_stats(spark.table("hinted")).first()
    assert st["files"] == 1 and st["rows"] == 3 * li.count()


def test_listing_rel_for_root_spellings(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/r/s")
    with open(f"{tmpdir_path}/r/s/f.txt", "w") as f:
        f.write("x")
    for root in (f"{tmpdir_path}/r", f"file:{tmpdir_path}/r", f"file://{tmpdir_path}/r", f"{tmpdir_path}/r/"):
        assert [r.rel for r in list_directory(spark, root).collect()] == ["s/f.txt"], root


def test_pack_files_lists_once(spark, tmpdir_path, monkeypatch):
    """The number of containers comes from the listing that the rows are read from."""
    from lakeshard.sources import files

    src = f"{tmpdir_path}/many"
    os.makedirs(src)
    for i in range(6):
        with open(f"{src}/f{i}", "w") as f:
            f.write("x" * 100)
    monkeypatch.setattr(files, "list_files", lambda *a: pytest.fail("listed again"))
    packed = pack_files(spark, src, f"{tmpdir_path}/packed-many", target_bytes=200)
    assert packed.count() == 6 and len([f for f in os.listdir(f"{tmpdir_path}/packed-many") if f.endswith(".parquet")]) == 3
