"""Compaction: file counts, content kept, partitions untouched, rollback."""

import pytest
from pyspark.sql import functions as F

from lakeshard.functions.hashing import fingerprint
from lakeshard.operators.compact import CompactionError, compact_path, compact_table, file_stats, spread
from lakeshard.operators.layout import auto_compact, compact_history, small_file_report

# The rows of the reference's manual compaction session.
ROWS = [(1, "a", 10), (2, "a", 20), (3, "a", 30), (4, "a", 10),
        (5, "a", 20), (6, "a", 30), (7, "a", 10), (8, "a", 20)]


def _make(spark, tmp, name, partitioned, fmt="parquet", extra=""):
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    part = "PARTITIONED BY (age)" if partitioned else ""
    spark.sql(f"CREATE TABLE {name} (id int, name string, age int) USING {fmt} {part} "
              f"LOCATION '{tmp}/{name}' {extra}")
    for r in ROWS:  # one INSERT per row: one file each
        spark.sql(f"INSERT INTO {name} VALUES ({r[0]}, '{r[1]}', {r[2]})")


def _files(spark, name, by=()):
    return {tuple(r[c] for c in by): r["files"] for r in file_stats(spark.table(name), by).collect()}


def test_partition_into_one_file(spark, tmpdir_path):
    _make(spark, tmpdir_path, "student_2", True)
    before = fingerprint(spark.table("student_2")).first()
    rep = compact_table(spark, "student_2", {"age": 10}, num_files=1).first()
    assert rep.files_after == 1 and rep.rows == 3
    files = _files(spark, "student_2", ["age"])
    assert files[(10,)] == 1 and files[(20,)] == 3 and files[(30,)] == 2
    assert fingerprint(spark.table("student_2")).first() == before
    assert sorted(r[0] for r in spark.sql("SHOW PARTITIONS student_2").collect()) == \
        ["age=10", "age=20", "age=30"]


def test_whole_table_into_one_file(spark, tmpdir_path):
    _make(spark, tmpdir_path, "student", False)
    before = fingerprint(spark.table("student")).first()
    rep = compact_table(spark, "student", num_files=1).first()
    assert rep.files_before == 8 and rep.files_after == 1 and rep.rows == 8
    assert fingerprint(spark.table("student")).first() == before


def test_more_files_than_rows(spark, tmpdir_path):
    _make(spark, tmpdir_path, "student_m", False)
    compact_table(spark, "student_m", num_files=50)
    assert _files(spark, "student_m")[()] <= 8


def test_partitioned_spread_and_format_kept(spark, tmpdir_path):
    _make(spark, tmpdir_path, "student_orc", True, fmt="orc", extra="TBLPROPERTIES ('team'='x')")
    before = fingerprint(spark.table("student_orc")).first()
    compact_table(spark, "student_orc", num_files=3)
    assert sum(_files(spark, "student_orc", ["age"]).values()) == 3
    assert fingerprint(spark.table("student_orc")).first() == before
    desc = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED student_orc").collect()}
    assert desc["Provider"].lower() == "orc"
    assert "team" in desc.get("Table Properties", "")


def test_two_partition_columns_and_mixed_case(spark, tmpdir_path):
    spark.sql("DROP TABLE IF EXISTS people")
    spark.sql(f"CREATE TABLE people (id int, city string, yr int) USING parquet PARTITIONED BY (city, yr) "
              f"LOCATION '{tmpdir_path}/people'")
    for i, (c, y) in enumerate([("Paris", 1), ("Paris", 1), ("Paris", 2), ("Rome", 1), ("Rome", 1)]):
        spark.sql(f"INSERT INTO people VALUES ({i}, '{c}', {y})")
    compact_table(spark, "people", {"city": "Paris"}, num_files=1)
    f = _files(spark, "people", ["city", "yr"])
    assert f[("Paris", 1)] == 1 and f[("Paris", 2)] == 1 and f[("Rome", 1)] == 2
    assert spark.table("people").count() == 5


def test_failure_before_publish_leaves_table(spark, tmpdir_path):
    _make(spark, tmpdir_path, "student_f", True)
    before = fingerprint(spark.table("student_f")).first()
    files = _files(spark, "student_f", ["age"])
    with pytest.raises(CompactionError):
        compact_table(spark, "student_f", num_files=1, fail_before_publish=True)
    assert _files(spark, "student_f", ["age"]) == files
    assert fingerprint(spark.table("student_f")).first() == before


def test_path_compaction(spark, tmpdir_path):
    p = f"{tmpdir_path}/lines"
    spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").repartition(12).write.parquet(p)
    before = fingerprint(spark.read.parquet(p)).first()
    rep = compact_path(spark, p, num_files=2).first()
    assert rep.files_before == 12 and rep.files_after == 2
    assert fingerprint(spark.read.parquet(p)).first() == before


def test_auto_and_history(spark, tmpdir_path):
    _make(spark, tmpdir_path, "student_a", True)
    auto_compact(spark, "student_a", min_small_files=2, small_bytes=1 << 20)
    f = _files(spark, "student_a", ["age"])
    assert f[(10,)] == 1 and f[(20,)] == 1 and f[(30,)] == 2  # age=30 had only 2 small files
    compact_history(spark, "student_a", {"age": 40}, num_files=1)
    assert set(_files(spark, "student_a", ["age"]).values()) == {1}
    rep = small_file_report(spark.table("student_a"), ["age"]).collect()
    assert sum(r.rows for r in rep) == 8


def test_spread():
    assert spread(4, [10, 5, 5]) == [2, 1, 1]
    assert sum(spread(10, [1, 2, 3, 4])) == 10
    assert spread(2, [1, 1, 1]) == [1, 1, 1]


def test_unknown_partition_column(spark, tmpdir_path):
    _make(spark, tmpdir_path, "student_u", True)
    with pytest.raises(CompactionError):
        compact_table(spark, "student_u", {"name": "a"})


def test_staged_write_plan_is_one_shuffle(spark, tmpdir_path):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    from lakeshard.functions.hashing import salt
    plan = df.repartitionById(6, salt(df, 6))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_count_verification_mode(spark, tmpdir_path):
    _make(spark, tmpdir_path, "student_v", True)
    before = fingerprint(spark.table("student_v")).first()
    compact_table(spark, "student_v", num_files=3, verify="count")
    assert sum(_files(spark, "student_v", ["age"]).values()) == 3
    assert fingerprint(spark.table("student_v")).first() == before
    with pytest.raises(ValueError):
        compact_table(spark, "student_v", verify="nope")


def test_property_compaction_preserves_content(spark, tmpdir_path):
    """Seeded random tables and file counts: content digest unchanged, file
    count as asked (or the row count when smaller)."""
    import random

    rnd = random.Random(7)
    for i in range(3):
        rows = [(rnd.randint(0, 5), rnd.choice(["p", "q", None]), rnd.randint(1, 3)) for _ in range(rnd.randint(5, 60))]
        name = f"prop_{i}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        (spark.createDataFrame(rows, "a int, b string, k int").repartition(7)
         .write.partitionBy("k").option("path", f"{tmpdir_path}/{name}").saveAsTable(name))
        before = fingerprint(spark.table(name)).first()
        want = rnd.randint(1, 6)
        compact_table(spark, name, num_files=want)
        assert fingerprint(spark.table(name)).first() == before
        total = sum(_files(spark, name, ["k"]).values())
        assert total <= max(want, len(_files(spark, name, ["k"])))


def test_partitioned_path_compaction(spark, tmpdir_path):
    import os

    p = f"{tmpdir_path}/orders_p"
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    o.repartition(9).write.partitionBy("o_orderstatus", "o_orderpriority").parquet(p)
    read = lambda: spark.read.option("basePath", p).parquet(p)
    before = fingerprint(read()).first()
    rep = compact_path(spark, p, num_files=1, partition_by=["o_orderstatus", "o_orderpriority"],
                       where=F.col("o_orderstatus") != "P").first()
    assert rep.rows == o.where("o_orderstatus <> 'P'").count()
    files = {tuple(r[:2]): r["files"] for r in
             file_stats(read(), ["o_orderstatus", "o_orderpriority"]).collect()}
    assert all(n == 1 for (st, _), n in files.items() if st != "P")
    assert any(n > 1 for (st, _), n in files.items() if st == "P")
    assert fingerprint(read()).first() == before
    assert not [d for d in os.listdir(p) if d.startswith("_old") or d.startswith("_compact")]
