import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeshard.operators import intervals, prefix, ranges_copy
from lakeshard.operators.profile import bottom_k
from sf_dir import SF

# -- running windows -----------------------------------------------------------


def _skewed(spark, n=4000):
    rng = random.Random(6)
    rows = [("hot" if i % 3 == 0 else None if i % 11 == 0 else f"k{rng.randrange(40)}", i * 7919 % n, rng.choice([None, 1, 5, -3])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, t long, v long").repartition(6)


def _plain(rows):
    out, seen = Counter(), {}
    for k, t, v in sorted(rows, key=lambda r: r[1]):
        n, total, prev = seen.get(k, (0, None, None))
        total = total if v is None else (total or 0) + v
        out[k, t, v, n + 1, total, prev] += 1
        seen[k] = (n + 1, total, v)
    return out


def test_running_equals_plain_windows(spark):
    rows, df = _skewed(spark)
    got = prefix.running(df, ["k"], ["t"], row_number="n", sums={"s": "v"}, lags={"p": "v"})
    assert Counter(map(tuple, got.collect())) == _plain(rows)


def test_running_without_a_key_and_of_nothing(spark):
    df = spark.createDataFrame([(i, 1) for i in range(500)], "t long, v long").repartition(5)
    got = prefix.running(df, [], [F.col("t").desc()], row_number="n", sums={"s": "v"}, lags={"p": "t"})
    assert Counter(map(tuple, got.collect())) == Counter((t, 1, 500 - t, 500 - t, t + 1 if t < 499 else None) for t in range(500))
    assert prefix.running(df.limit(0), ["v"], ["t"], row_number="n").count() == 0


def test_repeated_rows_are_numbered_once(spark):
    df = spark.createDataFrame([("a", 1)] * 300 + [("b", 2)], "k string, t long").repartition(4)
    got = prefix.running(df, ["k"], ["t"], row_number="n")
    assert sorted(r["n"] for r in got.where("k = 'a'").collect()) == list(range(1, 301))


def test_no_task_holds_a_hot_key(spark):
    rows, df = _skewed(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows come together again
    try:
        got = prefix.running(df, ["k"], ["t"], row_number="n").checkpoint()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = got.where("k = 'hot'").withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    hot = sum(r[0] == "hot" for r in rows)
    assert len(parts) > 1 and max(r["count"] for r in parts) < 0.8 * hot


# -- overlap join --------------------------------------------------------------

def _intervals(n, seed, name):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a = 500.0 if i % 3 == 0 else rng.uniform(0, 1000)  # a third begins at one point
        rows.append((i, a, a + rng.choice([0.0, 0.5, 3.0, 40.0])))
    return rows + [(n, None, 5.0), (n + 1, 5.0, None), (n + 2, 9.0, 3.0)]


@pytest.mark.parametrize("rows_per_bin", [5, 40, 10_000])
def test_overlaps_equal_brute_force(spark, rows_per_bin):
    left, right = _intervals(300, 1, "l"), _intervals(120, 2, "r")
    lf = spark.createDataFrame(left, "i long, a double, b double").repartition(3)
    rf = spark.createDataFrame(right, "j long, c double, d double").repartition(3)
    got = Counter((r["i"], r["j"]) for r in intervals.overlap_join(lf, rf, ("a", "b"), ("c", "d"), rows_per_bin).collect())
    ok = lambda x, y: x is not None and y is not None and x <= y
    want = Counter((i, j) for i, a, b in left if ok(a, b) for j, c, d in right if ok(c, d) and a <= d and c <= b)
    assert got == want


def test_overlap_plan_is_an_equi_join(spark):
    lf = spark.createDataFrame(_intervals(300, 1, "l"), "i long, a double, b double")
    rf = spark.createDataFrame(_intervals(120, 2, "r"), "j long, c double, d double")
    plan = intervals.overlap_join(lf, rf, ("a", "b"), ("c", "d"), 20)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert intervals.largest_bin(lf.where("a < 499 OR a > 501"), ("a", "b"), 20) < 100
    assert intervals.overlap_join(lf.limit(0), rf, ("a", "b"), ("c", "d")).count() == 0


# -- split copy ----------------------------------------------------------------

@pytest.fixture()
def tree(tmp_path):
    rng = random.Random(1)
    src = tmp_path / "src"
    (src / "deep er" / "x%y").mkdir(parents=True)
    for name, n in (("big.bin", 10_007), ("deep er/exact", 4_000), ("deep er/x%y/é", 999), ("empty", 0), (".hidden", 17)):
        (src / name).write_bytes(rng.randbytes(n))
    return src


def _same(a, b):
    names = lambda t: {os.path.relpath(f"{d}/{n}", t) for d, _, ns in os.walk(t) for n in ns}
    assert names(a) == names(b)
    for n in names(a):
        assert (a / n).read_bytes() == (b / n).read_bytes()


def test_large_files_are_copied_by_ranges(spark, tree, tmp_path):
    dst = tmp_path / "dst"
    got = {r["dst"].rsplit("/", 1)[1]: r for r in ranges_copy.split_copy(spark, str(tree), str(dst), range_bytes=1000, max_concurrency=4).collect()}
    _same(tree, dst)
    assert {n: (r["ranges"], r["copied"], r["status"]) for n, r in got.items()} == {
        "big.bin": (11, 11, "ok"), "exact": (4, 4, "ok"), "é": (1, 1, "ok"), "empty": (1, 1, "ok"), ".hidden": (1, 1, "ok")}
    ranges = ranges_copy.byte_ranges(ranges_copy.copy_manifest(spark, str(tree), str(dst)), 1000).where("dst LIKE '%big.bin'")
    where = ranges.repartition(4, F.xxhash64("dst", "part")).groupBy(F.spark_partition_id()).count()
    assert where.count() > 1  # several tasks copy the file


def test_a_broken_run_goes_on_where_it_was(spark, tree, tmp_path):
    dst = tmp_path / "dst"
    ranges = ranges_copy.byte_ranges(ranges_copy.copy_manifest(spark, str(tree), str(dst)), 1000)
    ranges_copy.copy_ranges(ranges.where("dst LIKE '%big.bin' AND part <> 3"), "r1", 2)
    got = {r["dst"].rsplit("/", 1)[1]: r["copied"] for r in ranges_copy.split_copy(spark, str(tree), str(dst), 1000, 2, run="r1").collect()}
    assert got["big.bin"] == 1 and got["exact"] == 4
    _same(tree, dst)


def test_a_damaged_target_is_found(spark, tree, tmp_path):
    dst = tmp_path / "dst"
    ranges = ranges_copy.byte_ranges(ranges_copy.copy_manifest(spark, str(tree), str(dst)), 1000)
    done = ranges_copy.copy_ranges(ranges, "r2", 2)
    ranges_copy.stitch(done, "r2")
    ranges_copy.stitch(done, "r2")  # a repeated task does no harm
    data = bytearray((dst / "big.bin").read_bytes())
    data[3500] ^= 1
    (dst / "big.bin").write_bytes(data)
    bad = ranges_copy.checked(done, 2).where("NOT ok").collect()
    assert [(r["part"], r["dst"].rsplit("/", 1)[1]) for r in bad] == [(3, "big.bin")]


# -- samples -------------------------------------------------------------------

def test_bottom_k_is_exact_and_repeatable(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    a = bottom_k(o, 50, ["o_orderkey"]).collect()
    assert len(a) == 50 and sorted(a) == sorted(bottom_k(o.repartition(9), 50, ["o_orderkey"]).collect())
    by = bottom_k(o, 7, ["o_orderkey"], ["o_orderstatus"])
    assert {r["o_orderstatus"]: r["count"] for r in by.groupBy("o_orderstatus").count().collect()} == {"F": 7, "O": 7, "P": 7}
    assert bottom_k(o, 10_000, ["o_orderkey"]).count() == o.count()
    assert bottom_k(o.limit(0), 5, ["o_orderkey"], ["o_orderstatus"]).count() == 0


def test_strata_are_limited_before_the_shuffle(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    plan = bottom_k(o, 7, ["o_orderkey"], ["o_orderstatus"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
