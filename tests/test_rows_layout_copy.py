"""Row rewrites, layouts, copy, profile, scripts."""

import os

import pytest
from pyspark.sql import functions as F

from lakeshard.operators import layout as lo
from lakeshard.operators import rows as rw
from lakeshard.operators.copy import dist_copy, tree_equal
from lakeshard.operators.profile import hash_sample, profile
from lakeshard.operators.script import reduce_groups

from sf_dir import SF


def _t(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, n long")


def test_delete_keeps_null_condition(spark):
    df = _t(spark, [(1, "a", 1), (2, None, 2), (3, "c", 3)])
    got = sorted(r.k for r in rw.delete_rows(df, F.col("v") == "a").collect())
    assert got == [2, 3]


def test_update(spark):
    df = _t(spark, [(1, "a", 1), (2, "b", 2)])
    got = {r.k: (r.v, r.n) for r in rw.update_rows(df, {"n": F.col("n") * 10}, F.col("v") == "b").collect()}
    assert got == {1: ("a", 1), 2: ("b", 20)}


def test_merge_clauses_in_order(spark):
    t = _t(spark, [(1, "a", 1), (2, "b", 2), (3, "c", 3), (None, "z", 0)])
    s = _t(spark, [(2, "B", 20), (3, "C", 30), (4, "D", 40), (None, "N", 0)])
    out = rw.merge_rows(t, s, ["k"], [
        rw.matched_delete(F.col("s.n") > 25),
        rw.matched_update({"v": F.col("s.v")}),
        rw.not_matched_insert(cond=F.col("s.n") > 0),
        rw.not_matched_by_source_update({"n": F.lit(-1)}, F.col("t.k").isNotNull()),
    ])
    got = sorted((r.k, r.v, r.n) for r in out.collect() if r.k is not None)
    assert got == [(1, "a", -1), (2, "B", 2), (4, "D", 40)]
    assert [r for r in out.collect() if r.k is None][0].v == "z"  # null key never matches


def test_merge_duplicate_source_raises(spark):
    t = _t(spark, [(1, "a", 1)])
    s = _t(spark, [(1, "x", 1), (1, "y", 2)])
    with pytest.raises(rw.MergeError):
        rw.merge_rows(t, s, ["k"], [rw.matched_update()])


def test_layout_file_counts(spark, tmpdir_path):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    n = li.count()
    p = lo.write_repartitioned(li, f"{tmpdir_path}/r", 5)
    assert len([f for f in os.listdir(p) if f.endswith(".parquet")]) == 5
    p = lo.write_coalesced(li, f"{tmpdir_path}/c", 1)
    assert len([f for f in os.listdir(p) if f.endswith(".parquet")]) == 1
    p = lo.write_distributed(li, f"{tmpdir_path}/d", ["l_returnflag"])
    for d in os.listdir(p):
        if d.startswith("l_returnflag="):
            assert len([f for f in os.listdir(f"{p}/{d}") if f.endswith(".parquet")]) == 1
    p = lo.write_salted(li, f"{tmpdir_path}/s", ["l_returnflag"], 3)
    for d in os.listdir(p):
        if d.startswith("l_returnflag="):
            assert 1 <= len([f for f in os.listdir(f"{p}/{d}") if f.endswith(".parquet")]) <= 3
    p = lo.write_ranged(li, f"{tmpdir_path}/g", 3, ["l_orderkey"])
    ranges = (spark.read.parquet(p).groupBy(F.input_file_name().alias("f"))
              .agg(F.min("l_orderkey").alias("lo"), F.max("l_orderkey").alias("hi"))
              .orderBy("lo").collect())
    assert all(a.hi <= b.lo for a, b in zip(ranges, ranges[1:]))
    assert spark.read.parquet(p).count() == n


def test_hot_keys_and_skew_split(spark, tmpdir_path):
    rows = [(1, "hot")] * 60 + [(i, "x%d" % i) for i in range(40)]
    df = spark.createDataFrame(rows, "i long, key string")
    hot = [r.key for r in lo.hot_keys(df, "key", 0.3).collect()]
    assert hot == ["hot"]
    p = lo.write_skew_split(df, f"{tmpdir_path}/k", "key", n=4, hot=hot)
    per_file = (spark.read.parquet(p).where("key = 'hot'")
                .groupBy(F.input_file_name()).count().collect())
    assert len(per_file) > 1 and sum(r[1] for r in per_file) == 60


def test_copy_tree(spark, tmpdir_path):
    src = f"{tmpdir_path}/src"
    os.makedirs(f"{src}/a b/c(1)/d+e", exist_ok=True)
    os.makedirs(f"{src}/empty", exist_ok=True)
    files = {"0": "it is what it is", "a b/1": "what is it", "a b/c(1)/d+e/2": "it is a banana", "empty.txt": ""}
    for rel, body in files.items():
        with open(f"{src}/{rel}", "w") as f:
            f.write(body)
    dst = f"{tmpdir_path}/dst"
    man = dist_copy(spark, src, dst, max_concurrency=2)
    assert {r.status for r in man.collect()} == {"ok"}
    assert tree_equal(spark, src, dst).count() == 0
    assert os.path.isdir(f"{dst}/empty")
    assert open(f"{dst}/a b/c(1)/d+e/2").read() == "it is a banana"
    assert os.path.getsize(f"{dst}/empty.txt") == 0


def test_copy_failure_policy(spark, tmpdir_path):
    src = f"{tmpdir_path}/src2"
    os.makedirs(src)
    with open(f"{src}/x", "w") as f:
        f.write("x")
    missing = spark.createDataFrame([(f"file:{src}/missing", f"file:{tmpdir_path}/d2/missing", 1)],
                                    "src string, dst string, length long")
    man = dist_copy(spark, src, f"{tmpdir_path}/d2", ignore_failures=True, extra_files=missing)
    st = {r.dst.rsplit("/", 1)[-1]: r.status for r in man.collect()}
    assert st == {"x": "ok", "missing": "failed"}
    with pytest.raises(Exception):
        dist_copy(spark, src, f"{tmpdir_path}/d3", ignore_failures=False, extra_files=missing)


def test_profile_and_sample(spark):
    c = spark.read.parquet(f"{SF}/customer.parquet")
    p = {r.column: r for r in profile(c, exact=True).collect()}
    assert p["c_custkey"].rows == c.count() and p["c_custkey"].nulls == 0
    s1 = {r.o_orderkey for r in hash_sample(spark.read.parquet(f"{SF}/orders.parquet"), "o_orderkey", 1, 4).collect()}
    s2 = {r.o_orderkey for r in hash_sample(spark.read.parquet(f"{SF}/orders.parquet"), "o_orderkey", 1, 4).collect()}
    assert s1 == s2 and all(k % 4 == 0 for k in s1)


def test_reduce_groups_streams(spark):
    df = spark.createDataFrame([(k % 3, 1.0) for k in range(3000)], "k long, v double")
    out = reduce_groups(df, ["k"], init=lambda: 0.0, step=lambda s, c: s + c["v"].sum(),
                        finish=lambda k, s: {"k": k[0], "total": s}, schema="k long, total double")
    assert {r.k: r.total for r in out.collect()} == {0: 1000.0, 1: 1000.0, 2: 1000.0}


def test_streaming_sink_appends_once_and_compacts(spark, tmpdir_path):
    from lakeshard.operators.compact import file_stats
    from lakeshard.streaming.compaction_sink import compacting_sink, run_to_completion

    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.repartition(6).write.parquet(f"{tmpdir_path}/in")
    spark.sql("DROP TABLE IF EXISTS ev_stream")
    ev.limit(0).write.format("parquet").option("path", f"{tmpdir_path}/t").saveAsTable("ev_stream")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 2).parquet(f"{tmpdir_path}/in")
    run_to_completion(stream, "ev_stream", f"{tmpdir_path}/ck", f"{tmpdir_path}/mk", every=1,
                      min_small_files=1, small_bytes=1 << 30)
    assert spark.table("ev_stream").count() == ev.count()
    assert file_stats(spark.table("ev_stream")).first()["files"] == 1
    # a replayed epoch is skipped
    sink = compacting_sink("ev_stream", f"{tmpdir_path}/mk")
    sink(ev, 0)
    assert spark.table("ev_stream").count() == ev.count()


def test_provenance_columns(spark):
    from lakeshard.functions.provenance import session_info, with_provenance

    r = with_provenance(spark.read.parquet(f"{SF}/region.parquet")).first()
    assert r.spark_version.startswith(spark.version.split(".")[0]) and r.run_user
    assert session_info(spark.read.parquet(f"{SF}/region.parquet")).first().rows == 5


def test_publish_partitioned(spark, tmpdir_path):
    from lakeshard.operators.compact import file_stats

    spark.sql("DROP TABLE IF EXISTS pub_p")
    spark.sql(f"CREATE TABLE pub_p (id int, k string) USING parquet PARTITIONED BY (k) LOCATION '{tmpdir_path}/p'")
    spark.sql("INSERT INTO pub_p VALUES (1, 'a'), (2, 'a'), (3, 'b'), (4, 'c')")
    before_c = file_stats(spark.table("pub_p").where("k = 'c'")).first()
    t = spark.table("pub_p")
    scope = F.col("k").isin("a", "b")
    new = rw.update_rows(rw.delete_rows(t.where(scope), F.col("k") == "b"), {"id": F.col("id") * 10})
    new = new.unionByName(spark.createDataFrame([(7, "d")], "id int, k string"))
    with pytest.raises(rw.MergeError):  # 'd' is outside the scope
        rw.publish(spark, "pub_p", new, partitions=scope)
    rw.publish(spark, "pub_p", new.where("k <> 'd'"), partitions=scope)
    assert sorted((r.id, r.k) for r in spark.table("pub_p").collect()) == [(4, "c"), (10, "a"), (20, "a")]
    assert sorted(r[0] for r in spark.sql("SHOW PARTITIONS pub_p").collect()) == ["k=a", "k=c"]
    assert file_stats(spark.table("pub_p").where("k = 'c'")).first() == before_c


def test_scale_conf_and_parallelism(spark):
    from lakeshard.session import scale_conf
    from lakeshard.sources.tables import ensure_parallelism

    c = scale_conf(100 * 10**12, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) >= 100 * 10**12 // (256 << 20)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert ensure_parallelism(docs, 6).rdd.getNumPartitions() >= 6
    many = spark.range(0, 100, numPartitions=12).toDF("id")
    assert ensure_parallelism(many, 6).rdd.getNumPartitions() == 12


def test_copy_include_hidden(spark, tmpdir_path):
    src = f"{tmpdir_path}/hs"
    os.makedirs(f"{src}/d/.git")
    for rel, body in {".top": "t", "d/x": "xx", "d/.git/HEAD": "ref", "d/_SUCCESS": ""}.items():
        with open(f"{src}/{rel}", "w") as f:
            f.write(body)
    plain = f"{tmpdir_path}/plain"
    dist_copy(spark, src, plain, include_hidden=False)
    assert os.path.exists(f"{plain}/d/x") and not os.path.exists(f"{plain}/.top")
    full = f"{tmpdir_path}/full"
    man = dist_copy(spark, src, full, max_concurrency=2)
    assert {r.status for r in man.collect()} == {"ok"}
    for rel in (".top", "d/x", "d/.git/HEAD", "d/_SUCCESS"):
        assert open(f"{full}/{rel}").read() == open(f"{src}/{rel}").read()


def test_two_level_agg_splits_hot_key(spark):
    from lakeshard.operators.script import two_level_agg

    rows = [("hot", float(i)) for i in range(300)] + [(f"k{i}", 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, v double")
    partial = [F.sum("v").alias("_s"), F.count(F.lit(1)).alias("_n")]
    out = two_level_agg(df, ["k"], partial=partial,
                        final=[F.sum("_s").alias("total"), F.sum("_n").alias("n"),
                               F.count(F.lit(1)).alias("parts"), F.max("_n").alias("biggest")],
                        max_group_rows=50)
    got = {r.k: (r.total, r.n, r.parts, r.biggest) for r in out.collect()}
    total, n, parts, biggest = got["hot"]
    assert (total, n) == (sum(range(300)), 300)
    assert parts > 3 and biggest < 300       # 300 rows -> 6 salt values
    assert got["k5"] == (1.0, 1, 1, 1)


def test_copy_no_overwrite_skips_existing(spark, tmpdir_path):
    src, dst = f"{tmpdir_path}/s3", f"{tmpdir_path}/d3"
    os.makedirs(src)
    os.makedirs(dst)
    for name, body in {"a": "new", "b": "bbb"}.items():
        with open(f"{src}/{name}", "w") as f:
            f.write(body)
    with open(f"{dst}/a", "w") as f:
        f.write("old")
    man = {r.dst.rsplit("/", 1)[-1]: r.status for r in dist_copy(spark, src, dst, overwrite=False).collect()}
    assert man == {"a": "skipped", "b": "ok"}
    assert open(f"{dst}/a").read() == "old" and open(f"{dst}/b").read() == "bbb"


def test_band_join_equals_brute_force(spark):
    import random

    from lakeshard.operators.joins import band_join

    rnd = random.Random(3)
    L = [(i, rnd.randint(0, 3), rnd.uniform(-50, 50)) for i in range(120)]
    R = [(j, rnd.randint(0, 3), rnd.uniform(-50, 50)) for j in range(80)]
    ldf = spark.createDataFrame(L, "lid long, lk int, lv double")
    rdf = spark.createDataFrame(R, "rid long, rk int, rv double")
    for low, high, w in ((-5, 5, None), (-3, 7, 2.5), (0, 0, 1.0)):
        got = {(r.lid, r.rid) for r in band_join(ldf, rdf, "lv", "rv", low, high, on=[("lk", "rk")],
                                                   bin_width=w).collect()}
        want = {(a, b) for a, ak, av in L for b, bk, bv in R if ak == bk and bv + low <= av <= bv + high}
        assert got == want
    left = band_join(ldf, rdf, "lv", "rv", -1, 1, how="left")
    assert left.select("lid").distinct().count() == 120


def test_skew_split_salts_scale_with_key_size(spark, tmpdir_path):
    rows = [(i, "hot") for i in range(400)] + [(i, f"c{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "i long, key string")
    p = lo.write_skew_split(df, f"{tmpdir_path}/adaptive", "key", share=0.5, max_rows_per_task=100)
    per_file = (spark.read.parquet(p).where("key = 'hot'")
                .groupBy(F.input_file_name()).count().collect())
    # 4 salt values over the session's 4 shuffle partitions: split, never whole
    assert len(per_file) >= 2 and max(r[1] for r in per_file) < 400
    assert sum(r[1] for r in per_file) == 400
    assert spark.read.parquet(p).count() == 500


def test_rebalanced_and_partitioned_writes_keep_rows(spark, tmpdir_path):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    p = lo.write_rebalanced(li, f"{tmpdir_path}/rb", ["l_returnflag"])
    back = spark.read.parquet(p)
    assert back.count() == li.count()
    assert sorted(r[0] for r in back.select("l_returnflag").distinct().collect()) == \
        sorted(r[0] for r in li.select("l_returnflag").distinct().collect())
    rep = {r.l_returnflag: r for r in lo.small_file_report(back, ["l_returnflag"], 1 << 30).collect()}
    assert all(r.small_files == r.files for r in rep.values())
    assert sum(r.rows for r in rep.values()) == li.count()


def test_copy_is_whole(spark, tmpdir_path):
    """Names with ``%``, empty and hidden files, and targets that must stay, one manifest row each."""
    src, dst = f"{tmpdir_path}/whole", f"{tmpdir_path}/whole-to"
    bodies = {"p%20q.txt": "1", "ts=10%3A00/x.txt": "2", "empty": "", "a/b/c/d/e": "3", "a/b/_SUCCESS": "", "a/.crc": "4", "kept": ""}
    for rel, body in bodies.items():
        os.makedirs(os.path.dirname(f"{src}/{rel}"), exist_ok=True)
        with open(f"{src}/{rel}", "w") as f:
            f.write(body)
    os.makedirs(f"{src}/none/at/all/here")
    os.makedirs(dst)
    with open(f"{dst}/kept", "w") as f:
        f.write("old")
    man = dist_copy(spark, src, dst, overwrite=False, max_concurrency=3).collect()
    assert {r.dst.split("whole-to/")[1]: (r.length, r.status) for r in man} == {
        k: (len(v), "skipped" if k == "kept" else "ok") for k, v in bodies.items()}
    for rel, body in bodies.items():
        assert open(f"{dst}/{rel}").read() == ("old" if rel == "kept" else body)
    assert os.path.isdir(f"{dst}/none/at/all/here")


def test_reduce_groups_keeps_null_and_large_keys(spark):
    from lakeshard.operators.script import reduce_groups

    rows = [(None, 1), (9007199254740993, 1), (None, 2), (9007199254740992, 5), (None, 3), (9007199254740993, None)]
    df = spark.createDataFrame(rows, "k long, v long")

    def combine(pdf):
        return pdf.groupby("k", as_index=False, dropna=False).agg({"v": "sum"})

    for c in (None, combine):
        got = reduce_groups(df.repartition(2), ["k"], init=lambda: 0, step=lambda s, x: s + int(x["v"].sum()),
                            finish=lambda k, s: {"k": k[0], "s": s}, schema="k long, s long", combine=c).collect()
        assert sorted(map(tuple, got), key=str) == sorted([(None, 6), (9007199254740993, 1), (9007199254740992, 5)], key=str)


def test_two_level_agg_splits_the_null_key(spark):
    from lakeshard.operators.script import two_level_agg

    df = spark.createDataFrame([(None, float(i)) for i in range(900)] + [("a", 1.0)], "k string, v double")
    got = {r.k: r for r in two_level_agg(df, ["k"], [F.count("*").alias("_n"), F.sum("v").alias("_s")],
                                         [F.sum("_n").alias("n"), F.max("_n").alias("biggest"), F.sum("_s").alias("s")], 100).collect()}
    assert got[None].n == 900 and got[None].biggest < 300 and got[None].s == sum(range(900)) and got["a"].n == 1


def test_layout_files_follow_the_size(spark, monkeypatch):
    """The file counts of the layout queries are a floor: a larger table gets more files and tasks."""
    from lakeshard.plans import maintenance as mt

    asked = {}
    for name in ("write_coalesced", "write_repartitioned", "write_ranged", "write_salted"):
        real = getattr(lo, name)
        pos = 3 if name == "write_salted" else 2
        monkeypatch.setattr(lo, name, lambda *a, real=real, name=name, pos=pos: asked.setdefault(name, a[pos]) and real(*a))
    for q in (mt.q_layout_coalesce, mt.q_layout_repartition, mt.q_layout_range, mt.q_layout_salted):
        q(spark, SF)
    assert asked == {"write_coalesced": 2, "write_repartitioned": 5, "write_ranged": 4, "write_salted": 3}
    asked.clear()
    real_count = mt._file_count
    monkeypatch.setattr(mt, "_file_count", lambda df, **k: real_count(df, file_bytes=4096, **k))
    n = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    for q in (mt.q_layout_coalesce, mt.q_layout_repartition, mt.q_layout_range, mt.q_layout_salted):
        assert q(spark, SF).count() == n
    assert min(asked.values()) > 5 and len(set(asked.values())) == 1


def test_exact_profile_does_not_expand_rows(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (None, "b", None)], "k int, s string, z double")
    got = profile(df, exact=True)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [("k", 3, 1, 2, "1", "2"), ("s", 3, 0, 2, "a", "b"), ("z", 3, 3, 0, None, None)]


def test_udtf_runs_in_many_tasks(spark):
    from lakeshard.plans.generators import q_udtf

    got = q_udtf(spark, SF)
    assert got.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert "ArrowEvalPythonUDTF" not in got._jdf.queryExecution().executedPlan().toString()
    first = {(r.pos, r.part.strip("0")) for r in got.where("c_custkey = 5").collect()}
    assert {p for p, _ in first} == {0, 1} and (0, "Customer") in first
