"""Plan assertions over the registered queries (planning only, no execution)."""

import re

import pytest

from lakeshard.plans.registry import entries

from sf_dir import SF

PURE = {"relational", "joins", "aggregates", "windows", "ordering", "setops", "scalars", "core"}
PY_NODES = re.compile(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas|AggregateInPandas|"
                      r"ArrowAggregatePython|PythonUDTF")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _pure_entries():
    out = []
    for name, e in sorted(entries().items()):
        mod = e.plan.__module__.rsplit(".", 1)[-1]
        if e.group in PURE or mod in PURE:
            out.append(name)
    return out


@pytest.mark.parametrize("name", _pure_entries())
def test_no_python_no_nested_loop(spark, name):
    if name.startswith("inverted_index"):
        pytest.skip("plans after an eager checkpoint; covered by test_index")
    plan = _plan(entries()[name].plan(spark, SF))
    assert not PY_NODES.search(plan), name
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_filters_and_pruning_reach_the_scan(spark):
    plan = _plan(entries()["between"].plan(spark, SF))
    assert "PushedFilters: [IsNotNull(l_quantity)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate:timestamp_ntz>" in plan


def test_bucketed_join_needs_no_exchange(spark):
    """Both sides bucketed by the key into 8 buckets: join and the following
    aggregation on the key run without any shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = entries()["ctas_bucketed"].plan(spark, SF)
        plan = _plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in plan
    assert "Exchange" not in plan


def test_index_plan_shape(spark):
    from pyspark.sql import functions as F

    from lakeshard.operators import index as ix

    docs = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("doc"), "text")
    tf = ix.term_frequency(docs)
    tf_plan = _plan(tf)
    assert "partial_count" in tf_plan and "Generate explode" in tf_plan
    p = tf.withColumn("posting", F.lit("x")).repartitionByRange("word", "posting")
    assert "rangepartitioning(word" in _plan(p)
    idx_plan = _plan(ix.inverted_index(docs))
    assert not PY_NODES.search(idx_plan)
    assert "CartesianProduct" not in idx_plan and "BroadcastNestedLoopJoin" not in idx_plan
    assert "collect_list" in idx_plan
