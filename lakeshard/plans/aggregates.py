"""Aggregations (survey 2.E).  All use partial (map-side) aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshard.plans.registry import query, sql_query
from lakeshard.sources.tables import Tables


def _r(c, n=2):
    return F.round(c, n)


@query("group_by", oracle="""
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_base_price,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
       round(avg(l_quantity), 4) AS avg_qty, count(*) AS count_order
FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-12-01' GROUP BY l_returnflag, l_linestatus""")
def q_group_by(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return (li.where(F.col("l_shipdate") <= F.lit("2000-12-01").cast("timestamp_ntz"))
            .groupBy("l_returnflag", "l_linestatus")
            .agg(_r(F.sum("l_quantity")).alias("sum_qty"),
                 _r(F.sum("l_extendedprice")).alias("sum_base_price"),
                 _r(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("sum_disc_price"),
                 _r(F.avg("l_quantity"), 4).alias("avg_qty"),
                 F.count(F.lit(1)).alias("count_order")))


@query("having", oracle="""
SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey HAVING count(*) >= 20""")
def q_having(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return (o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
            .where(F.col("n_orders") >= 20))


@query("rollup", oracle="""
SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""")
def q_rollup(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return (o.rollup("o_orderstatus", "o_orderpriority")
            .agg(F.count(F.lit(1)).alias("n"), _r(F.sum("o_totalprice")).alias("total")))


@query("cube", oracle="""
SELECT l_returnflag, l_linestatus, CAST(grouping_id(l_returnflag, l_linestatus) AS BIGINT) AS gid,
       count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def q_cube(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return (li.cube("l_returnflag", "l_linestatus")
            .agg(F.grouping_id().cast("bigint").alias("gid"), F.count(F.lit(1)).alias("n")))


@query("grouping_sets", oracle="""
SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer
GROUP BY GROUPING SETS ((c_mktsegment, c_nationkey), (c_mktsegment), ())""")
def q_grouping_sets(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.groupingSets([["c_mktsegment", "c_nationkey"], ["c_mktsegment"], []],
                          "c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("n"))


sql_query("grouping_sets_nested", """
SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer
GROUP BY GROUPING SETS (ROLLUP (c_mktsegment, c_nationkey), (c_nationkey))""", oracle="""
SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer
GROUP BY GROUPING SETS ((c_mktsegment, c_nationkey), (c_mktsegment), (), (c_nationkey))""", group="aggregates")

sql_query("grouping_concat", """
SELECT o_orderstatus, o_orderpriority, year(o_orderdate) AS yr, count(*) AS n
FROM orders GROUP BY o_orderstatus, CUBE (o_orderpriority), ROLLUP (year(o_orderdate))""", oracle="""
SELECT o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS n
FROM orders GROUP BY o_orderstatus, CUBE (o_orderpriority), ROLLUP (year(o_orderdate))""", group="aggregates")


@query("count_distinct", oracle="""
SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT l_suppkey) AS n_supp
FROM lineitem GROUP BY l_returnflag""")
def q_count_distinct(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("n_orders"),
                                          F.count_distinct("l_suppkey").alias("n_supp"))


sql_query("agg_filter", """
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f,
       round(sum(o_totalprice) FILTER (WHERE o_totalprice > 200000), 2) AS big_total
FROM orders GROUP BY o_orderpriority""", oracle="same", group="aggregates")


@query("first_last", oracle="""
SELECT o_custkey, min_by(o_orderkey, o_orderdate) AS first_order, max_by(o_orderkey, o_orderdate) AS last_order,
       min(o_orderdate) AS first_date
FROM (SELECT * FROM orders WHERE o_orderkey NOT IN (
   SELECT o_orderkey FROM (SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey, o_orderdate) AS c FROM orders)
   WHERE c > 1)) GROUP BY o_custkey""")
def q_first_last(spark, sf_dir):
    """``first``/``last`` made deterministic as ``min_by``/``max_by``; ties on
    the ordering key are excluded so the answer is unique."""
    o = Tables(spark, sf_dir).orders
    dup = (o.groupBy("o_custkey", "o_orderdate").agg(F.count(F.lit(1)).alias("c"))
           .where("c > 1").drop("c"))
    u = o.join(dup, ["o_custkey", "o_orderdate"], "left_anti")
    return u.groupBy("o_custkey").agg(F.min_by("o_orderkey", "o_orderdate").alias("first_order"),
                                      F.max_by("o_orderkey", "o_orderdate").alias("last_order"),
                                      F.min("o_orderdate").alias("first_date"))


sql_query("first_ignore_nulls", """
SELECT c.c_nationkey, first(o.o_orderstatus, true) IS NOT NULL AS has_status,
       count(o.o_orderkey) AS n_orders, count(*) AS n_rows
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_nationkey""", oracle="""
SELECT c.c_nationkey, count(o.o_orderstatus) > 0 AS has_status,
       count(o.o_orderkey) AS n_orders, count(*) AS n_rows
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_nationkey""", group="aggregates")


@query("pivot", oracle="""
SELECT o_orderpriority,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
       count(*) FILTER (WHERE o_orderstatus = 'O') AS "O",
       count(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
FROM orders GROUP BY o_orderpriority""")
def q_pivot(spark, sf_dir):
    """Pivot values are listed, so no extra job is run to discover them."""
    o = Tables(spark, sf_dir).orders
    return (o.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"])
            .agg(F.count(F.lit(1))).na.fill(0, ["F", "O", "P"]))


sql_query("pivot_sql", """
SELECT * FROM (SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem)
PIVOT (count(*) AS n, round(sum(l_quantity), 2) AS q FOR l_linestatus IN ('O' AS open, 'F' AS fin))""",
          oracle="""
SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'O') AS open_n,
       round(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), 2) AS open_q,
       count(*) FILTER (WHERE l_linestatus = 'F') AS fin_n,
       round(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 2) AS fin_q
FROM lineitem GROUP BY l_returnflag""", group="aggregates")


sql_query("pivot_multi_column", """
SELECT * FROM (SELECT o_orderpriority, o_orderstatus, year(o_orderdate) AS yr, o_orderkey FROM orders)
PIVOT (count(o_orderkey) AS n FOR (o_orderstatus, yr) IN (('F', 1995) AS f95, ('O', 2000) AS o00))""",
          oracle="""
SELECT o_orderpriority,
       count(o_orderkey) FILTER (WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1995) AS f95,
       count(o_orderkey) FILTER (WHERE o_orderstatus = 'O' AND year(o_orderdate) = 2000) AS o00
FROM orders GROUP BY o_orderpriority""", group="aggregates")


sql_query("rollup_with", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
GROUP BY o_orderstatus, o_orderpriority WITH ROLLUP""", oracle="""
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""", group="aggregates")

sql_query("cube_with", """
SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer
GROUP BY c_mktsegment, c_nationkey WITH CUBE""", oracle="""
SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer
GROUP BY CUBE (c_mktsegment, c_nationkey)""", group="aggregates")
