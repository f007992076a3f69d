"""Window functions (survey 2.F).

Every window is partitioned by a key (customer, part, nation), so the
window operator runs in parallel over hash partitions; orderings end in a
unique key so ranks and frames are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeshard.operators.prefix import running
from lakeshard.plans.registry import query, sql_query
from lakeshard.sources.tables import Tables


@query("window_rank", oracle="""
SELECT o_orderkey, o_custkey,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rn,
       CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS INTEGER) AS rk,
       CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS INTEGER) AS drk
FROM orders""")
def q_window_rank(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    by_price = Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    by_prio = Window.partitionBy("o_custkey").orderBy("o_orderpriority")
    return o.select("o_orderkey", "o_custkey",
                    F.row_number().over(by_price).alias("rn"),
                    F.rank().over(by_prio).alias("rk"),
                    F.dense_rank().over(by_prio).alias("drk"))


sql_query("window_named", """
SELECT o_orderkey, o_custkey, count(*) OVER w AS n_before, round(sum(o_totalprice) OVER w, 2) AS running
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
          oracle="same", group="windows")


@query("window_rows", oracle="""
SELECT o_orderkey, o_custkey,
       round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                     ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS moving3,
       count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                      ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS n_around
FROM orders""")
def q_window_rows(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return o.select("o_orderkey", "o_custkey",
                    F.round(F.sum("o_totalprice").over(w.rowsBetween(-2, 0)), 2).alias("moving3"),
                    F.count(F.lit(1)).over(w.rowsBetween(-1, 1)).alias("n_around"))


@query("window_range", oracle="""
SELECT o_orderkey, o_custkey,
       count(*) OVER (PARTITION BY o_custkey ORDER BY o_totalprice
                      RANGE BETWEEN 50000 PRECEDING AND CURRENT ROW) AS n_cheaper_band
FROM orders""")
def q_window_range(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    w = Window.partitionBy("o_custkey").orderBy("o_totalprice").rangeBetween(-50000, 0)
    return o.select("o_orderkey", "o_custkey", F.count(F.lit(1)).over(w).alias("n_cheaper_band"))


sql_query("window_range_interval", """
SELECT o_orderkey, o_custkey,
       count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderdate
                      RANGE BETWEEN INTERVAL 365 DAYS PRECEDING AND CURRENT ROW) AS n_last_year
FROM orders""", oracle="same", group="windows")

# Orders up to 300,000 give NULLs to skip; a customer's orders make a small window.
sql_query("window_ignore_nulls", """
SELECT o_orderkey, o_custkey,
       last_value(big) IGNORE NULLS OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_big,
       first_value(big) IGNORE NULLS OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_big
FROM (SELECT *, CASE WHEN o_totalprice > 300000 THEN o_orderkey END AS big FROM orders)""", oracle="""
SELECT o_orderkey, o_custkey,
       last_value(big IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_big,
       first_value(big IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_big
FROM (SELECT *, CASE WHEN o_totalprice > 300000 THEN o_orderkey END AS big FROM orders)""", group="windows")


@query("window_analytic", oracle="""
SELECT o_orderkey, o_custkey,
       lag(o_totalprice, 1) OVER w AS prev_price,
       lead(o_orderkey, 2, -1) OVER w AS next2,
       CAST(ntile(4) OVER w AS INTEGER) AS quartile,
       round(cume_dist() OVER w, 6) AS cd,
       round(percent_rank() OVER w, 6) AS pr,
       nth_value(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def q_window_analytic(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return o.select("o_orderkey", "o_custkey",
                    F.lag("o_totalprice", 1).over(w).alias("prev_price"),
                    F.lead("o_orderkey", 2, -1).over(w).alias("next2"),
                    F.ntile(4).over(w).alias("quartile"),
                    F.round(F.cume_dist().over(w), 6).alias("cd"),
                    F.round(F.percent_rank().over(w), 6).alias("pr"),
                    F.nth_value("o_orderkey", 2).over(whole).alias("second"))


sql_query("window_distribute_sort", """
SELECT o_orderkey, o_custkey,
       row_number() OVER (DISTRIBUTE BY o_custkey SORT BY o_orderdate, o_orderkey) AS rn,
       count(*) OVER (CLUSTER BY o_custkey) AS per_customer
FROM orders""", oracle="""
SELECT o_orderkey, o_custkey,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS rn,
       count(*) OVER (PARTITION BY o_custkey) AS per_customer
FROM orders""", group="windows")


@query("window_running_hot", oracle="""
SELECT l_orderkey, l_linenumber, l_returnflag,
       row_number() OVER w AS rn, sum(l_quantity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total,
       lag(l_partkey) OVER w AS before
FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey)""")
def q_window_running_hot(spark, sf_dir):
    """Running window over three keys, each a large part of the table: no task holds a key (two-level prefix scan)."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_partkey", "l_shipdate")
    out = running(li, ["l_returnflag"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"],
                  row_number="rn", sums={"total": "l_quantity"}, lags={"before": "l_partkey"})
    return out.select("l_orderkey", "l_linenumber", "l_returnflag", "rn", "total", "before")
