"""Sort, limit and distribution (survey 2.G).

``LIMIT`` appears only where it is the feature (top-k); global sorts use a
range exchange, top-k uses ``TakeOrderedAndProject`` (a bounded heap per
partition), and top-k per group filters a ``row_number`` window.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeshard.plans.registry import query, sql_query
from lakeshard.sources.tables import Tables


@query("order_nulls", oracle="""
SELECT c.c_custkey, o.o_orderkey FROM customer c LEFT JOIN orders o
  ON c.c_custkey = o.o_custkey AND o.o_totalprice > 350000
ORDER BY o.o_orderkey ASC NULLS LAST, c.c_custkey DESC""")
def q_order_nulls(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c, o = t.customer, t.orders.where(F.col("o_totalprice") > 350000)
    return (c.join(o, c.c_custkey == o.o_custkey, "left")
            .select("c_custkey", "o_orderkey")
            .orderBy(F.col("o_orderkey").asc_nulls_last(), F.col("c_custkey").desc()))


@query("top_k", oracle="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def q_top_k(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query("top_k_per_group", oracle="""
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
  FROM orders) WHERE rn <= 3""")
def q_top_k_per_group(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    return (o.select("o_custkey", "o_orderkey", "o_totalprice", F.row_number().over(w).alias("rn"))
            .where("rn <= 3").drop("rn"))


sql_query("sort_by", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem SORT BY l_orderkey, l_linenumber""",
          oracle="SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem", group="ordering")

sql_query("distribute_by", """
SELECT l_orderkey, l_suppkey, l_quantity FROM lineitem DISTRIBUTE BY l_suppkey""",
          oracle="SELECT l_orderkey, l_suppkey, l_quantity FROM lineitem", group="ordering")

sql_query("cluster_by", """
SELECT o_custkey, o_orderkey FROM orders CLUSTER BY o_custkey""",
          oracle="SELECT o_custkey, o_orderkey FROM orders", group="ordering")


@query("global_sort", oracle="""
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber""")
def q_global_sort(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber", "l_shipdate").orderBy("l_shipdate", "l_orderkey", "l_linenumber")
