"""Joins (survey 2.D).

Broadcast is only requested for the fixed-size dimension tables (``nation``
has 25 rows, ``region`` 5, at every scale factor); everything else is left to
Catalyst and AQE, which switch a shuffle join to broadcast only after
measuring the build side at run time.  A bare CROSS JOIN is not shipped:
the comma-list syntax is covered with its join predicate in WHERE.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshard.operators.intervals import overlap_join
from lakeshard.operators.joins import band_join, not_in
from lakeshard.plans.registry import query, sql_query
from lakeshard.sources.tables import Tables


@query("join_inner", oracle="""
SELECT o.o_orderkey, c.c_name, c.c_mktsegment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def q_join_inner(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o, c = t.orders, t.customer
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select("o_orderkey", "c_name", "c_mktsegment")


sql_query("join_comma", """
SELECT n.n_name, r.r_name FROM nation n, region r WHERE n.n_regionkey = r.r_regionkey""",
          oracle="same", group="joins")


@query("join_left", oracle="""
SELECT c.c_custkey, o.o_orderkey FROM customer c LEFT JOIN orders o
  ON c.c_custkey = o.o_custkey AND o.o_orderstatus = 'P'""")
def q_join_left(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c, o = t.customer, t.orders.where(F.col("o_orderstatus") == "P")
    return c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "o_orderkey")


@query("join_right", oracle="""
SELECT o.o_orderkey, c.c_custkey FROM orders o RIGHT JOIN customer c
  ON c.c_custkey = o.o_custkey AND o.o_totalprice > 250000""")
def q_join_right(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o, c = t.orders.where(F.col("o_totalprice") > 250000), t.customer
    return o.join(c, c.c_custkey == o.o_custkey, "right").select("o_orderkey", "c_custkey")


@query("join_full", oracle="""
SELECT c.c_custkey, b.o_custkey, b.n_big, coalesce(c.c_custkey, b.o_custkey) AS custkey
FROM (SELECT * FROM customer WHERE c_acctbal > 9000) c
FULL OUTER JOIN (SELECT o_custkey, count(*) AS n_big FROM orders WHERE o_totalprice > 300000 GROUP BY o_custkey) b
  ON c.c_custkey = b.o_custkey""")
def q_join_full(spark, sf_dir):
    """Rich customers vs customers with big orders; the key is unique on both sides."""
    t = Tables(spark, sf_dir)
    c = t.customer.where(F.col("c_acctbal") > 9000)
    b = (t.orders.where(F.col("o_totalprice") > 300000)
         .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_big")))
    j = c.join(b, c.c_custkey == b.o_custkey, "full")
    return j.select("c_custkey", "o_custkey", "n_big", F.coalesce("c_custkey", "o_custkey").alias("custkey"))


@query("join_semi", oracle="""
SELECT * FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)""")
def q_join_semi(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.where(F.col("l_quantity") > 49)
    p = t.part
    return p.join(li, p.p_partkey == li.l_partkey, "left_semi")


@query("join_anti", oracle="""
SELECT * FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 250000)""")
def q_join_anti(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c, o = t.customer, t.orders.where(F.col("o_totalprice") > 250000)
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti")


@query("join_using", oracle="""
SELECT n_nationkey, n_name, c_custkey FROM nation JOIN
  (SELECT c_custkey, c_nationkey AS n_nationkey FROM customer) c USING (n_nationkey)""")
def q_join_using(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return t.nation.join(c, ["n_nationkey"]).select("n_nationkey", "n_name", "c_custkey")


sql_query("join_natural", """
SELECT n_nationkey, n_name, s_suppkey FROM nation NATURAL JOIN
  (SELECT s_suppkey, s_nationkey AS n_nationkey FROM supplier) s""", oracle="same", group="joins")


@query("join_range", oracle="""
SELECT a.o_orderkey AS first_key, b.o_orderkey AS later_key FROM orders a JOIN orders b
  ON a.o_custkey = b.o_custkey AND b.o_orderdate BETWEEN a.o_orderdate AND a.o_orderdate + INTERVAL 30 DAYS
     AND a.o_orderkey <> b.o_orderkey""")
def q_join_range(spark, sf_dir):
    """Orders of one customer within 30 days of each other: the customer and
    a 30-day bin are the join key, so candidates, and the answer, grow with the table."""
    o = Tables(spark, sf_dir).orders.withColumn("day", F.datediff("o_orderdate", F.lit("1970-01-01").cast("date")))
    a = o.select(F.col("o_orderkey").alias("first_key"), F.col("o_custkey").alias("c1"), F.col("day").alias("d1"))
    b = o.select(F.col("o_orderkey").alias("later_key"), F.col("o_custkey").alias("c2"), F.col("day").alias("d2"))
    return (band_join(b, a, "d2", "d1", 0, 30, on=[("c2", "c1")]).where("first_key <> later_key")
            .select("first_key", "later_key"))


@query("join_overlap", oracle="""
SELECT o_orderkey, l_orderkey, l_linenumber FROM orders JOIN lineitem
  ON o_orderkey <= l_orderkey + 1 AND l_orderkey - 2 <= o_orderkey + 3 WHERE l_quantity >= 49""")
def q_join_overlap(spark, sf_dir):
    """Overlap of two intervals without any equality: bins cut from the data make it an equi-join."""
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", F.col("o_orderkey").alias("a"), (F.col("o_orderkey") + 3).alias("b"))
    li = (t.lineitem.where("l_quantity >= 49")
          .select("l_orderkey", "l_linenumber", (F.col("l_orderkey") - 2).alias("c"), (F.col("l_orderkey") + 1).alias("d")))
    return overlap_join(o, li, ("a", "b"), ("c", "d")).select("o_orderkey", "l_orderkey", "l_linenumber")


sql_query("join_lateral", """
SELECT c.c_custkey, x.n, x.total FROM customer c,
  LATERAL (SELECT count(*) AS n, round(coalesce(sum(o.o_totalprice), 0), 2) AS total
           FROM orders o WHERE o.o_custkey = c.c_custkey) x""", oracle="same", group="joins")

@query("not_in", oracle="""
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def q_not_in(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return not_in(t.customer, "c_custkey", t.orders.where("o_orderstatus = 'F'"), "o_custkey").select("c_custkey")


@query("join_hint_broadcast", oracle="""
SELECT c.c_custkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_join_hint_broadcast(spark, sf_dir):
    """``nation`` is a fixed 25-row dimension: a proven-small broadcast side."""
    t = Tables(spark, sf_dir)
    c, n = t.customer, t.nation
    return c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")


sql_query("join_hint_merge", """
SELECT /*+ MERGE(o) */ o.o_orderkey, l.l_linenumber FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE l.l_returnflag = 'R'""", oracle="""
SELECT o.o_orderkey, l.l_linenumber FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE l.l_returnflag = 'R'""", group="joins")

sql_query("join_hint_shuffle_hash", """
SELECT /*+ SHUFFLE_HASH(c) */ o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
          oracle="""
SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""", group="joins")
