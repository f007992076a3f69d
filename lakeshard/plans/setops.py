"""Set operations (survey 2.H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshard.plans.registry import query, sql_query
from lakeshard.sources.tables import Tables

# Customer nation keys vs supplier nation keys, and two order subsets.
_C = "SELECT c_nationkey AS nk FROM customer WHERE c_acctbal > 5000"
_S = "SELECT s_nationkey AS nk FROM supplier"


def _c(t):
    return t.customer.where(F.col("c_acctbal") > 5000).select(F.col("c_nationkey").alias("nk"))


def _s(t):
    return t.supplier.select(F.col("s_nationkey").alias("nk"))


@query("union_all", oracle=f"{_C} UNION ALL {_S}")
def q_union_all(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _c(t).unionAll(_s(t))


@query("union_distinct", oracle=f"{_C} UNION {_S}")
def q_union_distinct(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _c(t).union(_s(t)).distinct()


@query("union_by_name", oracle="""
SELECT c_custkey AS id, c_name AS name, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey AS id, s_name AS name, 'supplier' AS kind FROM supplier""")
def q_union_by_name(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = t.customer.select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"),
                          F.col("c_custkey").alias("id"))
    s = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                          F.lit("supplier").alias("kind"))
    return c.unionByName(s)


@query("intersect", oracle=f"{_C} INTERSECT {_S}")
def q_intersect(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _c(t).intersect(_s(t))


@query("intersect_all", oracle=f"{_C} INTERSECT ALL {_S}")
def q_intersect_all(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _c(t).intersectAll(_s(t))


@query("except_distinct", oracle=f"{_C} EXCEPT {_S} WHERE s_nationkey < 20")
def q_except_distinct(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _c(t).subtract(_s(t).where("nk < 20"))


@query("except_all", oracle=f"{_C} EXCEPT ALL {_S}")
def q_except_all(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _c(t).exceptAll(_s(t))


sql_query("setop_precedence", f"""
{_S} WHERE s_nationkey < 5 UNION ALL {_C} INTERSECT {_S} WHERE s_nationkey > 20""", oracle=f"""
{_S} WHERE s_nationkey < 5 UNION ALL ({_C} INTERSECT {_S} WHERE s_nationkey > 20)""", group="setops")

sql_query("minus", f"{_C} MINUS {_S} WHERE s_nationkey > 3", oracle=f"{_C} EXCEPT {_S} WHERE s_nationkey > 3", group="setops")
