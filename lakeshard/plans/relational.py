"""Projections, filters and predicates (survey 2.C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshard.plans.registry import query, sql_query
from lakeshard.sources.tables import Tables


@query("project_alias", oracle="""
SELECT l_orderkey AS order_key, l_linenumber AS line,
       l_extendedprice * (1 - l_discount) AS net_price, l_quantity AS qty FROM lineitem""")
def q_project_alias(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.select(F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line"),
                     (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price"),
                     F.col("l_quantity").alias("qty"))


@query("star", oracle="""
SELECT n.*, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_star(spark, sf_dir):
    t = Tables(spark, sf_dir)
    n, r = t.nation.alias("n"), t.region.alias("r")
    return n.join(r, F.col("n.n_regionkey") == F.col("r.r_regionkey")).select("n.*", "r.r_name")


@query("select_distinct", oracle="SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def q_select_distinct(spark, sf_dir):
    return Tables(spark, sf_dir).customer.select("c_mktsegment", "c_nationkey").distinct()


@query("filter_logic", oracle="""
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE (o_orderstatus = 'F' AND o_totalprice > 200000) OR NOT (o_orderpriority <> '1-URGENT')""")
def q_filter_logic(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return (o.where(((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 200000))
                    | ~(F.col("o_orderpriority") != "1-URGENT"))
            .select("o_orderkey", "o_orderstatus", "o_totalprice"))


@query("comparisons", oracle="""
SELECT p_partkey, p_size = 10 AS eq, p_size <> 10 AS ne, p_size < 10 AS lt, p_size <= 10 AS le,
       p_size > 40 AS gt, p_size >= 40 AS ge, NOT (p_size > 25) AS not_gt FROM part""")
def q_comparisons(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    s = F.col("p_size")
    return p.select("p_partkey", (s == 10).alias("eq"), (s != 10).alias("ne"), (s < 10).alias("lt"),
                    (s <= 10).alias("le"), (s > 40).alias("gt"), (s >= 40).alias("ge"),
                    (~(s > 25)).alias("not_gt"))


# Customers without orders give NULL order columns: the null-safe cases.
_NULLS = "customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey"

sql_query("null_safe_eq", f"""
SELECT c.c_custkey, o.o_orderkey, o.o_orderstatus <=> 'F' AS ns_eq, o.o_orderstatus = 'F' AS plain_eq
FROM {_NULLS}""", oracle=f"""
SELECT c.c_custkey, o.o_orderkey, o.o_orderstatus IS NOT DISTINCT FROM 'F' AS ns_eq,
       o.o_orderstatus = 'F' AS plain_eq FROM {_NULLS}""", group="relational")


@query("between", oracle="""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_quantity BETWEEN 10 AND 12 AND l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-03-31'""")
def q_between(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    d = lambda s: F.lit(s).cast("timestamp_ntz")
    return (li.where(F.col("l_quantity").between(10, 12)
                     & F.col("l_shipdate").between(d("1996-01-01"), d("1996-03-31")))
            .select("l_orderkey", "l_linenumber", "l_quantity"))


@query("in_list", oracle="""
SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
  AND c_nationkey NOT IN (1, 2, 3)""")
def q_in_list(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return (c.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & ~F.col("c_nationkey").isin(1, 2, 3))
            .select("c_custkey", "c_mktsegment"))


@query("in_subquery", oracle="""
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE')""")
def q_in_subquery(spark, sf_dir):
    t = Tables(spark, sf_dir)
    auto = t.customer.where(F.col("c_mktsegment") == "AUTOMOBILE").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.join(auto, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query("rlike", oracle="""
SELECT p_partkey, p_brand FROM part WHERE regexp_matches(p_brand, '^Brand#1[0-9]$')""")
def q_rlike(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return p.where(F.col("p_brand").rlike("^Brand#1[0-9]$")).select("p_partkey", "p_brand")


sql_query("like_any_all", """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_mktsegment LIKE ANY ('BUILD%', '%TURE') AND c_name LIKE ALL ('Customer%', '%1%')
  AND c_name NOT LIKE 'Customer#0000000%' AND (c_mktsegment LIKE 'B!_%' ESCAPE '!') IS NOT TRUE""",
          oracle="""
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE (c_mktsegment LIKE 'BUILD%' OR c_mktsegment LIKE '%TURE') AND (c_name LIKE 'Customer%' AND c_name LIKE '%1%')
  AND c_name NOT LIKE 'Customer#0000000%' AND NOT coalesce(c_mktsegment LIKE 'B!_%' ESCAPE '!', false)""",
          group="relational")

sql_query("is_predicates", f"""
SELECT c.c_custkey, o.o_orderkey, o.o_orderkey IS NULL AS is_null, o.o_orderkey IS NOT NULL AS not_null,
       (o.o_totalprice > 100000) IS TRUE AS is_true, (o.o_totalprice > 100000) IS FALSE AS is_false,
       (o.o_totalprice > 100000) IS UNKNOWN AS is_unknown FROM {_NULLS}""", oracle=f"""
SELECT c.c_custkey, o.o_orderkey, o.o_orderkey IS NULL AS is_null, o.o_orderkey IS NOT NULL AS not_null,
       coalesce(o.o_totalprice > 100000, false) AS is_true, coalesce(NOT (o.o_totalprice > 100000), false) AS is_false,
       (o.o_totalprice > 100000) IS NULL AS is_unknown FROM {_NULLS}""", group="relational")

sql_query("is_distinct_from", f"""
SELECT c.c_custkey, o.o_orderkey, o.o_orderpriority IS DISTINCT FROM '1-URGENT' AS dist,
       o.o_orderpriority IS NOT DISTINCT FROM '1-URGENT' AS not_dist FROM {_NULLS}""", oracle="same",
          group="relational")


@query("exists_correlated", oracle="""
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 300000)""")
def q_exists_correlated(spark, sf_dir):
    t = Tables(spark, sf_dir)
    big = t.orders.where(F.col("o_totalprice") > 300000).select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(big, "c_custkey", "left_semi").select("c_custkey", "c_name")


sql_query("scalar_subquery", """
SELECT c_custkey, c_acctbal, c_acctbal - (SELECT avg(c_acctbal) FROM customer) > 0 AS above_avg,
       (SELECT count(*) FROM orders o WHERE o.o_custkey = c.c_custkey) AS n_orders
FROM customer c""", oracle="same", group="relational")


@query("cte", oracle="""
WITH rev (o_custkey, revenue) AS (
  SELECT o_custkey, round(sum(o_totalprice), 2) FROM orders GROUP BY o_custkey),
top AS (SELECT * FROM rev WHERE revenue > 1000000)
SELECT c.c_custkey, c.c_name, top.revenue FROM customer c JOIN top ON c.c_custkey = top.o_custkey""")
def q_cte(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rev = t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    top = rev.where(F.col("revenue") > 1000000)
    c = t.customer
    return (c.join(top, c.c_custkey == top.o_custkey)
            .select("c_custkey", "c_name", "revenue"))


sql_query("derived_table", """
SELECT seg, n, avg_bal FROM (
  SELECT c_mktsegment AS seg, count(*) AS n, round(avg(c_acctbal), 4) AS avg_bal
  FROM (SELECT * FROM customer WHERE c_acctbal > 0) pos GROUP BY c_mktsegment) agg
WHERE n > 10""", oracle="same", group="relational")


@query("case_when", oracle="""
SELECT o_orderkey,
       CASE WHEN o_totalprice > 300000 THEN 'large' WHEN o_totalprice > 100000 THEN 'medium' ELSE 'small' END AS size,
       CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'other' END AS status
FROM orders""")
def q_case_when(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    p = F.col("o_totalprice")
    s = F.col("o_orderstatus")
    return o.select("o_orderkey",
                    F.when(p > 300000, "large").when(p > 100000, "medium").otherwise("small").alias("size"),
                    F.when(s == "F", "finished").when(s == "O", "open").otherwise("other").alias("status"))


sql_query("try_cast", """
SELECT c_custkey, TRY_CAST(substring(c_name, 10) AS INT) AS name_num,
       TRY_CAST(c_mktsegment AS INT) AS seg_num, CAST(c_acctbal AS BIGINT) AS bal_int
FROM customer""", oracle="""
SELECT c_custkey, TRY_CAST(substring(c_name, 10) AS INT) AS name_num,
       TRY_CAST(c_mktsegment AS INT) AS seg_num, CAST(CASE WHEN c_acctbal < 0 THEN ceil(c_acctbal) ELSE floor(c_acctbal) END AS BIGINT) AS bal_int
FROM customer""", group="relational")


sql_query("multi_alias", """
SELECT c_custkey, stack(2, 'balance', c_acctbal, 'nation', CAST(c_nationkey AS DOUBLE)) AS (metric, value)
FROM customer""", oracle="""
SELECT c_custkey, 'balance' AS metric, c_acctbal AS value FROM customer
UNION ALL SELECT c_custkey, 'nation' AS metric, CAST(c_nationkey AS DOUBLE) AS value FROM customer""",
          group="relational")

sql_query("select_all_distinct_agg", """
SELECT ALL c_mktsegment, count(DISTINCT c_nationkey) AS nations, count(ALL c_custkey) AS customers
FROM customer GROUP BY c_mktsegment""", oracle="""
SELECT c_mktsegment, count(DISTINCT c_nationkey) AS nations, count(c_custkey) AS customers
FROM customer GROUP BY c_mktsegment""", group="relational")


sql_query("compare_not_greater", """
SELECT o_orderkey FROM orders WHERE o_totalprice !> 50000 OR o_orderkey !< 59000""", oracle="""
SELECT o_orderkey FROM orders WHERE o_totalprice <= 50000 OR o_orderkey >= 59000""", group="relational")
