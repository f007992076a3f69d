"""Generators and user-defined functions (survey 2.J1-J4).

UDFs are Arrow-batched pandas UDFs.  The aggregate UDF runs through
``two_level_agg``: a key with more rows than a group may hold is split into
salted sub-groups, and the partial results are merged with a built-in
``sum``.  A customer holding a large share of the orders is therefore still
split over many tasks.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf, udtf

from lakeshard.operators.script import two_level_agg
from lakeshard.plans.registry import query, sql_query
from lakeshard.sources.tables import Tables, ensure_parallelism, register_views

sql_query("lateral_view", """
SELECT c_custkey, pos, part FROM customer LATERAL VIEW posexplode(split(c_name, '#')) t AS pos, part""",
          oracle="""
SELECT c_custkey, CAST(i - 1 AS INTEGER) AS pos, string_split(c_name, '#')[i] AS part
FROM (SELECT c_custkey, c_name, generate_subscripts(string_split(c_name, '#'), 1) AS i FROM customer)""",
          group="generators")

sql_query("lateral_view_outer", """
SELECT c_custkey, part FROM customer
LATERAL VIEW OUTER explode(filter(split(c_name, ''), x -> x = '7')) t AS part""", oracle="""
SELECT c.c_custkey, t.part FROM customer c
LEFT JOIN LATERAL (SELECT unnest(list_filter(string_split(c.c_name, ''), lambda x: x = '7')) AS part) t ON true""",
          group="generators")


@query("explode_tokens", oracle="""
SELECT conv_id, turn, word FROM (
  SELECT conv_id, turn, unnest(string_split(lower(text), ' ')) AS word FROM conversations WHERE role = 'user')
WHERE word <> ''""")
def q_explode_tokens(spark, sf_dir):
    c = Tables(spark, sf_dir).conversations.where(F.col("role") == "user")
    return (c.select("conv_id", "turn", F.explode(F.split(F.lower("text"), " ")).alias("word"))
            .where(F.col("word") != ""))


@pandas_udf(T.IntegerType())
def name_len(s: pd.Series) -> pd.Series:
    return s.str.len().astype("int32")


@query("udf_scalar", oracle="""
SELECT c_custkey, CAST(length(c_name) AS INTEGER) AS n_len,
       CAST(length(c_mktsegment) AS INTEGER) AS seg_len FROM customer""")
def q_udf_scalar(spark, sf_dir):
    register_views(spark, sf_dir, ["customer"])
    spark.udf.register("name_len", name_len)
    return spark.sql("SELECT c_custkey, name_len(c_name) AS n_len, name_len(c_mktsegment) AS seg_len FROM customer")


@pandas_udf(T.DoubleType())
def sum_squares(v: pd.Series) -> float:
    return float((v * v).sum())


@pandas_udf(T.LongType())
def n_rows(v: pd.Series) -> int:
    return len(v)


@query("udaf_pandas", oracle="""
SELECT o_custkey, round(sum(o_totalprice * o_totalprice) / 1e6, 2) AS sq_millions, count(*) AS n
FROM orders GROUP BY o_custkey""")
def q_udaf_pandas(spark, sf_dir):
    """Grouped-aggregate pandas UDF over (customer, salt) parts, merged by ``sum``."""
    o = Tables(spark, sf_dir).orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return two_level_agg(
        o, ["o_custkey"],
        partial=[sum_squares("o_totalprice").alias("_sq"), n_rows("o_totalprice").alias("_n")],
        final=[F.round(F.sum("_sq") / 1e6, 2).alias("sq_millions"), F.sum("_n").alias("n")])


@udtf(returnType=T.StructType([T.StructField("pos", T.IntegerType()),
                                  T.StructField("part", T.StringType())]), useArrow=False)
class NameParts:
    """Few short rows a call: pickled batches; the Arrow form builds a record batch for every input row."""

    def eval(self, name: str):
        for i, p in enumerate((name or "").split("#")):
            yield i, p


@query("udtf", oracle="""
SELECT c_custkey, CAST(i - 1 AS INTEGER) AS pos, string_split(c_name, '#')[i] AS part
FROM (SELECT c_custkey, c_name, generate_subscripts(string_split(c_name, '#'), 1) AS i FROM customer)""")
def q_udtf(spark, sf_dir):
    ensure_parallelism(Tables(spark, sf_dir).customer).createOrReplaceTempView("customer")
    spark.udtf.register("name_parts", NameParts)
    return spark.sql("SELECT c.c_custkey, t.pos, t.part FROM customer c, LATERAL name_parts(c.c_name) t")
