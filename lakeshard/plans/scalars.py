"""Scalar expressions with their own syntax (survey 2.I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshard.plans.registry import query, sql_query
from lakeshard.sources.tables import Tables

sql_query("arithmetic", """
SELECT l_orderkey, l_linenumber, l_quantity + 1 AS a, l_quantity - l_discount AS b, l_quantity * 2 AS c,
       l_quantity / 4 AS d, l_linenumber % 3 AS m, l_orderkey DIV 7 AS q, -l_linenumber AS neg,
       +l_linenumber AS pos FROM lineitem""", oracle="""
SELECT l_orderkey, l_linenumber, l_quantity + 1 AS a, l_quantity - l_discount AS b, l_quantity * 2 AS c,
       l_quantity / 4 AS d, l_linenumber % 3 AS m, l_orderkey // 7 AS q, -l_linenumber AS neg,
       +l_linenumber AS pos FROM lineitem""", group="scalars")

sql_query("bitwise", """
SELECT o_orderkey, o_orderkey & 255 AS b_and, o_orderkey | 1024 AS b_or, o_orderkey ^ 4095 AS b_xor,
       ~o_orderkey AS b_not, shiftleft(o_orderkey, 2) AS shl FROM orders""", oracle="""
SELECT o_orderkey, o_orderkey & 255 AS b_and, o_orderkey | 1024 AS b_or, xor(o_orderkey, 4095) AS b_xor,
       ~o_orderkey AS b_not, o_orderkey << 2 AS shl FROM orders""", group="scalars")


@query("concat_pipe", oracle="""
SELECT c_custkey, c_name || '-' || c_mktsegment AS label, concat(c_mktsegment, '/', c_nationkey) AS seg_nation
FROM customer""")
def q_concat_pipe(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_custkey", F.concat("c_name", F.lit("-"), "c_mktsegment").alias("label"),
                    F.concat("c_mktsegment", F.lit("/"), F.col("c_nationkey").cast("string")).alias("seg_nation"))


sql_query("string_syntax", """
SELECT c_custkey, SUBSTRING(c_name FROM 3 FOR 5) AS sub, TRIM(BOTH 'C' FROM c_name) AS tb,
       TRIM(LEADING 'Cus' FROM c_name) AS tl, TRIM(TRAILING '0123456789' FROM c_name) AS tt,
       OVERLAY(c_name PLACING 'XX' FROM 2 FOR 3) AS ov, POSITION('#' IN c_name) AS pos,
       upper(c_mktsegment) AS up, lpad(CAST(c_nationkey AS STRING), 3, '0') AS padded
FROM customer""", oracle="""
SELECT c_custkey, substring(c_name, 3, 5) AS sub, trim(c_name, 'C') AS tb,
       ltrim(c_name, 'Cus') AS tl, rtrim(c_name, '0123456789') AS tt,
       substring(c_name, 1, 1) || 'XX' || substring(c_name, 5) AS ov, CAST(position('#' IN c_name) AS INTEGER) AS pos,
       upper(c_mktsegment) AS up, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS padded
FROM customer""", group="scalars")

sql_query("date_parts", """
SELECT event_id, EXTRACT(YEAR FROM ts) AS y, EXTRACT(MONTH FROM ts) AS mo, EXTRACT(DAY FROM ts) AS d,
       EXTRACT(HOUR FROM ts) AS h, quarter(ts) AS q, dayofweek(ts) AS dow, to_date(ts) AS day
FROM events""", oracle="""
SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS mo, CAST(day(ts) AS INTEGER) AS d,
       CAST(hour(ts) AS INTEGER) AS h, CAST(quarter(ts) AS INTEGER) AS q, CAST(dayofweek(ts) + 1 AS INTEGER) AS dow,
       CAST(ts AS DATE) AS day
FROM events""", group="scalars")

sql_query("interval_arithmetic", """
SELECT o_orderkey, o_orderdate + INTERVAL 30 DAYS AS due, o_orderdate - INTERVAL '12' HOUR AS before,
       datediff(TIMESTAMP_NTZ '2002-01-01 00:00:00', o_orderdate) AS days_left,
       CAST(months_between(TIMESTAMP_NTZ '2002-01-01 00:00:00', o_orderdate) AS INT) AS months_left_approx,
       add_months(CAST(o_orderdate AS DATE), 2) AS plus2m
FROM orders""", oracle="""
SELECT o_orderkey, o_orderdate + INTERVAL 30 DAYS AS due, o_orderdate - INTERVAL 12 HOUR AS before,
       CAST(date_diff('day', o_orderdate, TIMESTAMP '2002-01-01 00:00:00') AS INTEGER) AS days_left,
       CAST(trunc(
         (date_diff('month', o_orderdate, TIMESTAMP '2002-01-01')
          - CASE WHEN day(o_orderdate) > 1 THEN 1 ELSE 0 END
          + CASE WHEN day(o_orderdate) > 1 THEN (32 - day(o_orderdate)) / 31.0 ELSE 0 END)
         ) AS INTEGER) AS months_left_approx,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 2 MONTH AS DATE) AS plus2m
FROM orders""", group="scalars")


@query("struct_access", oracle="""
SELECT c_custkey, {'k': c_custkey, 'n': c_name}.n AS n, {'seg': c_mktsegment, 'nat': c_nationkey}.nat AS nat
FROM customer""")
def q_struct_access(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    s = F.struct(F.col("c_custkey").alias("k"), F.col("c_name").alias("n"))
    s2 = F.named_struct(F.lit("seg"), F.col("c_mktsegment"), F.lit("nat"), F.col("c_nationkey"))
    return c.select("c_custkey", s.getField("n").alias("n"), s2["nat"].alias("nat"))


sql_query("array_map_subscript", """
SELECT c_custkey, split(c_name, '#')[1] AS num, map('nation', c_nationkey, 'key', c_custkey)['nation'] AS nat,
       element_at(split(c_name, '#'), 1) AS prefix, size(split(c_name, '#')) AS parts
FROM customer""", oracle="""
SELECT c_custkey, string_split(c_name, '#')[2] AS num, CAST(c_nationkey AS BIGINT) AS nat,
       string_split(c_name, '#')[1] AS prefix, CAST(len(string_split(c_name, '#')) AS INTEGER) AS parts
FROM customer""", group="scalars")

sql_query("higher_order", """
SELECT c_custkey, transform(split(c_name, '#'), x -> length(x)) AS lens,
       filter(split(c_name, ''), x -> x = '0') AS zeros,
       aggregate(split(c_name, '#'), 0, (acc, x) -> acc + length(x)) AS total_len,
       exists(split(c_name, '#'), x -> x = 'Customer') AS has_prefix
FROM customer""", oracle="""
SELECT c_custkey, list_transform(string_split(c_name, '#'), lambda x: CAST(length(x) AS INTEGER)) AS lens,
       list_filter(string_split(c_name, ''), lambda x: x = '0') AS zeros,
       CAST(list_sum(list_transform(string_split(c_name, '#'), lambda x: length(x))) AS INTEGER) AS total_len,
       list_bool_or(list_transform(string_split(c_name, '#'), lambda x: x = 'Customer')) AS has_prefix
FROM customer""", group="scalars")

sql_query("literals", """
SELECT r_regionkey, 10L AS l, 5S AS s, 2Y AS y, 1.5D AS d, 2.25BD AS bd, 1e2 AS e, 'a' 'b' AS cat,
       DATE '2024-02-29' AS dt, TIMESTAMP_NTZ '2024-01-01 10:00:00' AS ts, NULL AS nothing, true AS yes
FROM region""", oracle="""
SELECT r_regionkey, CAST(10 AS BIGINT) AS l, CAST(5 AS SMALLINT) AS s, CAST(2 AS TINYINT) AS y,
       CAST(1.5 AS DOUBLE) AS d, CAST(2.25 AS DECIMAL(3,2)) AS bd, CAST(100 AS DOUBLE) AS e, 'ab' AS cat,
       DATE '2024-02-29' AS dt, TIMESTAMP '2024-01-01 10:00:00' AS ts, NULL AS nothing, true AS yes
FROM region""", group="scalars")


@query("json_extract", oracle="""
SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def q_json_extract(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return e.select("event_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))


sql_query("json_from_json", """
SELECT event_id, from_json(props, 'k INT').k AS k, json_tuple_k FROM events
LATERAL VIEW json_tuple(props, 'k') jt AS json_tuple_k""", oracle="""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$.k') AS json_tuple_k FROM events""", group="scalars")

sql_query("current_context", """
SELECT r_regionkey, current_date() AS today, current_timestamp() AS now, current_user() AS who
FROM region""", oracle=None, group="scalars")


sql_query("current_is_constant", """
SELECT o_orderstatus, count(*) AS n, count(DISTINCT current_date()) AS days, count(DISTINCT current_timestamp()) AS moments,
       count(DISTINCT current_user()) AS users, bool_and(CAST(current_timestamp() AS DATE) = current_date()) AS agree
FROM orders GROUP BY o_orderstatus""", oracle="""
SELECT o_orderstatus, count(*) AS n, 1::BIGINT AS days, 1::BIGINT AS moments, 1::BIGINT AS users, true AS agree
FROM orders GROUP BY o_orderstatus""", group="scalars")

sql_query("literal_suffixes", """
SELECT o_orderkey, CAST(1.5F AS DOUBLE) AS f, 2.25D AS d, 7L AS l, CAST(3S AS INT) AS s, CAST(4Y AS INT) AS y,
       CAST(DATE '2024-01-31' + INTERVAL '1' MONTH AS DATE) AS next_month FROM orders""", oracle="""
SELECT o_orderkey, 1.5::DOUBLE AS f, 2.25::DOUBLE AS d, 7::BIGINT AS l, 3::INTEGER AS s, 4::INTEGER AS y,
       DATE '2024-02-29' AS next_month FROM orders""", group="scalars")
