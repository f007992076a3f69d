"""Scans, sources and sinks declared by the SQL grammar (survey 2.B).

Statements that write go to fresh folders below the session's checkpoint
location; each query returns what it wrote, read back through the catalog
or the path, so the oracle is the SELECT that produced it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakeshard.plans.registry import query, sql_query
from lakeshard.session import scratch_dir
from lakeshard.sources.tables import Tables, register_views, table_path


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


@query("scan_alias", oracle="SELECT k, name, rk FROM nation AS n(k, name, rk)")
def q_scan_alias(spark, sf_dir):
    return Tables(spark, sf_dir).nation.toDF("k", "name", "rk")


sql_query("scan_alias_sql", "SELECT n.k, n.name FROM nation AS n(k, name, rk) WHERE n.rk = 1",
          oracle="same", group="storage")

sql_query("table_stmt", "TABLE region", oracle="SELECT * FROM region", group="storage")

sql_query("inline_values", """
SELECT v.code, count(*) AS n FROM customer c
JOIN (VALUES ('BUILDING', 'B'), ('MACHINERY', 'M'), ('AUTOMOBILE', 'A')) AS v(seg, code)
  ON c.c_mktsegment = v.seg GROUP BY v.code""", oracle="same", group="storage")

sql_query("tvf_range", """
SELECT r.id AS line, count(l.l_orderkey) AS n FROM range(1, 9) r
LEFT JOIN lineitem l ON l.l_linenumber = r.id GROUP BY r.id""", oracle="""
SELECT r.id AS line, count(l.l_orderkey) AS n FROM range(1, 9) r(id)
LEFT JOIN lineitem l ON l.l_linenumber = r.id GROUP BY r.id""", group="storage")


@query("scan_using_parquet", oracle="SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def q_scan_using_parquet(spark, sf_dir):
    v = _name("orders_src")
    spark.sql(f"CREATE TEMPORARY VIEW {v} USING parquet OPTIONS (path '{table_path(sf_dir, 'orders')}')")
    return spark.sql(f"SELECT o_orderkey, o_totalprice FROM {v} WHERE o_orderstatus = 'O'")


@query("ctas_partitioned", oracle="""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_totalprice > 100000""")
def q_ctas_partitioned(spark, sf_dir):
    register_views(spark, sf_dir, ["orders"])
    t = _name("ctas_p")
    loc = scratch_dir(spark, t)
    spark.sql(f"""CREATE TABLE {t} USING parquet PARTITIONED BY (o_orderstatus) LOCATION '{loc}'
                  AS SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders
                  WHERE o_totalprice > 100000""")
    return spark.table(t)


@query("ctas_bucketed", oracle="""
SELECT o.o_orderkey, count(*) AS n_lines FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_orderkey""")
def q_ctas_bucketed(spark, sf_dir):
    """Both sides bucketed by the join key into the same bucket count: the
    join reads co-located buckets and needs no exchange."""
    t = Tables(spark, sf_dir)
    o_t, l_t = _name("b_orders"), _name("b_lines")
    for df, name in ((t.orders.select("o_orderkey"), o_t),
                     (t.lineitem.select("l_orderkey", "l_linenumber"), l_t)):
        key = df.columns[0]
        (df.write.bucketBy(8, key).sortBy(key).format("parquet")
         .option("path", scratch_dir(spark, name)).saveAsTable(name))
    o, li = spark.table(o_t), spark.table(l_t)
    return (o.join(li, o.o_orderkey == li.l_orderkey)
            .groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n_lines")))


@query("partition_by_year", oracle="""
SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders""")
def q_partition_by_year(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate",
                                            F.year("o_orderdate").alias("o_year"))
    path = scratch_dir(spark, "by_year") + "/t"
    o.hint("rebalance", "o_year").write.partitionBy("o_year").parquet(path)
    return spark.read.parquet(path)


@query("csv_delimited_roundtrip", oracle="SELECT * FROM orders")
def q_csv_delimited_roundtrip(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    path = scratch_dir(spark, "csv") + "/orders"
    opts = {"sep": "|", "nullValue": "\\N", "escape": "\\", "header": "true",
            "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    o.write.options(**opts).csv(path)
    return spark.read.options(**opts).schema(o.schema).csv(path)


@query("orc_roundtrip", oracle="SELECT * FROM lineitem")
def q_orc_roundtrip(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    path = scratch_dir(spark, "orc") + "/lineitem"
    li.write.orc(path)
    return spark.read.orc(path)


@query("insert_append", oracle="""
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'""")
def q_insert_append(spark, sf_dir):
    register_views(spark, sf_dir, ["orders"])
    t = _name("ins")
    spark.sql(f"CREATE TABLE {t} (o_orderkey BIGINT, o_orderstatus STRING) USING parquet "
              f"LOCATION '{scratch_dir(spark, t)}'")
    spark.sql(f"INSERT INTO {t} SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
    spark.sql(f"INSERT INTO {t} (o_orderstatus, o_orderkey) "
              f"SELECT o_orderstatus, o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'")
    return spark.table(t)


@query("insert_overwrite_partition", oracle="""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       o_orderstatus FROM orders""")
def q_insert_overwrite_partition(spark, sf_dir):
    """Static ``INSERT OVERWRITE ... PARTITION``: the other partitions stay."""
    register_views(spark, sf_dir, ["orders"])
    t = _name("iop")
    spark.sql(f"CREATE TABLE {t} (o_orderkey BIGINT, o_totalprice DOUBLE, o_orderstatus STRING) "
              f"USING parquet PARTITIONED BY (o_orderstatus) LOCATION '{scratch_dir(spark, t)}'")
    spark.sql(f"INSERT INTO {t} SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
    spark.sql(f"INSERT OVERWRITE {t} PARTITION (o_orderstatus = 'F') "
              f"SELECT o_orderkey, o_totalprice * 2 FROM orders WHERE o_orderstatus = 'F'")
    return spark.table(t)


@query("write_directory", oracle="SELECT c_custkey, c_name FROM customer WHERE c_nationkey < 10")
def q_write_directory(spark, sf_dir):
    register_views(spark, sf_dir, ["customer"])
    path = scratch_dir(spark, "dir") + "/out"
    spark.sql(f"INSERT OVERWRITE DIRECTORY '{path}' USING parquet "
              f"SELECT c_custkey, c_name FROM customer WHERE c_nationkey < 10")
    return spark.read.parquet(path)


@query("multi_insert", oracle="""
SELECT 'small' AS bucket, o_orderkey FROM orders WHERE o_totalprice < 50000
UNION ALL SELECT 'large' AS bucket, o_orderkey FROM orders WHERE o_totalprice >= 300000""")
def q_multi_insert(spark, sf_dir):
    """One statement feeds two INSERTs; each reads its own columns with its own pushed filter."""
    register_views(spark, sf_dir, ["orders"])
    a, b = _name("mi_small"), _name("mi_large")
    for t in (a, b):
        spark.sql(f"CREATE TABLE {t} (o_orderkey BIGINT) USING parquet LOCATION '{scratch_dir(spark, t)}'")
    spark.sql(f"""FROM orders
                  INSERT INTO {a} SELECT o_orderkey WHERE o_totalprice < 50000
                  INSERT INTO {b} SELECT o_orderkey WHERE o_totalprice >= 300000""")
    return (spark.table(a).select(F.lit("small").alias("bucket"), "o_orderkey")
            .unionByName(spark.table(b).select(F.lit("large").alias("bucket"), "o_orderkey")))


sql_query("from_first", """
FROM orders SELECT o_orderkey, o_totalprice WHERE o_orderpriority = '2-HIGH'""", oracle="""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '2-HIGH'""", group="storage")


@query("load_append", oracle="SELECT * FROM supplier UNION ALL SELECT * FROM supplier")
def q_load_append(spark, sf_dir):
    """``LOAD DATA INPATH`` for data source tables: read the files, append them."""
    t = _name("load")
    s = Tables(spark, sf_dir).supplier
    s.write.format("parquet").option("path", scratch_dir(spark, t)).saveAsTable(t)
    spark.read.parquet(table_path(sf_dir, "supplier")).write.insertInto(t)
    return spark.table(t)


@query("repair_partitions", oracle="SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def q_repair_partitions(spark, sf_dir):
    """Files written under ``k=v`` folders, table declared over them, then
    ``MSCK REPAIR TABLE`` registers the partitions."""
    path = scratch_dir(spark, "repair")
    (Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderstatus")
     .write.partitionBy("o_orderstatus").parquet(path + "/t"))
    t = _name("rep")
    spark.sql(f"CREATE TABLE {t} (o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING) "
              f"USING parquet PARTITIONED BY (o_orderstatus) LOCATION '{path}/t'")
    spark.sql(f"MSCK REPAIR TABLE {t}")
    return spark.table(t)


@query("cached_reuse", oracle="""
WITH agg AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT a.o_custkey, a.n, a.n * 1.0 / (SELECT max(n) FROM agg) AS rel FROM agg a""")
def q_cached_reuse(spark, sf_dir):
    """The per-customer aggregate is cached and read twice (value and max, a
    scalar subquery: nothing passes through the driver)."""
    v = _name("per_customer")
    (Tables(spark, sf_dir).orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
     .cache().createOrReplaceTempView(v))
    return spark.sql(f"SELECT o_custkey, n, n / (SELECT max(n) FROM {v}) AS rel FROM {v}")


@query("view_query", oracle="""
SELECT n_name, count(*) AS n_customers FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_acctbal > 0 GROUP BY n_name""")
def q_view_query(spark, sf_dir):
    register_views(spark, sf_dir, ["customer", "nation"])
    v = _name("v_pos")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {v} AS "
              f"SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0")
    return spark.sql(f"SELECT n_name, count(*) AS n_customers FROM {v} GROUP BY n_name")


sql_query("hint_partitioning", """
SELECT /*+ REPARTITION(4), COALESCE(2), REBALANCE */ o_orderkey, o_custkey FROM orders""",
          oracle="SELECT o_orderkey, o_custkey FROM orders", group="storage")

sql_query("hint_repartition_by_range", """
SELECT /*+ REPARTITION_BY_RANGE(3, o_orderdate) */ o_orderkey, o_orderdate FROM orders""",
          oracle="SELECT o_orderkey, o_orderdate FROM orders", group="storage")

sql_query("sample_percent", "SELECT * FROM orders TABLESAMPLE (10 PERCENT)", oracle=None, group="storage")
sql_query("sample_rows", "SELECT * FROM orders TABLESAMPLE (50 ROWS)", oracle=None, group="storage")


sql_query("sample_bucket_sql", "SELECT * FROM orders TABLESAMPLE (BUCKET 3 OUT OF 10)", oracle=None,
          group="storage")

sql_query("limit_all", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P' LIMIT ALL""", oracle="""
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P'""", group="storage")


@query("cache_table_sql", oracle="""
SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderpriority""")
def q_cache_table_sql(spark, sf_dir):
    """``CACHE LAZY TABLE ... OPTIONS ('storageLevel' ...) AS SELECT`` then a query on it."""
    register_views(spark, sf_dir, ["orders"])
    v = _name("cached_big")
    spark.sql(f"CACHE LAZY TABLE {v} OPTIONS ('storageLevel' 'MEMORY_AND_DISK') AS "
              f"SELECT o_orderpriority FROM orders WHERE o_totalprice > 100000")
    return spark.sql(f"SELECT o_orderpriority, count(*) AS n FROM {v} GROUP BY o_orderpriority")


@query("analyze_stats")
def q_analyze_stats(spark, sf_dir):
    """``ANALYZE TABLE ... COMPUTE STATISTICS FOR COLUMNS``; the column
    statistics read back from the catalog (distinct counts are HLL estimates)."""
    t = _name("an")
    (Tables(spark, sf_dir).customer.write.format("parquet")
     .option("path", scratch_dir(spark, t)).saveAsTable(t))
    spark.sql(f"ANALYZE TABLE {t} COMPUTE STATISTICS FOR COLUMNS c_custkey, c_nationkey, c_acctbal")
    rows = []
    for c in ("c_custkey", "c_nationkey", "c_acctbal"):
        d = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {t} {c}").collect()}
        rows.append((c, d.get("min"), d.get("max"), d.get("num_nulls"), d.get("distinct_count")))
    return spark.createDataFrame(rows, "col_name string, min string, max string, num_nulls string, "
                                       "distinct_count string")


@query("view_global_temp", oracle="""
SELECT c_mktsegment, round(max(c_acctbal), 2) AS top_bal FROM customer GROUP BY c_mktsegment""")
def q_view_global_temp(spark, sf_dir):
    register_views(spark, sf_dir, ["customer"])
    v = _name("gv")
    spark.sql(f"CREATE GLOBAL TEMPORARY VIEW {v} AS "
              f"SELECT c_mktsegment, round(max(c_acctbal), 2) AS top_bal FROM customer GROUP BY c_mktsegment")
    return spark.sql(f"SELECT * FROM global_temp.{v}")


@query("scan_using_temp_table", oracle="SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal < 0")
def q_scan_using_temp_table(spark, sf_dir):
    """The deprecated ``CREATE TEMPORARY TABLE ... USING`` form of a data-source view."""
    v = _name("supplier_src")
    spark.sql(f"CREATE TEMPORARY TABLE {v} USING parquet OPTIONS (path '{table_path(sf_dir, 'supplier')}')")
    return spark.sql(f"SELECT s_suppkey, s_name FROM {v} WHERE s_acctbal < 0")


@query("insert_overwrite_if_not_exists", oracle="""
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'""")
def q_insert_overwrite_if_not_exists(spark, sf_dir):
    """``INSERT OVERWRITE ... PARTITION (k=v) IF NOT EXISTS`` leaves an existing
    partition alone and fills a missing one."""
    register_views(spark, sf_dir, ["orders"])
    t = _name("ione")
    spark.sql(f"CREATE TABLE {t} (o_orderkey BIGINT, o_orderstatus STRING) USING parquet "
              f"PARTITIONED BY (o_orderstatus) LOCATION '{scratch_dir(spark, t)}'")
    spark.sql(f"INSERT INTO {t} SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
    for status in ("F", "O"):
        spark.sql(f"INSERT OVERWRITE TABLE {t} PARTITION (o_orderstatus = '{status}') IF NOT EXISTS "
                  f"SELECT o_orderkey FROM orders WHERE o_orderstatus = '{status}' AND o_totalprice > 0")
    return spark.table(t)



@query("insert_with_hint", oracle="SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def q_insert_with_hint(spark, sf_dir):
    """``INSERT ... SELECT /*+ REPARTITION(3) */``: the hint sets the write's file count."""
    register_views(spark, sf_dir, ["lineitem"])
    t = _name("hinted")
    spark.sql(f"CREATE TABLE {t} (l_orderkey BIGINT, l_linenumber INT, l_returnflag STRING) USING parquet "
              f"LOCATION '{scratch_dir(spark, t)}'")
    spark.sql(f"INSERT INTO {t} SELECT /*+ REPARTITION(3) */ l_orderkey, l_linenumber, l_returnflag "
              f"FROM lineitem")
    return spark.table(t)


@query("insert_static_partition", oracle="""
SELECT o_orderkey, o_totalprice, 'F' AS status FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_totalprice, 'F' AS status FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 200000""")
def q_insert_static_partition(spark, sf_dir):
    """``INSERT INTO t PARTITION (k = v)`` appends to a partition that already has rows."""
    register_views(spark, sf_dir, ["orders"])
    t = _name("ins_static")
    spark.sql(f"CREATE TABLE {t} (o_orderkey BIGINT, o_totalprice DOUBLE, status STRING) USING parquet "
              f"PARTITIONED BY (status) LOCATION '{scratch_dir(spark, t)}'")
    for cond in ("o_orderstatus = 'F'", "o_orderstatus = 'O' AND o_totalprice > 200000"):
        spark.sql(f"INSERT INTO {t} PARTITION (status = 'F') SELECT o_orderkey, o_totalprice FROM orders WHERE {cond}")
    return spark.table(t)


@query("view_persistent", oracle="""
SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 5000""")
def q_view_persistent(spark, sf_dir):
    """Persistent ``CREATE VIEW`` on a table, then ``ALTER VIEW ... AS``."""
    t, v = _name("vp"), _name("v_persistent")
    (Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_acctbal").write.format("parquet")
     .option("path", scratch_dir(spark, t)).saveAsTable(t))
    spark.sql(f"CREATE VIEW {v} AS SELECT c_custkey FROM {t}")
    spark.sql(f"ALTER VIEW {v} AS SELECT c_custkey, c_name FROM {t} WHERE c_acctbal > 5000")
    return spark.table(v)


@query("truncate_table", oracle="SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'")
def q_truncate_table(spark, sf_dir):
    """``TRUNCATE TABLE`` empties a table; what is inserted later is all it holds."""
    register_views(spark, sf_dir, ["orders"])
    t = _name("trunc")
    spark.sql(f"CREATE TABLE {t} USING parquet AS SELECT o_orderkey, o_totalprice FROM orders")
    spark.sql(f"TRUNCATE TABLE {t}")
    spark.sql(f"INSERT INTO {t} SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'")
    return spark.table(t)


@query("create_table_like", oracle="SELECT * FROM supplier")
def q_create_table_like(spark, sf_dir):
    """``CREATE TABLE ... LIKE`` takes schema and format, no rows."""
    t, like = _name("like_src"), _name("like_dst")
    s = Tables(spark, sf_dir).supplier
    s.write.format("parquet").option("path", scratch_dir(spark, t)).saveAsTable(t)
    spark.sql(f"CREATE TABLE {like} LIKE {t} USING parquet")
    spark.table(t).write.insertInto(like)
    return spark.table(like)


def _text_files(spark, sf_dir, path, docs_a_file=20):
    """Text files, one for each run of documents: a line of id and text length for each document."""
    d = Tables(spark, sf_dir).documents
    lines = d.select(F.floor(F.col("doc_id") / docs_a_file).alias("file"), "doc_id",
                     F.concat_ws(":", "doc_id", F.length("text")).alias("value"))
    n = max(1, int(d.count() // (50 * docs_a_file)))
    (lines.repartition(n, "file").sortWithinPartitions("file", "doc_id").select("file", "value")
     .write.partitionBy("file").text(path))


_TEXT_FILES = """
SELECT CAST(floor(doc_id / 20) AS BIGINT) AS file, string_agg(doc_id || ':' || length(text) || chr(10), '' ORDER BY doc_id) AS text
FROM documents GROUP BY file"""


@query("whole_text_files", oracle=_TEXT_FILES)
def q_whole_text_files(spark, sf_dir):
    """Whole-file source: a tree of text files, one row a file; their number grows with ``documents``."""
    from lakeshard.sources.files import read_text_files

    path = scratch_dir(spark, "texts") + "/t"
    _text_files(spark, sf_dir, path)
    return read_text_files(spark, path, recursive=True).select(F.regexp_extract("path", "file=([0-9]+)/", 1).cast("long").alias("file"), "text")


@query("pack_files", oracle=f"SELECT file, text AS content, length(text)::BIGINT AS length FROM ({_TEXT_FILES})")
def q_pack_files(spark, sf_dir):
    """Many small files packed into Parquet containers, whole and with their names."""
    from lakeshard.sources.files import pack_files

    base = scratch_dir(spark, "pack")
    _text_files(spark, sf_dir, f"{base}/in")
    packed = pack_files(spark, f"{base}/in", f"{base}/out").where("rel LIKE '%part-%' AND rel NOT LIKE '%.crc'")
    return packed.select(F.regexp_extract("rel", "file=([0-9]+)/", 1).cast("long").alias("file"),
                         F.col("content").cast("string").alias("content"), "length")
