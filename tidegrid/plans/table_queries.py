"""Queries on typing, profiles, lookups and CSV text."""

from pyspark.sql import functions as F

from tidegrid.operators import tables as T
from tidegrid.plans.inputs import csv_blobs, csv_files, on_all_cores, table, timeseries_blobs
from tidegrid.plans.registry import query
from tidegrid.sources import csvtext as C


def _texts(spark, folder, name, *columns):
    return on_all_cores(table(spark, folder, name), columns[0]).select(*[F.col(c).cast("string").alias(c) for c in columns])


def _cells(spark, folder):
    items = on_all_cores(table(spark, folder, "lineitem"), "l_orderkey")
    text = {c: F.col(c).cast("string") for c in ("l_quantity", "l_extendedprice", "l_shipdate")}
    odd = F.col("l_orderkey") % 10 == 0
    return items.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.when(odd, "n/a").otherwise(F.concat(text["l_quantity"], F.lit("75"))).alias("l_quantity"),
        F.when(odd, "12e").otherwise(text["l_extendedprice"]).alias("l_extendedprice"),
        F.when(odd, "soon").otherwise(F.substr(text["l_shipdate"], F.lit(1), F.lit(10))).alias("l_shipdate"),
        F.when(F.col("l_returnflag") == "R", "TRUE").when(F.col("l_returnflag") == "A", "0").otherwise("N").alias("l_returnflag"),
    )


CELL_TYPES = {"l_quantity": "int", "l_extendedprice": "num", "l_shipdate": "date", "l_returnflag": "bool"}


@query("""
SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_orderkey % 10 <> 0 THEN floor(l_quantity)::INT END AS l_quantity,
  CASE WHEN l_orderkey % 10 <> 0 THEN l_extendedprice END AS l_extendedprice,
  CASE WHEN l_orderkey % 10 <> 0 THEN l_shipdate::DATE END AS l_shipdate,
  CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS l_returnflag FROM lineitem""")
def convert_columns(spark, folder):
    return T.convert_columns(_cells(spark, folder), CELL_TYPES)


@query("""
SELECT unnest(['l_quantity', 'l_extendedprice', 'l_shipdate']) AS "column", count(*) FILTER (l_orderkey % 10 = 0) AS errors
FROM lineitem UNION ALL SELECT 'l_returnflag', count(*) FILTER (l_returnflag NOT IN ('R', 'A')) FROM lineitem""")
def conversion_errors(spark, folder):
    return T.conversion_errors(_cells(spark, folder), CELL_TYPES)


@query("""
WITH c AS (SELECT unnest(['o_orderkey', 'o_orderdate', 'o_orderpriority', 'o_totalprice']) AS "column",
  unnest([o_orderkey::VARCHAR, o_orderdate::VARCHAR, o_orderpriority, o_totalprice::VARCHAR]) AS cell FROM orders)
SELECT "column", CASE WHEN try_cast(cell AS DOUBLE) IS NOT NULL THEN 'num'
  WHEN try_cast(cell AS TIMESTAMP) IS NOT NULL THEN 'date' ELSE 'str' END AS type, count(*) AS cells FROM c GROUP BY ALL""")
def type_profile(spark, folder):
    return T.type_profile(_texts(spark, folder, "orders", "o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice"))


@query("""
SELECT l_returnflag, count(*) AS n_rows, 10::BIGINT AS n_columns, (count(*) * 10)::BIGINT AS n_cells
FROM lineitem GROUP BY l_returnflag""")
def shape_profile(spark, folder):
    return T.shape_profile(table(spark, folder, "lineitem"), "l_returnflag")


@query("""SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%R_D%'""")
def match_wildcard(spark, folder):
    return table(spark, folder, "part").where(T.match_wildcard("p_name", "*R?D*")).select("p_partkey", "p_name")


@query("""
WITH f AS (SELECT lower(c_mktsegment) AS k, arg_min(c_name, c_custkey) AS first_customer FROM customer GROUP BY 1)
SELECT c.c_custkey, f.first_customer FROM customer c
LEFT JOIN f ON f.k = CASE WHEN c.c_custkey % 5 = 0 THEN 'none' ELSE lower(c.c_mktsegment) END""")
def lookup_first(spark, folder):
    customers = table(spark, folder, "customer")
    wanted = customers.select(
        "c_custkey", F.when(F.col("c_custkey") % 5 == 0, "none").otherwise(F.initcap("c_mktsegment")).alias("segment")
    )
    found = T.lookup_first(wanted, "segment", customers, "c_mktsegment", "c_name", "c_custkey", "first_customer")
    return found.select("c_custkey", "first_customer")


CSV_ROWS = """
SELECT p_partkey // 10 AS doc_id, (p_partkey % 10)::INT AS row_no, p_partkey::VARCHAR AS key,
  CASE WHEN p_partkey % 10 = 4 THEN p_name ELSE p_name || '," ' || p_brand || chr(10) END AS label,
  CASE WHEN p_partkey % 10 <> 4 THEN p_type END AS kind, CASE WHEN p_partkey % 10 <> 4 THEN p_size::VARCHAR END AS size
FROM part WHERE p_partkey % 10 <> 7"""


@query(CSV_ROWS)
def parse_csv(spark, folder):
    return C.parse_csv(csv_blobs(spark, folder), "body", columns=["key", "label", "kind", "size"])


@query(f"SELECT * FROM ({CSV_ROWS}) WHERE row_no BETWEEN 2 AND 4")
def parse_csv_slice(spark, folder):
    columns = ["key", "label", "kind", "size"]
    return C.parse_csv(csv_blobs(spark, folder), "body", columns, offset=1, count=3, header=True)


@query("""SELECT p_partkey // 10 AS doc_id, 7::INT AS row_no, 5::INT AS n_fields, p_partkey::VARCHAR AS key
FROM part WHERE p_partkey % 10 = 7""")
def csv_quarantine(spark, folder):
    rows = C.csv_quarantine(csv_blobs(spark, folder), "body")
    return rows.select("doc_id", "row_no", "n_fields", F.get("fields", F.lit(0)).alias("key"))


@query("""
SELECT l_orderkey::VARCHAR AS orderkey, l_partkey::VARCHAR AS partkey, l_linenumber::VARCHAR AS linenumber,
  CASE WHEN l_partkey % 3 = 0 THEN l_returnflag || chr(10) || '"' || l_linestatus || '",' || chr(10) ELSE l_returnflag END AS note,
  l_suppkey::VARCHAR AS suppkey FROM lineitem""")
def parse_csv_files(spark, folder):
    rows = C.parse_csv_files(spark, csv_files(spark, folder), columns=["orderkey", "partkey", "linenumber", "note", "suppkey"])
    return rows.drop("path", "row_no")


@query("""
SELECT l_orderkey::VARCHAR AS orderkey, CASE WHEN l_partkey % 3 = 0 THEN 3 ELSE 1 END::BIGINT AS lines, 6::INT AS n_fields
FROM lineitem WHERE l_orderkey % 50 = 7""")
def csv_files_quarantine(spark, folder):
    rows = C.csv_files_quarantine(spark, csv_files(spark, folder, wide=True))
    return rows.select(F.get("fields", F.lit(0)).alias("orderkey"), "lines", "n_fields")


@query("""
SELECT event_id // 100 AS doc_id, (1 + event_id % 100)::INT AS row_no, ts::DATE AS date, event_id::DOUBLE AS id, value
FROM events""")
def parse_csv_timeseries(spark, folder):
    return C.parse_csv_timeseries(timeseries_blobs(spark, folder), "body", ["id", "value"])


@query("""
SELECT event_id // 100 AS doc_id, (1 + event_id % 100)::INT AS row_no, ts::DATE AS date, event_id::DOUBLE AS id, value
FROM events WHERE event_id % 100 NOT IN (17, 31)""")
def parse_csv_timeseries_checked(spark, folder):
    return C.parse_csv_timeseries(timeseries_blobs(spark, folder, odd=True), "body", ["id", "value"])


@query("""
SELECT event_id // 100 AS doc_id, (1 + event_id % 100)::INT AS row_no, event_id::VARCHAR AS id FROM events WHERE event_id % 100 IN (17, 31)""")
def timeseries_quarantine(spark, folder):
    held = C.timeseries_quarantine(timeseries_blobs(spark, folder, odd=True), "body", ["id", "value"])
    return held.select("doc_id", "row_no", F.get("fields", F.lit(1)).alias("id"))
