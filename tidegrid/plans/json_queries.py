"""Queries on JSON text."""

from pyspark.sql import functions as F

from tidegrid.functions import json as J
from tidegrid.plans.inputs import json_documents, on_all_cores, table
from tidegrid.plans.registry import query
from tidegrid.sources import jsontext as P

GOOD = "o_orderkey % 100 > 1"


def _values(spark, folder):
    return P.parse_json(json_documents(spark, folder), "raw")


@query(f"""SELECT o_orderkey AS doc_id, o_orderkey AS id, o_custkey AS customer, o_orderpriority AS priority,
  o_totalprice > 100000 AS large FROM orders WHERE {GOOD}""")
def parse_json(spark, folder):
    v = F.col("value")
    return _values(spark, folder).select(
        "doc_id",
        J.json_value(v, ".id", "long").alias("id"),
        J.json_value(v, ["customer", "key"], "long").alias("customer"),
        J.json_value(v, ".tags.1", "string").alias("priority"),
        J.json_value(v, "large", "boolean").alias("large"),
    )


@query("SELECT o_orderkey AS doc_id FROM orders WHERE o_orderkey % 100 <= 1")
def json_quarantine(spark, folder):
    return P.json_quarantine(json_documents(spark, folder), "raw").select("doc_id")


@query(f"""
WITH t AS (SELECT unnest(['object', 'number', 'object', 'number', 'null', 'array', 'string', 'boolean']) AS type,
  unnest(['', '.id', '.customer', '.customer.key', '.customer.note', '.tags', '.tags.0', '.large']) AS path)
SELECT path, type, count(*) AS n FROM orders, t WHERE {GOOD} GROUP BY ALL
UNION ALL SELECT '.tags.9', 'error', count(*) FROM orders WHERE {GOOD}""")
def json_type(spark, folder):
    paths = ["", ".id", ".customer", ".customer.key", ".customer.note", ".tags", ".tags.0", ".tags.9", ".large"]
    v = F.col("value")
    typed = F.array(
        *[
            F.struct(F.lit(p).alias("path"), J.json_type(J.json_value(v, p) if p else v).alias("type"))
            for p in paths
        ]
    )
    rows = _values(spark, folder).select(F.inline(typed))
    return rows.groupBy("path", "type").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_id, (json_extract(props, '$.k'))::BIGINT AS k, (json_extract(props, '$.k'))::BIGINT AS any_case, NULL::VARCHAR AS missing
FROM events""")
def json_value(spark, folder):
    v = F.try_parse_json("props")
    return on_all_cores(table(spark, folder, "events"), "event_id").select(
        "event_id",
        J.json_value(v, ".k", "long").alias("k"),
        J.json_value(v, ".K", "long", ignore_case=True).alias("any_case"),
        J.json_value(v, ".k.a.0", "string").alias("missing"),
    )


@query("""SELECT o_orderkey AS doc_id, '0' AS first_id FROM orders WHERE o_orderkey % 100 = 1""")
def json_first_value(spark, folder):
    doubled = json_documents(spark, folder).where(J.has_duplicate_keys("raw"))
    return doubled.select("doc_id", J.json_first_value("raw", ".id").alias("first_id"))


KEYS = ".id number .customer object .customer.key number .customer.note null .tags array .tags.0 string .tags.1 string .large boolean"


def _key_rows(pattern):
    pairs = KEYS.split()
    rows = [f"('{p}', '{t}')" for p, t in zip(pairs[::2], pairs[1::2]) if pattern(p)]
    return f"(VALUES {', '.join(rows)}) k(path, type)"


@query(f"SELECT o_orderkey AS doc_id, path, type FROM orders, {_key_rows(lambda p: True)} WHERE {GOOD}")
def json_keys(spark, folder):
    return J.json_keys(json_documents(spark, folder), "raw")


@query(f"""SELECT o_orderkey AS doc_id, path, type FROM orders,
{_key_rows(lambda p: p in ('.tags', '.large'))} WHERE {GOOD}""")
def json_keys_pattern(spark, folder):
    return J.json_keys(json_documents(spark, folder), "raw", "?A*")


@query("""
SELECT '.' || key AS path, CASE json_type(props, '$.' || key) WHEN 'VARCHAR' THEN 'string' ELSE 'number' END AS type,
  count(*) AS documents FROM (SELECT props, unnest(json_keys(props)) AS key FROM events) GROUP BY ALL""")
def json_key_inventory(spark, folder):
    return J.json_key_inventory(on_all_cores(table(spark, folder, "events"), "event_id"), "props")


@query(f"""
SELECT o_orderkey AS doc_id, path, type FROM orders, {_key_rows(lambda p: True)} WHERE {GOOD} AND o_orderkey % 1000 > 2
UNION ALL SELECT o_orderkey, repeat('.0', n::INT), CASE WHEN n < 200 THEN 'array' ELSE 'number' END
FROM orders, range(1, 201) r(n) WHERE o_orderkey % 1000 = 2""")
def json_keys_deep(spark, folder):
    """Among the documents some that only open brackets, and some that nest 200 deep."""
    kind = F.col("doc_id") % 1000
    nested = F.concat(F.repeat(F.lit("["), F.lit(200)), F.lit("1"), F.repeat(F.lit("]"), F.lit(200)))
    raw = F.when(kind < 2, F.repeat(F.lit("["), F.lit(400))).when(kind == 2, nested).otherwise(F.col("raw"))
    return J.json_keys(json_documents(spark, folder).withColumn("raw", raw), "raw")


@query(f"""
SELECT o_orderkey AS doc_id, '{{"customer":{{"key":' || o_custkey || ',"note":null}},"id":' || o_orderkey || ',"large":' ||
  (o_totalprice > 100000)::VARCHAR || ',"tags":["' || o_orderstatus || '","' || o_orderpriority || '"]}}' AS text
FROM orders WHERE {GOOD}""")
def json_stringify(spark, folder):
    return _values(spark, folder).select("doc_id", J.json_stringify("value").alias("text"))


@query("""
SELECT n_nationkey, '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","region":' ||
  CASE WHEN n_regionkey = 0 THEN 'null' ELSE n_regionkey::VARCHAR END || '}' AS object FROM nation""")
def json_object(spark, folder):
    region = F.when(F.col("n_regionkey") != 0, F.col("n_regionkey")).alias("region")
    return table(spark, folder, "nation").select("n_nationkey", J.json_object("n_nationkey", "n_name", region).alias("object"))


@query("""
SELECT p_partkey, '["' || p_name || '",' || p_size || ',' || (p_size > 25)::VARCHAR || ',null]' AS array FROM part""")
def json_array(spark, folder):
    array = J.json_array("p_name", "p_size", F.col("p_size") > 25, F.lit(None).cast("string"))
    return table(spark, folder, "part").select("p_partkey", array.alias("array"))


@query("""SELECT p_partkey, '"' || p_name || '\\"' || p_brand || '"' AS quoted FROM part""")
def json_quote(spark, folder):
    text = F.concat("p_name", F.lit('"'), "p_brand")
    return table(spark, folder, "part").select("p_partkey", J.json_quote(text).alias("quoted"))


@query("""
SELECT p_partkey, unnest([0, 1, 2])::INT AS number, unnest(['a', p_size::VARCHAR, p_type]) AS segment FROM part""")
def json_path_split(spark, folder):
    path = F.concat(F.lit(".a."), F.col("p_size").cast("string"), F.lit("."), F.col("p_type"))
    segments = F.posexplode(J.json_path_split(path)).alias("number", "segment")
    return table(spark, folder, "part").select("p_partkey", segments)


@query("""SELECT p_partkey, '.a.' || p_size || '.' || p_type AS path FROM part""")
def json_path_join(spark, folder):
    segments = F.array(F.lit("a"), F.col("p_size").cast("string"), F.col("p_type"))
    return table(spark, folder, "part").select("p_partkey", J.json_path_join(segments).alias("path"))
