"""Queries on addresses, headers, texts and times."""

from pyspark.sql import functions as F

from tidegrid.functions import clock as K
from tidegrid.functions import headers as H
from tidegrid.functions import text as X
from tidegrid.functions import url as U
from tidegrid.functions.registry import register_functions
from tidegrid.plans.inputs import exchange_files, on_all_cores, snapshots, table, text_files, url_variants
from tidegrid.plans.registry import query
from tidegrid.sources import exchanges as E
from tidegrid.sources import snapshots as N
from tidegrid.sources.lines import read_lines as lines_of

HOST_PATTERN = "^https?://([^/]+)"

VARIANTS = """
WITH u AS (SELECT page_id, page_id % 4 AS kind, url, regexp_extract(url, '^(https?)', 1) AS scheme,
  regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, '^https?://[^/]+([^?#]*)', 1) AS path,
  regexp_extract(url, '([?#].*)$', 1) AS extra FROM pages)"""


@query(f"""{VARIANTS}
SELECT page_id, CASE kind WHEN 1 THEN scheme || '://user:secret@' || host || ':8080' || path || extra ELSE url END AS canonical FROM u""")
def canonicalize_url(spark, folder):
    return url_variants(spark, folder).select("page_id", U.canonicalize_url("url").alias("canonical"))


@query(f"""{VARIANTS}
SELECT page_id, CASE kind WHEN 2 THEN scheme || '://' || host || regexp_replace(path, '^/([a-z]+)/', '/a%20b/../\\1/./') || extra
  WHEN 3 THEN url || ' ' WHEN 1 THEN scheme || '://user:secret@' || host || ':8080' || path || extra ELSE url END AS canonical FROM u""")
def canonicalize_url_options(spark, folder):
    spaces = U.canonicalize_url("url", encode_spaces_only=True, no_meta=True)
    browser = U.canonicalize_url(F.concat("url", F.lit(" ")), browser_mode=True, no_encode=True, no_meta=True)
    shown = F.when(F.col("page_id") % 4 == 3, F.concat(F.rtrim(browser), F.lit(" "))).otherwise(spaces)
    return url_variants(spark, folder).select("page_id", shown.alias("canonical"))


@query(f"""{VARIANTS}
SELECT page_id, scheme, host, CASE WHEN kind = 1 THEN 8080 WHEN scheme = 'https' THEN 443 ELSE 80 END::INT AS port,
  CASE WHEN kind = 1 THEN 'user' ELSE '' END AS "user", CASE WHEN kind = 1 THEN 'secret' ELSE '' END AS pass,
  CASE WHEN kind = 2 THEN regexp_replace(path, '^/([a-z]+)/', '/a b/../\\1/./') WHEN kind = 3 AND extra = '' THEN path || ' ' ELSE path END AS path,
  CASE WHEN kind = 3 AND extra <> '' THEN extra || ' ' ELSE extra END AS extra FROM u""")
def crack_url(spark, folder):
    cracked = url_variants(spark, folder).select("page_id", U.crack_url("url").alias("parts"))
    return cracked.select("page_id", "parts.*")


@query(f"""{VARIANTS}
SELECT page_id, CASE kind WHEN 1 THEN scheme || '://user:secret@' || host || ':8080' || path || extra
  WHEN 2 THEN scheme || '://' || host || regexp_replace(path, '^/([a-z]+)/', '/a b/../\\1/./') || extra
  WHEN 3 THEN url || ' ' ELSE url END AS rebuilt,
  scheme || '://' || host || ':81' || path || '?q' AS from_map FROM u""")
def create_url(spark, folder):
    cracked = url_variants(spark, folder).select("page_id", U.crack_url("url").alias("parts"))
    texts = table(spark, folder, "pages").select("page_id", U.crack_url("url").alias("p")).select(
        F.col("page_id").alias("id"),
        F.create_map(
            *[F.lit("Scheme"), F.col("p.scheme"), F.lit("HOST"), F.col("p.host"), F.lit("port"), F.lit("81")],
            *[F.lit("path"), F.col("p.path"), F.lit("extra"), F.lit("?q")],
        ).alias("named"),
    )
    both = cracked.join(texts, F.col("page_id") == F.col("id"))
    return both.select(
        "page_id",
        U.create_url_from_struct("parts").alias("rebuilt"),
        U.create_url_from_map("named").alias("from_map"),
    )


@query("""
WITH u AS (SELECT CASE page_id % 5 WHEN 0 THEN 'mailto' WHEN 1 THEN 'unknown' WHEN 2 THEN 'partial'
  ELSE regexp_extract(url, '^(https?):', 1) END AS class FROM pages)
SELECT class, count(*) AS urls FROM u GROUP BY class""")
def url_scheme_class(spark, folder):
    kind = F.col("page_id") % 5
    url = (
        F.when(kind == 0, "MailTo:someone@example.org")
        .when(kind == 1, F.concat(F.lit("x-"), "url"))
        .when(kind == 2, F.regexp_replace("url", "^https?://[^/]+", ""))
        .otherwise(F.col("url"))
    )
    classes = table(spark, folder, "pages").select(U.url_scheme_class(url).alias("class"))
    return classes.groupBy("class").agg(F.count(F.lit(1)).alias("urls"))


@query("""
SELECT page_id, 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' || octet_length(encode(html)) ||
  chr(13) || chr(10) || 'Last-Modified: Mon, ' || lpad((page_id % 28 + 1)::VARCHAR, 2, '0') || ' Jan 2024 10:00:00 GMT' ||
  chr(13) || chr(10) || 'X-Page: ' || page_id || chr(13) || chr(10) || chr(13) || chr(10) AS block FROM pages""")
def format_headers(spark, folder):
    return snapshots(spark, folder).select("page_id", H.format_headers("headers").alias("block"))


@query("""
SELECT page_id, 'text/html; charset=utf-8' AS kind, octet_length(encode(html))::INT AS size, page_id::VARCHAR AS page,
  make_timestamp(2024, 1, page_id % 28 + 1, 10, 0, 0) AS changed, NULL::VARCHAR AS etag FROM pages""")
def query_header(spark, folder):
    blocks = snapshots(spark, folder).select("page_id", H.parse_headers(H.format_headers("headers")).alias("h"))
    return blocks.select(
        "page_id",
        H.query_header("h", "CONTENT_TYPE").alias("kind"),
        H.query_header("h", "content-length", "int").alias("size"),
        H.query_header("h", "X-PAGE").alias("page"),
        H.query_header("h", "HTTP_QUERY_LAST_MODIFIED", "timestamp").cast("timestamp_ntz").alias("changed"),
        H.query_header("h", "ETag").alias("etag"),
    )


@query("""SELECT url, octet_length(encode(html)) AS n_bytes, length(html) AS n_chars, md5(html) AS digest FROM pages""")
def read_snapshots(spark, folder):
    saved = N.read_snapshots(spark, f"{folder}/pages.parquet", columns={"html": "body"})
    return saved.select(
        "url",
        F.octet_length("body").cast("long").alias("n_bytes"),
        F.length(N.body_text()).cast("long").alias("n_chars"),
        F.md5("body").alias("digest"),
    )


EXCHANGES = """
WITH e AS (SELECT *, CASE WHEN page_id % 7 = 0 THEN 'HTTP/1.0' ELSE 'HTTP/1.1' END AS version,
  CASE WHEN page_id % 10 = 0 THEN 'HEAD' ELSE 'GET' END AS method,
  CASE WHEN page_id % 3 = 0 THEN '404 Not Found' ELSE '200 OK' END AS answer, chr(13) || chr(10) AS nl,
  'Content-Type: text/html; charset=utf-8' || nl || 'Content-Length: ' || octet_length(encode(html)) || nl ||
  'Last-Modified: Mon, ' || lpad((page_id % 28 + 1)::VARCHAR, 2, '0') || ' Jan 2024 10:00:00 GMT' || nl || 'X-Page: ' || page_id || nl AS block,
  make_timestamp(1600000000000001 + page_id * 1000003) AS fetched_at FROM pages)"""


@query(f"""{EXCHANGES}
SELECT page_id::VARCHAR AS page, url, fetched_at, version, method, answer[:3] AS code, answer[5:] AS phrase, octet_length(encode(html))::INT AS size,
  CASE WHEN method = 'GET' THEN md5(html) END AS digest, version || ' ' || answer || nl || block || nl AS raw, version || ' ' || answer || nl || block AS saved
FROM e WHERE page_id % 50 <> 1""")
def read_exchanges(spark, folder):
    saved = E.read_exchanges(spark, exchange_files(spark, folder))

    def field(name):
        return H.response_field(name, "headers", "status", "version", "method")

    return saved.select(
        field("X-Page").alias("page"),
        "url",
        F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"),
        field("VERSION").alias("version"),
        field("REQUEST_METHOD").alias("method"),
        field("STATUS_CODE").alias("code"),
        field("STATUS_TEXT").alias("phrase"),
        H.query_header("headers", "CONTENT_LENGTH", "int").alias("size"),
        F.md5("body").alias("digest"),
        field("RAW_HEADERS_CRLF").alias("raw"),
        F.col("raw_headers").alias("saved"),
    )


@query(f"""{EXCHANGES},
r AS (SELECT *, 'X-Fetched-At: ' || (1600000000000001 + page_id * 1000003) || nl || nl AS mid,
  version || ' ' || answer || nl || block || CASE WHEN method = 'GET' THEN nl || html ELSE '' END AS response FROM e WHERE page_id % 50 = 1)
SELECT CASE WHEN page_id % 150 = 51 THEN 'no end of the request' WHEN page_id % 100 = 1 THEN 'request line' ELSE 'status line' END AS reason,
  CASE WHEN page_id % 150 = 51 THEN 'nothing' WHEN page_id % 100 = 1
    THEN replace(method || ' ' || url || ' ' || version || nl || mid || response, ' HTTP/', ' FTP/')
    ELSE replace(method || ' ' || url || ' ' || version || nl || mid || response, nl || 'HTTP/', nl || 'ICY/') END AS record FROM r""")
def exchange_quarantine(spark, folder):
    return E.exchange_quarantine(spark, exchange_files(spark, folder))


@query("""
SELECT doc_id, substring(text, 4, 10) AS part, substring(text, 6) AS rest, split_part(text, '.', 1) AS sentence,
  CASE WHEN contains(text, '.') THEN left(text, length(text) - length(regexp_extract(text, '[^.]*$')) - 1) ELSE text END AS sentences
FROM documents""")
def view_slice(spark, folder):
    marked = F.concat(F.lit(N.BOM), F.col("text"))
    return table(spark, folder, "documents").select(
        "doc_id",
        X.view_slice(marked, 3, 10).alias("part"),
        X.view_slice(marked, 5).alias("rest"),
        X.view_slice(F.col("text"), 0, ".").alias("sentence"),
        X.view_slice(F.col("text"), -1, ".").alias("sentences"),
    )


@query("""SELECT page_id, length(html) AS n_chars, octet_length(encode(html)) AS n_bytes FROM pages""")
def view_len(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", X.view_len("html").alias("n_chars"), X.view_bytes("html").alias("n_bytes")
    )


@query("""
SELECT doc_id, substring(text, 8) AS tail, left(text, greatest(length(text) - 30, 0)) AS head FROM documents""")
def view_drop(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", X.view_drop("text", 7).alias("tail"), X.view_drop("text", -30).alias("head")
    )


LINES = """
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
     t AS (SELECT doc_id, CASE WHEN l[-1] = '' THEN l[:-2] ELSE l END AS l FROM s)"""


@query(f"""{LINES} SELECT doc_id, (unnest(range(len(l))))::INT AS line_no, unnest(l) AS line FROM t""")
def split_lines(spark, folder):
    return X.split_lines(table(spark, folder, "documents").select("doc_id", "text"), "text")


@query("""
WITH l AS (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
SELECT line, count(*) AS n FROM l GROUP BY line UNION ALL SELECT '# lines numbered', count(*) FROM l""")
def read_lines(spark, folder):
    lines = lines_of(spark, text_files(spark, folder))
    numbered = lines.groupBy("path").agg((F.max("line_no") + 1).alias("n"), F.count_distinct("line_no").alias("d")).where("n = d")
    total = numbered.agg(F.lit("# lines numbered").alias("line"), F.sum("n").alias("n"))
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).unionByName(total)


@query(f"""{LINES},
  b AS (SELECT doc_id, flatten(list_transform(l, lambda x: CASE WHEN length(x) <= 255 THEN [x] ELSE
    list_transform(regexp_extract_all(x, '[^\\n]{{1,255}}(?: |\\z)|[^\\n]{{1,255}}'), lambda y: regexp_replace(y, ' \\z', '')) END)) AS l FROM t)
SELECT doc_id, (unnest(range(len(l))))::INT AS line_no, unnest(l) AS line FROM b""")
def split_lines_wrapped(spark, folder):
    return X.split_lines(on_all_cores(table(spark, folder, "documents").select("doc_id", "text"), "doc_id"), "text", width=255)


@query("""SELECT o_orderkey, epoch(o_orderdate)::BIGINT + 9000 AS seconds FROM orders""")
def mktime(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", K.mktime("o_orderdate", "-02:30").alias("seconds"))


@query("""SELECT event_id, date_trunc('second', ts) + INTERVAL 19800 SECOND AS local FROM events""")
def localtime(spark, folder):
    seconds = K.mktime("ts", "UTC")
    return table(spark, folder, "events").select("event_id", K.localtime(seconds, "+05:30").alias("local"))


@query("""
SELECT event_id, epoch_us(ts) // 1000000 + 2208988800 AS seconds,
  round((epoch_us(ts) % 1000000) / 1000000.0 * 4294967296)::BIGINT AS fraction FROM events""")
def timestamp_to_ntp(spark, folder):
    stamped = table(spark, folder, "events").select("event_id", K.timestamp_to_ntp(F.col("ts").cast("timestamp")).alias("s"))
    return stamped.select("event_id", "s.*")


@query("""SELECT event_id, ts FROM events""")
def ntp_to_timestamp(spark, folder):
    stamped = timestamp_to_ntp(spark, folder)
    return stamped.select("event_id", K.ntp_to_timestamp("seconds", "fraction").cast("timestamp_ntz").alias("ts"))


@query("""
SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, '^(https?):', 1) AS class,
  url AS rebuilt, regexp_matches(url, '^https.*example') AS secure, substring(html, 3, 7) AS part, length(html) AS n_chars,
  left(html, length(html) - 5) AS head, to_json(url) AS quoted, (1609459200 + page_id)::BIGINT AS seconds FROM pages""")
def register_sql_functions(spark, folder):
    register_functions(spark)
    table(spark, folder, "pages").createOrReplaceTempView("saved_pages")
    return spark.sql("""
        SELECT page_id, crack_url(url).host AS host, url_scheme_class(url) AS class, create_url(crack_url(url)) AS rebuilt,
               match_wildcard(url, 'HTTPS*example*') AS secure, view_slice(html, 2, 7) AS part,
               view_len(html) AS n_chars, view_drop(html, -5) AS head, json_quote(url) AS quoted,
               mktime(timestampadd(SECOND, page_id, timestamp_ntz'2021-01-01 00:00:00'), 'UTC') AS seconds
        FROM saved_pages""")


@query(f"""{LINES} SELECT doc_id, (unnest(range(len(l))))::INT AS line_no, unnest(l) AS line FROM t""")
def register_table_functions(spark, folder):
    register_functions(spark)
    table(spark, folder, "documents").createOrReplaceTempView("saved_documents")
    return spark.sql("SELECT doc_id, l.line_no, l.line FROM saved_documents, LATERAL split_lines(text) l")
