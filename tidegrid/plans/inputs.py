"""Inputs that Spark derives from the stored tables."""

from pyspark.sql import functions as F

from tidegrid.session import scratch_path, store_by
from tidegrid.sources.markup import parse_html, parse_xml
from tidegrid.sources.exchanges import SEPARATOR, exchange_text, write_exchanges
from tidegrid.sources.snapshots import BOM

# Documents of one piece: orders as text, and pages.
TEXTS, PAGES = 100_000, 10_000

TRADE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber"]
EVENT_ORDER = ["ts", "event_id"]


def table(spark, folder, name):
    """A stored table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def on_all_cores(frame, key):
    """A table that is read in fewer pieces than there are cores, dealt over the cores.

    The plan alone tells the number of pieces, so no row is counted; a table
    that is dealt is at most one split of a file for each core.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame if frame.rdd.getNumPartitions() >= cores else frame.repartition(cores, key)


def pieces_of(frame, rows):
    """How many pieces a table is dealt into: one for each so many rows, but at least one a core.

    A stored table may take a few bytes a row and what is made of a row many, so
    the rows are counted, which the footers of its files tell.
    """
    return max(frame.sparkSession.sparkContext.defaultParallelism, -(-frame.count() // rows))


def in_pieces(frame, key, rows):
    """A table dealt by a key, so that no task makes more than the documents of a bounded number of rows."""
    return frame.repartition(pieces_of(frame, rows), key)


def page_nodes(spark, folder, columns=None, stored=False):
    """The node table of all pages; `stored` for queries that read it more than once."""
    pages = table(spark, folder, "pages").select("page_id", "html")
    nodes = parse_html(in_pieces(pages, "page_id", PAGES), "page_id", "html", columns=columns)
    return store_by(nodes, "nodes", "page_id", pieces_of(pages, PAGES)) if stored else nodes


def xml_nodes(spark, folder, columns=None):
    """The stored node table of the XML texts."""
    pieces = pieces_of(table(spark, folder, "orders"), TEXTS)
    return store_by(parse_xml(xml_documents(spark, folder), "doc_id", "raw", columns=columns), "nodes", "doc_id", pieces)


def trades(spark, folder):
    """Line items as trades of a part: price, cash flow and signed quantity."""
    back = F.col("l_returnflag") == "R"
    return table(spark, folder, "lineitem").select(
        "l_partkey",
        *TRADE_ORDER,
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("x"),
        (F.col("l_discount") * 10).alias("c"),
        F.when(back, -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("g"),
    )


def user_values(spark, folder):
    """Event values, to be read as one series per user."""
    return table(spark, folder, "events").select("user_id", *EVENT_ORDER, "value")


def daily_bars(spark, folder):
    """Daily prices per user, made of the events of each day, whose times differ."""
    events = table(spark, folder, "events").select(
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("symbol"),
        F.col("ts").cast("date").alias("date"),
        "ts",
        (100 + F.col("value") / 100).alias("p"),
    )
    bars = events.groupBy("symbol", "date").agg(
        F.min_by("p", "ts").alias("open"),
        F.max("p").alias("high"),
        F.min("p").alias("low"),
        F.max_by("p", "ts").alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )
    return bars.withColumn("adj_close", F.col("close")).select(
        "symbol", "date", "open", "high", "low", "close", "adj_close", "volume"
    )


def bars_with_gaps(spark, folder):
    """Daily prices in which some adjusted closes are missing."""
    number = F.substr("symbol", F.lit(2)).cast("long") + F.dayofmonth("date")
    return daily_bars(spark, folder).withColumn("adj_close", F.when(number % 17 != 0, F.col("adj_close")))


def instruments(spark, folder):
    """Reference data of each user's symbol."""
    users = table(spark, folder, "events").select(F.col("user_id").alias("n")).distinct()
    n = F.col("n")
    day = F.lit("2024-01-10").cast("date")
    return users.select(
        F.concat(F.lit("S"), n.cast("string")).alias("symbol"),
        F.concat(F.lit("Instrument "), n.cast("string")).alias("name"),
        F.when(n % 3 != 0, F.concat(F.lit("C"), (n % 3).cast("string"))).alias("country"),
        F.when(n % 2 == 0, F.concat(F.lit("I"), n.cast("string"))).alias("short_name"),
        F.when(n % 4 == 0, F.lit("2024-01-05").cast("date")).alias("start_date"),
        F.when(n % 5 == 0, F.lit("2024-01-25").cast("date")).alias("end_date"),
        F.when(n % 3 == 0, F.array(F.date_add(day, (n % 7).cast("int")), F.date_add(day, (n % 11).cast("int")))).alias(
            "bad_data_dates"
        ),
    )


def csv_blobs(spark, folder):
    """CSV text of ten parts each, with quoted separators, and one wide row per text."""
    part = table(spark, folder, "part")
    key = F.col("p_partkey").cast("string")
    row = F.concat_ws(
        ",",
        key,
        F.concat(F.lit('"'), F.col("p_name"), F.lit(',"" '), F.col("p_brand"), F.lit('\n"')),
        F.col("p_type"),
        F.col("p_size").cast("string"),
    )
    row = F.when(F.col("p_partkey") % 10 == 7, F.concat(row, F.lit(",surplus"))).otherwise(row)
    row = F.when(F.col("p_partkey") % 10 == 4, F.concat_ws(",", key, "p_name")).otherwise(row)
    # Ten consecutive keys per text, so the groups are short.
    texts = part.groupBy(F.expr("p_partkey div 10").alias("doc_id")).agg(
        F.sort_array(F.collect_list(F.struct("p_partkey", row.alias("row")))).alias("rows")
    )
    return texts.select(
        "doc_id", F.concat(F.lit(BOM), F.array_join(F.transform("rows", lambda r: r["row"]), "\n")).alias("body")
    )


def csv_files(spark, folder, wide=False):
    """The path of line items as CSV files, a third of the rows over three lines; of the `wide` ones every fiftieth order has a surplus field."""
    items = table(spark, folder, "lineitem")
    text = {c: F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey")}
    quoted = F.concat(F.lit('"'), F.col("l_returnflag"), F.lit('\n""'), F.col("l_linestatus"), F.lit('"",\n"'))
    note = F.when(F.col("l_partkey") % 3 == 0, quoted).otherwise(F.col("l_returnflag"))
    row = F.concat_ws(",", text["l_orderkey"], text["l_partkey"], text["l_linenumber"], note, text["l_suppkey"])
    if wide:
        surplus = F.col("l_orderkey") % 50 == 7
        row = F.when(surplus, F.concat(row, F.lit(",surplus"))).otherwise(row)
        # A file is as wide as its first row: a plain one.
        items = items.sortWithinPartitions(surplus)
    path = scratch_path(spark, "csv")
    items.select(row.alias("value")).write.text(path)
    return path


def text_files(spark, folder):
    """The path of the texts of all documents as files of lines."""
    path = scratch_path(spark, "texts")
    table(spark, folder, "documents").select(F.coalesce("text", F.lit("")).alias("value")).write.text(path)
    return path


def timeseries_blobs(spark, folder, odd=False):
    """CSV text of a hundred consecutive events each, under a header line; `odd` ones have a row with a wrong date and one too wide."""
    events = table(spark, folder, "events")
    row = F.concat_ws(
        ",", F.date_format("ts", "yyyy-MM-dd"), F.col("event_id").cast("string"), F.col("value").cast("string")
    )
    if odd:
        place = F.col("event_id") % 100
        wrong = F.concat(F.lit("2024-13-45,"), F.col("event_id").cast("string"), F.lit(",1"))
        row = F.when(place == 17, wrong).when(place == 31, F.concat(row, F.lit(",9"))).otherwise(row)
    texts = events.groupBy(F.expr("event_id div 100").alias("doc_id")).agg(
        F.sort_array(F.collect_list(F.struct("event_id", row.alias("row")))).alias("rows")
    )
    lines = F.concat(F.array(F.lit("Date,Id,Value")), F.transform("rows", lambda r: r["row"]))
    return texts.select("doc_id", F.array_join(lines, "\n").alias("body"))


def json_documents(spark, folder):
    """Orders as nested JSON text; every hundredth is cut short or repeats a key."""
    o = in_pieces(table(spark, folder, "orders"), "o_orderkey", TEXTS)
    whole = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("id"),
            F.struct(F.col("o_custkey").alias("key"), F.lit(None).cast("string").alias("note")).alias("customer"),
            F.array(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("tags"),
            (F.col("o_totalprice") > 100000).alias("large"),
        ),
        {"ignoreNullFields": "false"},
    )
    left = F.col("o_orderkey") % 100
    raw = (
        F.when(left == 0, F.substr(whole, F.lit(1), F.length(whole) - 1))
        .when(left == 1, F.concat(F.lit('{"id":0,'), F.substr(whole, F.lit(2))))
        .otherwise(whole)
    )
    return o.select(F.col("o_orderkey").alias("doc_id"), raw.alias("raw"))


def xml_documents(spark, folder):
    """Orders as XML text."""
    o = in_pieces(table(spark, folder, "orders"), "o_orderkey", TEXTS)
    body = F.concat(
        F.lit('<?xml version="1.0"?>\n<order id="'),
        F.col("o_orderkey").cast("string"),
        F.lit('" status="'),
        F.col("o_orderstatus"),
        F.lit('"><customer>'),
        F.col("o_custkey").cast("string"),
        F.lit("</customer><!-- note --><price><![CDATA[<"),
        F.col("o_totalprice").cast("string"),
        F.lit(">]]></price><tag>a &amp; b</tag>\n  <tag>"),
        F.col("o_orderpriority"),
        F.lit("</tag>"),
        F.when(F.col("o_orderkey") % 100 == 0, "<open>").otherwise(""),
        F.lit("</order>"),
    )
    return o.select(F.col("o_orderkey").alias("doc_id"), body.alias("raw"))


def url_variants(spark, folder):
    """Page addresses, some with login and port, some with spaces and dot steps."""
    pages = table(spark, folder, "pages")
    kind = F.col("page_id") % 4
    url = (
        F.when(kind == 1, F.regexp_replace("url", "^(https?)://([^/]+)", "$1://user:secret@$2:8080"))
        .when(kind == 2, F.regexp_replace("url", "^(https?://[^/]+)/([a-z]+)/", "$1/a b/../$2/./"))
        .when(kind == 3, F.concat("url", F.lit(" ")))
        .otherwise(F.col("url"))
    )
    return pages.select("page_id", url.alias("url"))


def snapshots(spark, folder):
    """Pages as saved responses with made headers."""
    pages = table(spark, folder, "pages")
    day = (F.col("page_id") % 28 + 1).cast("string")
    headers = F.create_map(
        F.lit("Content-Type"),
        F.lit("text/html; charset=utf-8"),
        F.lit("Content-Length"),
        F.octet_length("html").cast("string"),
        F.lit("Last-Modified"),
        F.concat(F.lit("Mon, "), F.lpad(day, 2, "0"), F.lit(" Jan 2024 10:00:00 GMT")),
        F.lit("X-Page"),
        F.col("page_id").cast("string"),
    )
    return pages.select("page_id", "url", F.lit(200).alias("status"), headers.alias("headers"), "html")


def exchange_files(spark, folder):
    """The path of these responses as files of exchanges, with methods, versions and times; every fiftieth is damaged."""
    pages = snapshots(spark, folder).withColumnsRenamed({"html": "body"}).select(
        "page_id",
        "url",
        "headers",
        F.when(F.col("page_id") % 3 == 0, 404).otherwise(200).alias("status"),
        F.when(F.col("page_id") % 10 == 0, "HEAD").otherwise("GET").alias("method"),
        F.when(F.col("page_id") % 7 == 0, "HTTP/1.0").otherwise("HTTP/1.1").alias("version"),
        F.timestamp_micros(F.lit(1_600_000_000_000_001) + F.col("page_id") * 1_000_003).alias("fetched_at"),
        F.when(F.col("page_id") % 10 != 0, F.col("body")).alias("body"),
    )
    path = scratch_path(spark, "exchanges")
    whole = F.col("page_id") % 50 != 1
    write_exchanges(pages.filter(whole), path)
    record = exchange_text(pages)
    broken = (
        F.when(F.col("page_id") % 150 == 51, F.lit("nothing"))
        .when(F.col("page_id") % 100 == 1, F.replace(record, F.lit(" HTTP/"), F.lit(" FTP/")))
        .otherwise(F.replace(record, F.lit("\r\nHTTP/"), F.lit("\r\nICY/")))
    )
    pages.filter(~whole).select(broken.alias("value")).write.mode("append").option("lineSep", SEPARATOR).text(path)
    return path
