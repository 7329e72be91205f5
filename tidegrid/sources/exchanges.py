"""Files of saved exchanges: request, response head and body of many responses in each file."""

from pyspark.sql import functions as F

from tidegrid.functions.headers import response_field

SEPARATOR = "\x1eexchange\x1f\n"
LINE = "\r\n"
EMPTY_LINE = "\r\n\r\n"
FETCHED = "X-Fetched-At"


def _one_line(text):
    return F.trim(F.regexp_replace(text, "[\r\n]+", " "))


def _header_lines(headers):
    lines = F.transform(F.map_entries(headers), lambda e: F.concat(_one_line(e["key"]), F.lit(": "), _one_line(e["value"]), F.lit(LINE)))
    return F.coalesce(F.array_join(lines, ""), F.lit(""))


def exchange_text(frame):
    """Each row as one record: request line, time, empty line, status line, headers, empty line, body."""
    given = {c: F.col(c) if c in frame.columns else F.lit(None) for c in ("url", "fetched_at", "status", "headers", "body", "method", "version")}
    version = F.coalesce(given["version"].cast("string"), F.lit("HTTP/1.1"))
    url = F.replace(F.replace(F.coalesce(given["url"].cast("string"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    time = F.concat(F.lit(f"{FETCHED}: "), F.unix_micros(given["fetched_at"].cast("timestamp")).cast("string"), F.lit(LINE))
    status = given["status"].cast("int")
    phrase = response_field("STATUS_TEXT", F.lit(None).cast("map<string,string>"), status)
    request = F.concat(F.coalesce(given["method"].cast("string"), F.lit("GET")), F.lit(" "), url, F.lit(" "), version, F.lit(LINE), F.coalesce(time, F.lit("")))
    line = F.concat(version, F.coalesce(F.concat(F.lit(" "), F.lpad(status.cast("string"), 3, "0"), F.lit(" "), phrase), F.lit("")), F.lit(LINE))
    headers = _header_lines(given["headers"].cast("map<string,string>"))
    body = F.coalesce(F.concat(F.lit(LINE), given["body"].cast("binary").cast("string")), F.lit(""))
    return F.concat(request, F.lit(LINE), line, headers, body)


def write_exchanges(frame, path, separator=SEPARATOR, mode="errorifexists"):
    """Write snapshots (`url, fetched_at, status, headers, body`, and `method`, `version` where given) as files of records.

    Records end with `separator`; a record that holds it, or whose end would
    begin it, fails the write, and another separator can be chosen. Bodies are kept byte for byte. A missing
    method is GET, a missing version HTTP/1.1; a null status, time or body is
    left out, as is a header with a null value; line ends inside headers become
    a space, in addresses %0D and %0A. Names of headers hold no colon.
    """
    record = exchange_text(frame)
    safe = F.when(F.concat(record, F.lit(separator[:-1])).contains(separator), F.raise_error(F.lit("a record holds the separator"))).otherwise(record)
    frame.select(safe.alias("value")).write.mode(mode).option("lineSep", separator).text(path)


def _records(spark, path, separator):
    """The parts of each record; those of one that is not well formed are null.

    Spark's text reader cuts large files between records, on any file system.
    All searches are for bytes, so a body need not be text.
    """
    raw = spark.read.option("lineSep", separator).text(path)

    def after(text, head):
        return F.substring(text.cast("binary"), F.octet_length(head) + 5, F.octet_length(text))

    asked = raw.select(F.col("value").alias("record"), F.substring_index("value", EMPTY_LINE, 1).alias("request"))
    rest = asked.withColumn("rest", after(F.col("record"), F.col("request")).cast("string"))
    # A response without a body ends behind its last header line.
    heads = rest.withColumn("head", F.substring_index("rest", EMPTY_LINE, 1))
    first = F.substring_index("request", LINE, 1)
    line = F.substring_index("head", LINE, 1)
    asked_for, answered = r"\A(\S+) (.*) (HTTP/\S+)\z", r"\A(HTTP/\S+)(?: ([0-9]{3})(?: (.*))?)?\z"
    good_request, good_line = first.rlike(asked_for), line.rlike(answered)
    reason = (
        F.when(~F.contains("record", F.lit(EMPTY_LINE)), "no end of the request")
        .when(~good_request, "request line")
        .when(~good_line, "status line")
    )
    return heads.select(
        "record",
        reason.alias("reason"),
        F.nullif(F.regexp_extract(first, asked_for, 2), F.lit("")).alias("url"),
        F.timestamp_micros(F.regexp_extract("request", rf"(?i)\r\n{FETCHED}: *(-?[0-9]+)(?:\r|\z)", 1).try_cast("long")).alias("fetched_at"),
        F.regexp_extract(line, answered, 2).try_cast("int").alias("status"),
        header_map(F.substr("head", F.length(line) + 3)).alias("headers"),
        F.when(F.contains("rest", F.lit(EMPTY_LINE)), after(F.col("rest"), F.col("head"))).alias("body"),
        F.regexp_extract(first, asked_for, 1).alias("method"),
        F.regexp_extract(line, answered, 1).alias("version"),
        F.when(F.endswith("head", F.lit(LINE)), F.col("head")).otherwise(F.concat("head", F.lit(LINE))).alias("raw_headers"),
    )


def header_map(block):
    """Header lines as a map with the names as they stand; of a repeated name the first counts."""
    lines = F.filter(F.split(block, LINE), lambda line: line.contains(":"))
    names = F.transform(lines, lambda line: F.trim(F.substring_index(line, ":", 1)))
    values = F.transform(lines, lambda line: F.trim(F.regexp_replace(line, r"\A[^:]*:", "")))
    pairs = F.arrays_zip(names.alias("key"), values.alias("value"))
    return F.map_from_entries(F.filter(pairs, lambda pair, i: F.array_position(names, pair["key"]) == i + 1))


def read_exchanges(spark, path, separator=SEPARATOR):
    """Saved exchanges as snapshots with `method`, `version` and `raw_headers`, one row per well-formed record.

    `raw_headers` is the status line and all header lines as they stand, so
    repeated headers are there. A record without body has a null body; one
    without header lines an empty map.
    """
    return _records(spark, path, separator).filter("reason IS NULL").drop("record", "reason")


def exchange_quarantine(spark, path, separator=SEPARATOR):
    """The records that are not exchanges, as they stand, and the reason."""
    return _records(spark, path, separator).filter("reason IS NOT NULL").select("record", "reason")
