"""Response headers."""

from http import HTTPStatus

from pyspark.sql import functions as F

# Standard header names, as used for lookups by number or name.
STANDARD_HEADERS = """
Accept Accept-Charset Accept-Encoding Accept-Language Accept-Ranges Age Allow Authorization Cache-Control
Connection Content-Base Content-Description Content-Disposition Content-Encoding Content-ID Content-Language
Content-Length Content-Location Content-MD5 Content-Range Content-Transfer-Encoding Content-Type Cookie Cost
Date Derived-From ETag Expect Expires Forwarded From Host If-Match If-Modified-Since If-None-Match If-Range
If-Unmodified-Since Last-Modified Link Location Max-Forwards Message-ID MIME-Version Orig-URI Pragma
Proxy-Authenticate Proxy-Authorization Proxy-Connection Public Range Referer Refresh Retry-After Server
Set-Cookie Title Transfer-Encoding Unless-Modified-Since Upgrade URI User-Agent Vary Via Warning
WWW-Authenticate X-Content-Type-Options P3P X-P2P-PeerDist X-UA-Compatible Default-Style X-Frame-Options
X-XSS-Protection
""".split()


def _column(value):
    return F.col(value) if isinstance(value, str) else value


def header_name(name):
    """The header of a constant-style name such as `CONTENT_TYPE`, or the name itself."""
    by_constant = {h.replace("-", "_").upper(): h for h in STANDARD_HEADERS}
    return by_constant.get(name.upper().removeprefix("HTTP_QUERY_"), name)


def response_field(name, headers, status, version=None, method=None):
    """What a response has besides single headers, by its constant-style name.

    `STATUS_CODE`, `STATUS_TEXT`, `RAW_HEADERS` (lines ended by a zero
    character), `RAW_HEADERS_CRLF`, `VERSION` and `REQUEST_METHOD`, from the
    header map and the status number of a saved response, and the columns of
    its version and method where these were saved; any other name is a header.
    Blocks of a response without a saved version say HTTP/1.1.
    """
    headers, status = _column(headers), _column(status)
    phrases = F.create_map(*[F.lit(x) for s in HTTPStatus for x in (s.value, s.phrase)])
    phrase = F.coalesce(F.try_element_at(phrases, status.cast("int")), F.lit(""))
    wanted = name.upper().removeprefix("HTTP_QUERY_")
    if wanted == "STATUS_CODE":
        return status.cast("string")
    if wanted == "STATUS_TEXT":
        return F.when(status.isNotNull(), phrase)
    saved = {"VERSION": version, "REQUEST_METHOD": method}
    if wanted in saved:
        return F.lit(None).cast("string") if saved[wanted] is None else _column(saved[wanted])
    if wanted in ("RAW_HEADERS", "RAW_HEADERS_CRLF"):
        version = F.lit("HTTP/1.1") if version is None else _column(version)
        first = F.concat(version, F.lit(" "), status.cast("string"), F.lit(" "), phrase, F.lit("\r\n"))
        block = F.concat(first, format_headers(headers))
        return block if wanted == "RAW_HEADERS_CRLF" else F.replace(block, F.lit("\r\n"), F.lit("\0"))
    return query_header(headers, name)


def format_headers(headers):
    """A map as a header block of `key: value` lines and an empty line; null gives no text."""
    headers = _column(headers)
    lines = F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"], F.lit("\r\n")))
    return F.when(headers.isNull(), "").otherwise(F.concat(F.array_join(lines, ""), F.lit("\r\n")))


def parse_headers(block):
    """A header block as a map with lower-case names; of a repeated name the first counts."""
    lines = F.filter(F.split(_column(block), "\r?\n"), lambda line: line.contains(":"))
    pairs = F.transform(
        lines,
        lambda line: F.struct(
            F.lower(F.trim(F.substring_index(line, ":", 1))).alias("key"),
            F.trim(F.regexp_replace(line, r"\A[^:]*:", "")).alias("value"),
        ),
    )
    first = F.filter(
        pairs, lambda pair, i: F.array_position(F.transform(pairs, lambda p: p["key"]), pair["key"]) == i + 1
    )
    return F.map_from_entries(first)


def query_header(headers, name, as_type="string"):
    """The value of a header, by name in any case: `string`, `int` or `timestamp`."""
    folded = F.filter(F.map_entries(_column(headers)), lambda e: F.lower(e["key"]) == header_name(name).lower())
    value = F.get(folded, F.lit(0))["value"]
    if as_type == "int":
        return F.trim(value).try_cast("int")
    if as_type == "timestamp":
        # The weekday in front is not checked.
        return F.try_to_timestamp(F.substring(F.trim(value), 6, 100), F.lit("dd MMM yyyy HH:mm:ss z"))
    return value
