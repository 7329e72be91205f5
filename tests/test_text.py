import datetime

import pytest
from pyspark.sql import functions as F

from tidegrid.functions import clock as K
from tidegrid.functions import headers as H
from tidegrid.functions import text as X
from tidegrid.functions import url as U
from tidegrid.functions.registry import register_functions
from tidegrid.sources import requests as Q
from tidegrid.sources import snapshots as N

URLS = [
    "http://u:p@h.com:8080/a/b?x=1#y",
    "https://h/",
    "https://h",
    "mailto:me@x.org",
    "file:///c/d",
    "ftp://u@h/f;type=i",
    "http://[::1]:9/x",
    "http://h/p@q:r?s@t",
]


def test_crack(values):
    cracked = values(U.crack_url, *URLS, "nonsense", "", None)
    assert tuple(cracked[0]) == ("http", "h.com", 8080, "u", "p", "/a/b", "?x=1#y")
    assert [c and c.port for c in cracked] == [8080, 443, 443, None, None, 21, 9, 80, None, None, None]
    assert cracked[7].path == "/p@q:r" and cracked[5].user == "u"
    assert cracked[8:] == [None, None, None]
    assert values(lambda c: U.crack_url(c, decode=True)["path"], "http://h/a%20b%2Bc+d") == ["/a b+c+d"]


def test_create_inverts_crack(values):
    assert values(lambda c: U.create_url_from_struct(U.crack_url(c)), *URLS) == URLS


def test_create_from_columns_and_maps(spark):
    row = spark.createDataFrame([({"SCHEME": "http", "Host": "h", "port": "81", "path": "/a b"},)], "m map<string,string>")
    first = row.select(U.create_url_from_map("m", escape=True).alias("r")).first()
    assert first.r == "http://h:81/a%20b"
    bare = row.select(U.create_url(F.lit("http"), F.lit("h"), path=F.lit("/x")).alias("r")).first()
    assert bare.r == "http://h/x"


@pytest.mark.parametrize(
    "url, options, want",
    [
        ("http://h/a b/../c/./d?q=é x ", {}, "http://h/c/d?q=%C3%A9%20x"),
        ("http://h/a/..", {}, "http://h/"),
        ("http://h/a/b/.", {}, "http://h/a/b/"),
        ("http://h/../x%20y", {}, "http://h/x%20y"),
        ("http://h/😀<>", {}, "http://h/%F0%9F%98%80%3C%3E"),
        ("http://h/a/../b?x=../y", {}, "http://h/b?x=../y"),
        ("http://h/a/../b", {"no_meta": True}, "http://h/a/../b"),
        ("http://h/é <", {"encode_spaces_only": True}, "http://h/é%20<"),
        ("http://h/é <", {"no_encode": True}, "http://h/é <"),
        ("http://h/a%20b", {"encode_percent": True}, "http://h/a%2520b"),
        ("http://h/a%20b+c", {"decode": True}, "http://h/a%20b+c"),
        ("http://h/a b?é x ", {"browser_mode": True}, "http://h/a%20b?é x "),
        ("http://h/%zz", {"decode": True}, "http://h/%zz"),
    ],
)
def test_canonicalize(values, url, options, want):
    assert values(lambda c: U.canonicalize_url(c, **options), url) == [want]


def test_scheme_class(values):
    given = ["HTTP://x", "gopher:x", "x-y:z", "/path", "javascript:f()"]
    assert values(U.url_scheme_class, *given) == ["http", "gopher", "unknown", "partial", "javascript"]


BLOCK = "Content-Type: text/html\r\nX-A: 1\r\nx-a: 2\r\nAge: 17\r\nDate: Tue, 01 Dec 2026 10:00:00 GMT\r\nReferer: http://h:80/\r\n\r\n"


def test_headers(values):
    def get(name, kind="string"):
        return values(lambda c: H.query_header(H.parse_headers(c), name, kind), BLOCK)[0]

    assert get("content-TYPE") == "text/html" and get("CONTENT_TYPE") == "text/html"
    assert get("X-A") == "1" and get("age", "int") == 17 and get("x-a", "int") == 1
    assert get("Date", "timestamp") == datetime.datetime(2026, 12, 1, 10)
    assert get("ETag") is None and get("Content-Type", "int") is None
    assert get("Referer") == "http://h:80/"


def test_format_headers(spark):
    rows = spark.createDataFrame([({"a": "1", "b": "2"},), (None,), ({},)], "m map<string,string>")
    assert [r.b for r in rows.select(H.format_headers("m").alias("b")).collect()] == ["a: 1\r\nb: 2\r\n\r\n", "", "\r\n"]


def test_standard_headers():
    assert len(H.STANDARD_HEADERS) == len(set(H.STANDARD_HEADERS))
    assert H.header_name("HTTP_QUERY_IF_MODIFIED_SINCE") == "If-Modified-Since"
    assert H.header_name("X-Own") == "X-Own"


def test_views(values):
    text = N.BOM + "ab.cd.ef"
    assert values(lambda c: X.view_slice(c), text) == ["ab.cd.ef"]
    assert values(lambda c: X.view_slice(c, 3, 2), text) == ["cd"]
    assert values(lambda c: X.view_slice(c, 3, "."), text) == ["cd"]
    assert values(lambda c: X.view_slice(c, -1, "."), text, "xyz") == ["ab.cd", "xyz"]
    assert values(lambda c: X.view_slice(c, 50, 2), text) == [""]
    assert values(lambda c: X.view_drop(c, 3), "abcdef", "a") == ["def", ""]
    assert values(lambda c: X.view_drop(c, -3), "abcdef", "a") == ["abc", ""]
    assert values(X.view_len, "aé😀") == [3] and values(X.view_bytes, "aé😀") == [7]


def test_split_lines(spark):
    rows = spark.createDataFrame([(1, N.BOM + "a\n\nbc\n"), (2, "x"), (3, None)], "id int, t string")
    got = [(r.id, r.line_no, r.line) for r in X.split_lines(rows, "t").collect()]
    assert sorted(got) == [(1, 0, "a"), (1, 1, ""), (1, 2, "bc"), (2, 0, "x")]


def test_split_lines_keeps_every_character(spark):
    text = "word " * 300 + "x" * 700 + " end\nshort"
    rows = spark.createDataFrame([(1, text)], "id int, t string")
    lines = [r.line for r in X.split_lines(rows, "t", 255).orderBy("line_no").collect()]
    assert max(map(len, lines)) <= 255
    assert "".join(lines).replace(" ", "") == text.replace(" ", "").replace("\n", "")
    assert lines[-1] == "short"


def test_times(values):
    ny = "America/New_York"
    assert values(lambda c: K.mktime(c.cast("timestamp_ntz"), ny), "2021-01-01", "2021-02-01", "2021-07-01") == [
        1609477200,
        1612155600,
        1625112000,
    ]
    assert values(lambda c: K.localtime(c, ny), 1609477200, 1625112000, kind="long") == [
        datetime.datetime(2021, 1, 1),
        datetime.datetime(2021, 7, 1),
    ]


def test_network_times(values):
    stamps = values(lambda c: K.timestamp_to_ntp(c.cast("timestamp")), "2021-01-01 00:00:00.25", "1900-01-01 00:00:00")
    assert [tuple(s) for s in stamps] == [(3818448000, 1 << 30), (0, 0)]
    given = "2021-01-01 00:00:00.123457"

    def there_and_back(c):
        s = K.timestamp_to_ntp(c.cast("timestamp"))
        return K.ntp_to_timestamp(s["seconds"], s["fraction"])

    assert values(there_and_back, given) == [datetime.datetime.fromisoformat(given)]


def test_request_urls(spark):
    rows = spark.createDataFrame([("SPY", "d"), ("^A B", "y"), ("Z", None)], "s string, p string")
    days = [F.lit(d).cast("timestamp_ntz") for d in ("2021-01-01", "2021-02-01")]
    first = Q.yahoo_request_urls(rows, "s", *days, zone="America/New_York").first()
    assert first.request_url == (
        "https://query1.finance.yahoo.com/v7/finance/download/SPY?period1=1609477200&period2=1612155600&interval=1d"
    )
    quoted = Q.yahoo_request_urls(rows, "s", *days, history=True).collect()[1].request_url
    assert "/%5EA%20B?" in quoted and quoted.endswith("&interval=1d&events=history")
    assert Q.yahoo_request_urls(rows, "s", days[0]).first().request_url is not None
    urls = [r.request_url for r in Q.eod_request_urls(rows, "s", "T", days[0], None, F.col("p")).collect()]
    assert urls[0].endswith("/SPY?api_token=T&from=2021-01-01&period=d&order=a")
    assert urls[1] is None and urls[2].endswith("/Z?api_token=T&from=2021-01-01&order=a")


def test_snapshots_from_files(spark, tmp_path):
    (tmp_path / "a.html").write_bytes(b"\xef\xbb\xbfhi")
    (row,) = N.read_snapshots(spark, str(tmp_path), "binaryFile").withColumn("t", N.body_text()).collect()
    assert row.t == "hi" and row.url.endswith("a.html") and row.headers is None and row.fetched_at


def test_sql_functions(spark):
    names = register_functions(spark)
    assert {"crack_url", "json_type", "split_lines", "parse_html", "parse_xml"} <= set(names)
    one = spark.sql("""
        SELECT crack_url('http://u:p@h:8080/a?b') AS c, crack_url('bad') AS bad, create_url(crack_url('https://h/x')) AS u,
          match_wildcard('a.B*', 'A.?~*') AS m, match_wildcard('aXB*', 'A.?~*') AS n, json_type(parse_json('[1]')) AS t,
          json_quote('a"') AS q, format_headers(map('a', '1')) AS h, query_header(map('Ab', '1'), 'aB') AS v,
          mktime(timestamp_ntz'2021-01-01', 'America/New_York') AS s, localtime_of(0, 'UTC') AS z,
          ntp_to_timestamp(2208988801, 2147483648) AS w, json_path_join(json_path_split('.a.0')) AS p,
          timestamp_to_ntp(timestamp'2021-01-01 00:00:00.25').fraction AS f, format_return(0.25D) AS r""").first()
    assert (one.f, one.r) == (1 << 30, "+0.2%")
    assert tuple(one.c) == ("http", "h", 8080, "u", "p", "/a", "?b") and one.bad is None and one.u == "https://h/x"
    assert (one.m, one.n, one.t, one.q, one.h, one.v) == (True, False, "array", '"a\\""', "a: 1\r\n\r\n", "1")
    assert (one.s, one.z, one.p) == (1609477200, datetime.datetime(1970, 1, 1), ".a.0")
    assert one.w == datetime.datetime(1970, 1, 1, 0, 0, 1, 500000)
    lines = spark.sql("SELECT l.* FROM VALUES ('a\\nb\\n') AS d(t), LATERAL split_lines(t) l").collect()
    assert [tuple(r) for r in lines] == [(0, "a"), (1, "b")]
    nodes = spark.sql("SELECT n.path FROM VALUES ('<a><b/></a>') AS d(t), LATERAL parse_xml(t) n").collect()
    assert [r.path for r in nodes] == ["/a", "/a/b"]


def test_keys_of_deep_and_broken_texts(spark):
    from tidegrid.functions.json import json_keys

    deep = "[" * 30 + "1" + "]" * 30
    rows = [(1, "[" * 400), (2, deep), (3, '{"a":{"b":1}}'), (4, None), (5, "{" * 90 + "]")]
    found = json_keys(spark.createDataFrame(rows, "id int, raw string"), "raw").collect()
    assert sorted(r.path for r in found if r.id == 3) == [".a", ".a.b"]
    assert sorted(len(r.path) for r in found if r.id == 2) == [2 * n for n in range(1, 31)]
    assert {r.type for r in found if r.id == 2} == {"array", "number"}
    assert {r.id for r in found} == {2, 3}


def test_sql_names_agree_with_their_python_forms(spark):
    from tidegrid.functions.headers import query_header, response_field
    from tidegrid.functions.json import json_path_join
    from tidegrid.functions.registry import register_functions
    from tidegrid.operators.tables import match_wildcard

    register_functions(spark)
    texts = ["a~", "a", "a*", "axb", "~", "a~b", "ab", "A?"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for pattern in ["a~", "a~*", "a*", "~~", "~a", "a~~b", "a?", "*~?"]:
        rows = frame.select(match_wildcard("t", pattern).alias("p"), F.call_function("match_wildcard", F.col("t"), F.lit(pattern)).alias("s")).collect()
        assert [r.p for r in rows] == [r.s for r in rows], pattern
    one = spark.createDataFrame([({"Content-Type": "x"}, 404, [])], "h map<string,string>, status int, none array<string>")
    for name in ["CONTENT_TYPE", "HTTP_QUERY_CONTENT_TYPE", "content-type", "a_b", "Server"]:
        (row,) = one.select(query_header("h", name).alias("p"), F.call_function("query_header", F.col("h"), F.lit(name)).alias("s")).collect()
        assert row.p == row.s, name
    (row,) = one.select(json_path_join("none").alias("p"), F.expr("json_path_join(none)").alias("s")).collect()
    assert row.p == row.s == ""
    fields = {n: one.select(response_field(n, "h", "status")).first()[0] for n in ["STATUS_CODE", "STATUS_TEXT", "RAW_HEADERS_CRLF", "CONTENT_TYPE"]}
    assert fields == {
        "STATUS_CODE": "404",
        "STATUS_TEXT": "Not Found",
        "RAW_HEADERS_CRLF": "HTTP/1.1 404 Not Found\r\nContent-Type: x\r\n\r\n",
        "CONTENT_TYPE": "x",
    }
