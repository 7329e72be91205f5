import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from tidegrid.functions.headers import response_field
from tidegrid.sources import exchanges as E

FORM = "url string, fetched_at timestamp, status int, headers map<string,string>, body binary, method string, version string"


def test_round_trip_over_many_tasks(spark, tmp_path):
    """Bodies of any bytes come back row for row, however the files are cut."""
    r = random.Random(4)
    parts = [b"\r\n", b"\r\n\r\n", b"\x1e", b"\x1eexch", b"\x1eexchange\x1f", b"\n", b"HTTP/1.1 200 OK", b"\xff\xfe\x00", "é€𝒳".encode(), b"word "]
    rows = []
    for i in range(400):
        body = bytearray(re.sub(b"\x1f\n+", b"\x1f", b"".join(r.choices(parts, k=r.choice([0, 1, 7, 60, 900 if i % 50 == 0 else 3])))))
        time = datetime.datetime(2024, 1, 1) + datetime.timedelta(microseconds=r.randrange(10**15))
        headers = {"X-Id": str(i), "Set-Cookie": "a=b: c; d", "Empty": "", "Name": "é"} if i % 3 else {}
        rows.append((f"https://h.example/{i}?a b", time, r.choice([None, 200, 404, 799]), headers, body if i % 7 else None, r.choice(["GET", "POST"]), r.choice(["HTTP/1.0", "HTTP/2"])))
    frame = spark.createDataFrame(rows, FORM)
    path = str(tmp_path / "saved")
    E.write_exchanges(frame.coalesce(2), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 3000)
    try:
        found = E.read_exchanges(spark, path)
        assert found.rdd.getNumPartitions() > 20
        found = {r.url: r for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(found) == len(rows) and E.exchange_quarantine(spark, path).count() == 0
    for row in frame.collect():
        got = found[row.url].asDict()
        got.pop("raw_headers")
        assert got == row.asDict(), row.url


def test_nulls_defaults_and_lines_in_values(spark, tmp_path):
    path = str(tmp_path / "saved")
    rows = [(None, None, None, None, None, None, None), ("a\r\nb", None, 200, {"A": "x\r\n y", "B": None}, bytearray(b""), None, None)]
    E.write_exchanges(spark.createDataFrame(rows, FORM).withColumn("value", F.lit(1)), path)
    found = sorted(E.read_exchanges(spark, path).collect(), key=lambda r: str(r.url))
    assert [tuple(r) for r in found] == [
        (None, None, None, {}, None, "GET", "HTTP/1.1", "HTTP/1.1\r\n"),
        ("a%0D%0Ab", None, 200, {"A": "x  y"}, bytearray(b""), "GET", "HTTP/1.1", "HTTP/1.1 200 OK\r\nA: x  y\r\n"),
    ]
    E.write_exchanges(spark.createDataFrame([], "url string, body binary"), str(tmp_path / "none"))
    assert E.read_exchanges(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="separator"):
        E.write_exchanges(spark.createDataFrame([("u", E.SEPARATOR)], "url string, body string"), str(tmp_path / "bad"))
    with pytest.raises(Exception, match="separator"):
        E.write_exchanges(spark.createDataFrame([("u", "a=")], "url string, body string"), str(tmp_path / "worse"), "==")
    E.write_exchanges(spark.createDataFrame([("u", E.SEPARATOR)], "url string, body string"), str(tmp_path / "other"), "\x1e=\x1f")
    (row,) = E.read_exchanges(spark, str(tmp_path / "other"), "\x1e=\x1f").collect()
    assert bytes(row.body) == E.SEPARATOR.encode()


def test_quarantine_and_fields(spark, tmp_path):
    texts = [
        "GET u HTTP/1.1\r\n\r\nHTTP/1.1 200 OK\r\nA: 1\r\nA: 2\r\na: 3\r\nno colon\r\n\r\nbody",
        "no end",
        "",
        "GET u\r\n\r\nHTTP/1.1 200 OK\r\n\r\n",
        "GET u HTTP/1.1\r\n\r\n<html>",
        "GET u HTTP/1.1\r\nx-fetched-at: soon\r\n\r\nHTTP/1.1 99 OK\r\n\r\n",
        "GET u HTTP/1.1\r\nx-fetched-at: soon\r\n\r\nHTTP/1.1 204\r\n\r\n",
    ]
    path = str(tmp_path / "saved")
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.option("lineSep", E.SEPARATOR).text(path)
    found = E.read_exchanges(spark, path)
    rows = found.orderBy("status").collect()
    assert [(r.status, r.headers, bytes(r.body), r.fetched_at) for r in rows] == [(200, {"A": "1", "a": "3"}, b"body", None), (204, {}, b"", None)]
    assert rows[0].raw_headers == "HTTP/1.1 200 OK\r\nA: 1\r\nA: 2\r\na: 3\r\nno colon\r\n"
    wrong = {r.record: r.reason for r in E.exchange_quarantine(spark, path).collect()}
    assert wrong == {texts[1]: "no end of the request", "": "no end of the request", texts[3]: "request line", texts[4]: "status line", texts[5]: "status line"}
    fields = [response_field(n, "headers", "status", "version", "method") for n in ("VERSION", "REQUEST_METHOD", "RAW_HEADERS_CRLF")]
    assert tuple(found.filter("status = 204").select(*fields).first()) == ("HTTP/1.1", "GET", "HTTP/1.1 204 No Content\r\n\r\n")
    assert found.select(response_field("VERSION", "headers", "status")).first()[0] is None
