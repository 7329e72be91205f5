import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidegrid.functions import json as J
from tidegrid.operators import tables as T
from tidegrid.sources import csvtext as C
from tidegrid.sources import jsontext as P


def test_convert(values):
    def to(kind, *cells):
        return values(lambda c: T.convert_cell(c, kind), *cells)

    assert to("num", "1.5", " -2e3 ", "x", "1d", "NaN", "", None) == [1.5, -2000, None, None, None, None, None]
    assert to("int", "1.9", "-1.9", "3000000000", "x") == [1, -1, None, None]
    assert to("bool", "TRUE", "false", "0", "0.1", "x") == [True, False, False, True, None]
    assert to("date", "2021-03-04", "2021-03-04 05:06:07", "3/4/2021", "44259", "2021-13-01", "x", "25569") == [
        *[datetime.date(2021, 3, 4)] * 4,
        None,
        None,
        datetime.date(1970, 1, 1),
    ]
    assert to("time", "12:00", "06:00:36", "24:00", "x") == [0.5, pytest.approx(0.250416666), None, None]
    assert to("str", " a ") == ["a"]
    with pytest.raises(ValueError):
        T.convert_cell("v", "blob")


def test_errors_and_profiles(spark):
    rows = spark.createDataFrame([("1", "true", 1), ("x", "2021-01-01", 2), (None, " ", 1)], "a string, b string, k int")
    errors = T.conversion_errors(rows, {"a": "num", "b": "bool"}).collect()
    assert sorted(map(tuple, errors)) == [("a", 1), ("b", 2)]
    profile = {(r.column, r.type): r.cells for r in T.type_profile(rows).collect()}
    assert profile == {("a", "num"): 1, ("a", "str"): 1, ("a", "nil"): 1, ("b", "bool"): 1, ("b", "date"): 1, ("b", "nil"): 1}
    shape = {r.k: (r.n_rows, r.n_columns, r.n_cells) for r in T.shape_profile(rows, "k").collect()}
    assert shape == {1: (2, 2, 4), 2: (1, 2, 2)}


@pytest.mark.parametrize(
    "text, pattern, want",
    [
        ("a Red*", "*r?d~*", True),
        ("a Redx", "*r?d~*", False),
        ("line\nbreak", "line*", True),
        ("a.c", "a.c", True),
        ("abc", "a.c", False),
        ("a~b", "a~~b", True),
        ("what?", "what~?", True),
        ("whats", "what~?", False),
        ("ÄB", "äb", True),
        ("ab", "a", False),
    ],
)
def test_wildcard(values, text, pattern, want):
    assert values(lambda c: T.match_wildcard(c, pattern), text) == [want]


def test_lookup_takes_the_first_in_any_case(spark):
    table = spark.createDataFrame([("Host", "b", 2), ("HOST", "a", 1), ("port", "p", 3)], "k string, v string, n int")
    wanted = spark.createDataFrame([("host",), ("Port",), ("x",), (None,)], "key string")
    found = T.lookup_first(wanted, "key", table, "k", "v", "n")
    assert {r.key: r.v for r in found.collect()} == {"host": "a", "Port": "p", "x": None, None: None}


def test_joins_are_not_forced(spark):
    table = spark.createDataFrame([("Host", "b", 2)], "k string, v string, n int")
    found = T.lookup_first(spark.createDataFrame([("host",)], "key string"), "key", table, "k", "v", "n")
    plan = found._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan and "Limit" not in plan


def test_smallest_int(spark, values):
    assert values(lambda c: T.convert_cell(c, "int"), "-2147483648", "-2147483649", "2147483647.9", "2147483648") == [-2147483648, None, 2147483647, None]


def csv_rows(spark, body, **options):
    frame = spark.createDataFrame([(1, body)], "id int, body string")
    return [r.fields for r in C.parse_csv(frame, "body", **options).orderBy("row_no").collect()]


def test_csv_traps(spark):
    body = '﻿a,b,c\r\n1,"x,y\nz","q""r"\r\n2,\\"v\\,w\r\n3,4,5,6\r\n"",\\\\n,""""\n'
    assert csv_rows(spark, body) == [["a", "b", "c"], ["1", "x,y\nz", 'q"r'], ["2", '"v,w', None], ["", "\\n", '"']]
    frame = spark.createDataFrame([(1, body)], "id int, body string")
    (wide,) = C.csv_quarantine(frame, "body").collect()
    assert (wide.row_no, wide.fields, wide.n_fields, wide.width) == (3, ["3", "4", "5", "6"], 4, 3)


def test_csv_options(spark):
    body = "h|i;1|2;3|4;5|6;"
    assert csv_rows(spark, body, rs=";", fs="|", header=True, offset=1, count=1) == [["3", "4"]]
    frame = spark.createDataFrame([(1, body), (2, ""), (3, None)], "id int, body string")
    named = C.parse_csv(frame, "body", columns=["h", "i", "j"], rs=";", fs="|", header=True).collect()
    assert [(r.h, r.i, r.j) for r in named] == [("1", "2", None), ("3", "4", None), ("5", "6", None)]


def test_csv_against_the_standard_reader(spark):
    import csv
    import io

    rng = random.Random(5)
    for _ in range(3):
        rows = [["".join(rng.choice('ab ,"\n') for _ in range(rng.randrange(6))) for _ in range(4)] for _ in range(40)]
        out = io.StringIO()
        csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows(rows)
        assert csv_rows(spark, out.getvalue()) == rows


def test_csv_timeseries(spark):
    frame = spark.createDataFrame([(1, "Date,A\nnote\n2021-01-04,1.5,x\n1/5/2021,2\n44202,3,4\n")], "id int, body string")
    rows = C.parse_csv_timeseries(frame, "body", ["a", "b"]).orderBy("row_no").collect()
    assert [(r.date.day, r.a, r.b) for r in rows] == [(4, 1.5, None), (5, 2.0, None), (6, 3.0, 4.0)]


def test_json_types(values):
    texts = ['{"a":1}', "{}", "[1]", "[]", '"s"', '""', "1.23", "true", "null", "bad{", None]
    want = ["object", "object", "array", "array", "string", "string", "number", "boolean", "null", "error", "error"]
    assert values(lambda c: J.json_type(F.try_parse_json(c)), *texts) == want
    assert values(lambda c: J.json_type(F.try_parse_json(c)), "1", "1e300", "12345678901234567890123") == ["number"] * 3


def test_json_values(values):
    def at(key, text, kind="string", **options):
        return values(lambda c: J.json_value(F.try_parse_json(c), key, kind, **options), text)[0]

    nested = '{"a":{"b":2},"b":1.23}'
    assert (at(".a.b", nested), at(".b", nested), at(".a", nested), at(".c", nested)) == ("2", "1.23", '{"b":2}', None)
    assert at(["a", 1], '{"a":[5,6]}', "int") == 6 and at(".a.0", '{"a":[5,6]}', "int") == 5 and at(1, "[5,6]", "int") == 6
    assert at(".A.b", '{"a":{"B":2}}') is None
    assert at(".A.b", '{"a":{"B":2}}', "int", ignore_case=True) == 2
    assert at("x y", '{"x y":"z"}') == "z" and at("it's", '{"it\'s":1}', "int") == 1
    assert J.path_segments(".a.0.1") == ["a", 0, 1]


def test_json_text(values, spark):
    texts = ['["a",1,true]', '{"a":{"b":null},"b":true}', '{"a":"q\\"r"}']
    assert values(lambda c: J.json_stringify(F.try_parse_json(c)), *texts) == texts
    assert values(lambda c: J.json_array(c, F.lit(1), F.lit(True), F.lit(None).cast("string")), 'a"b') == ['["a\\"b",1,true,null]']
    assert values(J.json_quote, 'a"b', "\\\n") == ['"a\\"b"', '"\\\\\\n"']
    assert values(lambda c: J.json_path_join(J.json_path_split(c)), ".a.b.c", ".a.0.1") == [".a.b.c", ".a.0.1"]
    assert spark.range(1).select(J.json_object(F.lit(1).alias("a"), F.lit(None).cast("int").alias("b"))).first()[0] == '{"a":1,"b":null}'


def keys_of(value, path=""):
    items = value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ()
    for key, inner in items:
        yield f"{path}.{key}"
        yield from keys_of(inner, f"{path}.{key}")


def test_json_keys(spark):
    import json

    documents = [
        {"a": {"b": [1, {"c": "}["}], "x y": None}, "d": {"e": {"f": {"g": {"h": {"i": [[[]]]}}}}}},
        [[], {}, [{"z": 1}]],
        {},
        7,
    ]
    frame = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)] + [(9, "bad{")], "id int, raw string")
    found = sorted((r.id, r.path) for r in J.json_keys(frame, "raw").collect())
    assert found == sorted((i, p) for i, d in enumerate(documents) for p in keys_of(d))
    narrow = J.json_keys(frame, "raw", "?").collect()
    assert ".a.x y" not in {r.path for r in narrow} and ".a.b.1.c" in {r.path for r in narrow}
    assert J.json_keys(frame, "raw", "D").count() == 1
    inventory = {(r.path, r.type): r.documents for r in J.json_key_inventory(frame, "raw").collect()}
    assert inventory[".a.x y", "null"] == 1
    with pytest.raises(Exception, match="nests deeper"):
        J.json_keys(frame, "raw", max_depth=4).collect()


def test_json_ingest(spark):
    frame = spark.createDataFrame([(1, '{"a":1}'), (2, "bad"), (3, '{"a":1,"a":2}'), (4, None)], "id int, raw string")
    assert sorted(r.id for r in P.parse_json(frame, "raw").select("id").collect()) == [1, 4]
    assert sorted(r.id for r in P.json_quarantine(frame, "raw").collect()) == [2, 3]


def test_repeated_keys(values):
    texts = ['{"a":1,"a":2}', '{"a":1}', "[1]", "bad"]
    assert values(J.has_duplicate_keys, *texts) == [True, False, None, None]
    assert values(lambda c: J.json_first_value(c, ".a"), *texts[:2]) == ["1", "1"]


def test_file_readers(spark, tmp_path):
    from tidegrid.sources.markup import read_xml_rows

    (tmp_path / "a.csv").write_text('1,"x\ny"\n2,z,w\n')
    rows = C.read_csv_files(spark, str(tmp_path / "a.csv"), "a int, b string").orderBy("a").collect()
    assert [(r.a, r.b) for r in rows] == [(1, "x\ny"), (2, "z")] and rows[1]._corrupt
    (tmp_path / "a.json").write_text('{"a":1}\n{"a":2}\n')
    assert P.read_json_files(spark, str(tmp_path / "a.json"), "a int").count() == 2
    (tmp_path / "a.xml").write_text("<r><i><v>1</v></i><i><v>2</v></i></r>")
    assert [r.v for r in read_xml_rows(spark, str(tmp_path / "a.xml"), "i", "v int").collect()] == [1, 2]


def test_broken_csv_rows_are_held_back(spark):
    body = 'a,b\n1,2\n5" pipe,x\n3,4\n'
    frame = spark.createDataFrame([(1, body), (2, 'a,b\n"x,y",z\n')], "id int, body string")
    assert sorted((r.id, r.fields) for r in C.parse_csv(frame, "body").collect()) == [(1, ["1", "2"]), (1, ["a", "b"]), (2, ["a", "b"]), (2, ["x,y", "z"])]
    (held,) = C.csv_quarantine(frame, "body").collect()
    assert held.id == 1 and held.row_no == 2
    dated = spark.createDataFrame([(1, "Date,v\n2021-01-02,1\n2021-13-45,2\n2021-01-03,1,2\n2021-01-04,x\n")], "id int, body string")
    assert [(str(r.date), r.v) for r in C.parse_csv_timeseries(dated, "body", ["v"]).orderBy("row_no").collect()] == [("2021-01-02", 1.0), ("2021-01-04", None)]
    assert sorted(r.row_no for r in C.timeseries_quarantine(dated, "body", ["v"]).collect()) == [2, 3]


def test_json_keys_keep_only_what_is_still_open(spark, monkeypatch):
    # The first job reads all texts and opens few levels; of its nodes only objects and arrays keep their value.
    stored = []
    keep = lambda frame, name: stored.append(frame) or frame
    monkeypatch.setattr(J, "store", keep)
    texts = ['{"a":{"b":{"c":{"d":1}}},"e":2}', '{"a":1}']
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, raw string")
    found = sorted((r.doc_id, r.path, r.type) for r in J.json_keys(frame, "raw").collect())
    assert found == [
        (0, ".a", "object"), (0, ".a.b", "object"), (0, ".a.b.c", "object"), (0, ".a.b.c.d", "number"), (0, ".e", "number"), (1, ".a", "number")
    ]
    held = stored[0].where("node.value IS NOT NULL").select("node.path").collect()
    assert len(stored) == 1 and [r.path for r in held] == [".a.b"]
