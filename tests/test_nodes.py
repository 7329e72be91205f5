"""Node tables, and location paths against the standard library's tree."""

import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from tidegrid.operators import axes
from tidegrid.operators import nodes as N
from tidegrid.operators import xpath as X
from tidegrid.plans import inputs, node_queries
from tidegrid.sources import markup as M

XML = '<a x="1"><!--c--><b>t1<c/>t2</b> <b y="2" x="1"><![CDATA[<z>]]></b><?pi d?></a>'


def table(spark, text, read=M.parse_xml, **options):
    frame = spark.createDataFrame([(1, text)], "id long, t string")
    return read(frame, "id", "t", **options)


def paths(frame):
    return [r.path for r in frame.orderBy("node_id").collect()]


@pytest.fixture(scope="module")
def xml(spark):
    nodes = table(spark, XML)
    return spark.createDataFrame(nodes.collect(), nodes.schema)


def test_xml_nodes(xml):
    assert paths(xml) == [
        "/a",
        "/a/comment()",
        "/a/b[1]",
        "/a/b[1]/text()[1]",
        "/a/b[1]/c",
        "/a/b[1]/text()[2]",
        "/a/text()",
        "/a/b[2]",
        "/a/b[2]/text()",
        "/a/processing-instruction('pi')",
    ]
    rows = {r.path: r for r in xml.collect()}
    assert rows["/a/b[2]/text()"].type == "CDATA" and rows["/a/b[2]"].attrs == {"y": "2", "x": "1"}
    assert (rows["/a"].last_desc, rows["/a/b[1]"].last_desc) == (9, 5)


def test_content_and_lists(xml):
    content = {r.path: r.node_content for r in N.node_content(xml).collect()}
    assert content["/a"] == "t1t2 <z>" and content["/a/b[1]"] == "t1t2" and content["/a/b[1]/c"] == ""
    assert content["/a/comment()"] == "c"
    listed = {r.path: r.node_list for r in N.node_list(xml).collect()}
    assert {r.path for r in N.node_list(xml, F.col("name") == "c").collect()} == {"/a/b[1]/c"}
    assert listed["/a/b[1]/text()[1]"] == "t1t2" and listed["/a/b[1]/c"] == "t2" and listed["/a/b[2]"] == ""


def test_steps(xml):
    names = {r.node_id: r.path for r in xml.collect()}
    rows = {names[r.node_id]: names.get(r.next_id) for r in N.node_next(xml).collect()}
    assert rows["/a/comment()"] == "/a/b[1]" and rows["/a/b[1]"] == "/a/text()" and rows["/a"] is None
    rows = {names[r.node_id]: names.get(r.next_id) for r in N.node_next_element(xml).collect()}
    assert rows["/a/b[1]"] == "/a/b[2]" and rows["/a/b[2]"] is None
    rows = {names[r.node_id]: names.get(r.prev_id) for r in N.node_prev(xml).collect()}
    assert rows["/a/b[2]"] == "/a/text()"
    rows = {names[r.node_id]: names.get(r.prev_id) for r in N.node_prev(xml, "ELEMENT").collect()}
    assert rows["/a/b[2]"] == "/a/b[1]" and rows["/a/b[1]"] is None
    child = {names[r.node_id]: names[r.child_id] for r in N.node_child(xml).collect()}
    assert child == {"/a": "/a/comment()", "/a/b[1]": "/a/b[1]/text()[1]", "/a/b[2]": "/a/b[2]/text()"}
    child = {names[r.node_id]: names[r.child_id] for r in N.node_child(xml, "ELEMENT").collect()}
    assert child == {"/a": "/a/b[1]", "/a/b[1]": "/a/b[1]/c"}
    parent = {r.path: r.parent_path for r in N.node_parent(xml).collect()}
    assert parent["/a/b[1]/c"] == "/a/b[1]" and len(parent) == 9
    children = N.node_children(xml).collect()
    assert sorted((names[r.node_id], names[r.child_id]) for r in children) == [
        ("/a", "/a/b[1]"),
        ("/a", "/a/b[2]"),
        ("/a/b[1]", "/a/b[1]/c"),
    ]
    siblings = N.node_siblings(xml, xml.where("path = '/a/b[1]'")).collect()
    assert sorted((names[r.parent_id], names[r.sibling_id]) for r in siblings) == [("/a", "/a/b[1]"), ("/a", "/a/b[2]")]
    assert paths(N.node_root(xml)) == ["/a"]
    assert sorted((r.key, r.value) for r in N.node_attributes(xml).collect()) == [("x", "1"), ("x", "1"), ("y", "2")]
    assert {r.type: r.nodes for r in N.node_type_profile(xml).collect()}["ELEMENT"] == 4


@pytest.mark.parametrize(
    "query, want",
    [
        ("/a/b", ["/a/b[1]", "/a/b[2]"]),
        ("//b[2]", ["/a/b[2]"]),
        ("//b/c", ["/a/b[1]/c"]),
        ("/a//c", ["/a/b[1]/c"]),
        ("//b[@x='1']", ["/a/b[2]"]),
        ("//b[@x][@y]", ["/a/b[2]"]),
        ("//b[@x][1]", ["/a/b[2]"]),
        ("//b[@x][2]", []),
        ("//c/..", ["/a/b[1]"]),
        ("//b/text()", ["/a/b[1]/text()[1]", "/a/b[1]/text()[2]", "/a/b[2]/text()"]),
        ("//@x", ["/a/@x", "/a/b[2]/@x"]),
        ("/a//@x", ["/a/@x", "/a/b[2]/@x"]),
        ("/a/*[2]/@y", ["/a/b[2]/@y"]),
        ("//b[@x]/text()", ["/a/b[2]/text()"]),
        ("//b[1]//text()", ["/a/b[1]/text()[1]", "/a/b[1]/text()[2]"]),
        ("//*", ["/a", "/a/b[1]", "/a/b[1]/c", "/a/b[2]"]),
        ("/a/b[1]/node()", ["/a/b[1]/text()[1]", "/a/b[1]/c", "/a/b[1]/text()[2]"]),
        ("/a/comment()", ["/a/comment()"]),
        ("c", ["/a/b[1]/c"]),
        ("/b", []),
        ("//zzz/b", []),
    ],
)
def test_location_paths(xml, query, want):
    assert paths(X.xpath_query(xml, query)) == want


@pytest.mark.parametrize("query", ["", "//b[count(a)]", "//b[a='x'", "//b[", "ancestor:::a", "//@x/b", "/a/foo()", "//b[not(a]", "//b[1 2]"])
def test_unsupported_paths(query):
    with pytest.raises(ValueError):
        X.parse_path(query)


def test_location_paths_against_a_tree(spark):
    import random

    rng = random.Random(4)

    def build(depth):
        node = ET.Element(rng.choice("abc"))
        if rng.random() < 0.4:
            node.set("k", rng.choice("12"))
        node.set("id", str(rng.random()))
        for _ in range(rng.randrange(4) if depth else 0):
            node.append(build(depth - 1))
        return node

    trees = [ET.Element("r") for _ in range(6)]
    for tree in trees:
        tree.set("id", "root")
        tree.extend(build(5) for _ in range(3))
    frame = spark.createDataFrame([(i, ET.tostring(t, "unicode")) for i, t in enumerate(trees)], "id long, t string")
    nodes = M.parse_xml(frame, "id", "t")
    nodes = spark.createDataFrame(nodes.collect(), nodes.schema)
    for query in ["//a", "//a/b", "//a//b", "//a[@k='1']//c", "//b[2]", "//a[1]//b[@k]/c", "//a//b//c", "//b[@k]/.."]:
        want = sorted(
            (i, n.get("id")) for i, t in enumerate(trees) for n in {id(n): n for n in t.findall("." + query)}.values()
        )
        found = X.xpath_query(nodes, query).select("id", F.col("attrs")["id"].alias("n")).collect()
        assert sorted((r.id, r.n) for r in found) == want, query


def test_tree_invariants(spark):
    pages = "<p>a<p>b<ul><li>x<li>y<b>z</ul><table><tr><td>1<td>2<tr><td>3</table><br>t<script>'</p>'</script>"
    nodes = table(spark, pages, M.parse_html)
    rows = nodes.orderBy("node_id").collect()
    elements = [r for r in rows if r.type == "ELEMENT"]
    assert N.node_children(nodes).count() == len(elements) - 1
    assert [r.name for r in rows if r.parent_id is None] == ["html"]
    for r in rows:
        inside = [s for s in rows if s.path.startswith(r.path + "/")]
        assert r.last_desc == r.node_id + len(inside)
    assert not [r for r in rows if "/p/p" in r.path.replace("[1]", "").replace("[2]", "")]
    assert [r.content for r in rows if r.type == "CDATA"] == ["'</p>'"]
    assert sum(r.name == "li" for r in rows) == 2 and sum(r.name == "tr" for r in rows) == 2


@pytest.mark.parametrize(
    "text, want",
    [
        ("", []),
        ("plain", ["/html", "/html/body", "/html/body/text()"]),
        ("<title>T</title>x", ["/html", "/html/head", "/html/head/title", "/html/head/title/text()", "/html/body", "/html/body/text()"]),
        ("</b></p><i>x", ["/html", "/html/body", "/html/body/i", "/html/body/i/text()"]),
        ("<div/>a", ["/html", "/html/body", "/html/body/div", "/html/body/text()"]),
        ("<html><body>a</body></html>b", ["/html", "/html/body", "/html/body/text()"]),
    ],
)
def test_html_forgives(spark, text, want):
    assert paths(table(spark, text, M.parse_html)) == want


def test_html_options(spark):
    assert paths(table(spark, "<b>x</b> <b>y</b>", M.parse_html, noimplied=True, noblanks=True)) == [
        "/b[1]",
        "/b[1]/text()",
        "/b[2]",
        "/b[2]/text()",
    ]
    narrow = table(spark, "<b a=1 a=2 c>x", M.parse_html, columns=["node_id", "path", "attrs"])
    assert narrow.columns == ["id", "node_id", "path", "attrs"]
    assert {r.path: r.attrs for r in narrow.collect()}["/html/body/b"] == {"a": "1", "c": None}


def test_xml_options(spark):
    spaced = table(spark, XML, noblanks=True, nocdata=True)
    rows = {r.path: r for r in spaced.collect()}
    assert "/a/text()" not in rows and rows["/a/b[2]/text()"].type == "TEXT"
    assert rows["/a"].last_desc == len(rows) - 1 and rows["/a"].text_end == 7
    content = {r.path: r.node_content for r in N.node_content(spaced).collect()}
    assert content["/a"] == "t1t2<z>" and content["/a/b[2]"] == "<z>"
    broken = spark.createDataFrame([(1, "<a><b></a>"), (2, "<a/>"), (3, None)], "id long, t string")
    assert M.parse_xml(broken, "id", "t").count() == 1
    assert [r.id for r in M.xml_quarantine(broken, "id", "t").collect()] == [1]
    assert M.parse_xml(broken, "id", "t", recover=True).count() == 3


def test_namespaces_and_prolog(spark):
    rows = table(spark, '﻿<?xml version="1.0"?><!DOCTYPE r><r xmlns="u" xmlns:p="v"><p:x p:k="1">é&lt;</p:x></r>').collect()
    assert [r.type for r in rows] == ["DTD", "ELEMENT", "ELEMENT", "TEXT"]
    assert rows[1].attrs is None and rows[2].attrs == {"p:k": "1"} and rows[3].content == "é<"


def test_no_step_pairs_nodes_of_a_document(spark, xml):
    """Every join has the document and a node number as equal keys."""
    for query in ["//b[@x]//text()", "//b[@x]/text()", "//c/.."]:
        plan = X.xpath_query(xml, query)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def _orders(spark, folder, n):
    rows = spark.range(1, n + 1).selectExpr("id AS o_orderkey", "id * 7 AS o_custkey", "'F' AS o_orderstatus", "id + 0.5D AS o_totalprice", "'5-LOW' AS o_orderpriority")
    rows.write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_relations_send_no_nodes_to_all_tasks(spark, tmp_path):
    # As files the nodes are far below the limit of a broadcast.
    found = node_queries.node_relations(spark, _orders(spark, tmp_path, 120))
    assert "BroadcastHashJoin" not in _plan(found)
    assert found.count() == 119 * 38


def test_texts_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    # A task of parse_xml sorts the nodes of its piece, so pieces do not grow with the table.
    monkeypatch.setattr(inputs, "TEXTS", 10)
    assert inputs.xml_documents(spark, _orders(spark, tmp_path, 120)).rdd.getNumPartitions() == 12


def test_steps_on_stored_nodes_need_no_shuffle(spark, tmp_path):
    nodes = inputs.xml_nodes(spark, _orders(spark, tmp_path, 120))
    children = axes.reach(nodes, nodes.where("name = 'order'"), "child")
    assert "Exchange" not in _plan(children) and "BroadcastHashJoin" not in _plan(children)
    assert children.count() == 119 * 6


def test_attributes_as_a_column():
    held = [{"a": "1", "b": None}, None, {}, {"a": "2"}]
    column = M._maps(held)
    assert column.to_pylist() == [[("a", "1"), ("b", None)], None, [], [("a", "2")]]
