"""Location paths against an evaluation node by node."""

import random
import re
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from tidegrid.operators import nodes as N
from tidegrid.operators import xpath as X
from tidegrid.operators.paths import parse_path
from tidegrid.sources import markup as M

OPS = {"eq": "__eq__", "ne": "__ne__", "lt": "__lt__", "le": "__le__", "gt": "__gt__", "ge": "__ge__"}


class Naive:
    """One document, one node at a time, as the language is defined."""

    def __init__(self, rows):
        self.rows = {r.node_id: r for r in rows}
        self.order = sorted(self.rows)

    def axis(self, node, axis):
        """Nodes along an axis, nearest first; None is the document."""
        ids, rows = self.order, self.rows
        if node is None:
            top = [i for i in ids if rows[i].parent_id is None]
            return {"child": top, "below": ids, "descendant": ids, "descendant-or-self": ids}.get(axis, [])
        r = rows[node]
        up, at = [], r.parent_id
        while at is not None:
            up.append(at)
            at = rows[at].parent_id
        down = [i for i in ids if node < i <= r.last_desc]
        family = [i for i in ids if rows[i].parent_id == r.parent_id]
        return {
            "self": [node],
            "child": [i for i in ids if rows[i].parent_id == node],
            "parent": up[:1],
            "descendant": down,
            "descendant-or-self": [node, *down],
            "below": down,
            "ancestor": up,
            "ancestor-or-self": [node, *up],
            "following-sibling": [i for i in family if i > node],
            "preceding-sibling": [i for i in reversed(family) if i < node],
            "following": [i for i in ids if i > r.last_desc],
            "preceding": [i for i in reversed(ids) if i < node and i not in up],
        }[axis]

    def test(self, node, test):
        r = self.rows[node]
        kinds = {"text()": ["TEXT", "CDATA"], "comment()": ["COMMENT"]}
        if test == "node()":
            return True
        return r.type in kinds[test] if test in kinds else r.type == "ELEMENT" and test in ("*", r.name)

    def text(self, node):
        if isinstance(node, tuple):
            return self.rows[node[0]].attrs[node[1]] or ""
        r = self.rows[node]
        if r.type != "ELEMENT":
            return r.content or ""
        return "".join(self.rows[i].content for i in self.order if node < i <= r.last_desc and self.rows[i].type in ("TEXT", "CDATA"))

    def steps(self, nodes, steps):
        for step in steps:
            found = set()
            for node in nodes:
                if step.axis == "attribute":
                    held = self.rows[node].attrs or {} if node is not None else {}
                    found |= {(node, k) for k in held if step.test in ("*", k)}
                elif step.axis == "below":
                    for parent in [node, *self.axis(node, "descendant")]:
                        found |= set(self.kept(self.axis(parent, "child"), step))
                else:
                    found |= set(self.kept(self.axis(node, step.axis), step))
            nodes = found
        return nodes

    def kept(self, nodes, step):
        return self.where([n for n in nodes if self.test(n, step.test)], step.predicates)

    def where(self, nodes, predicates):
        for tree in predicates:
            nodes = [n for i, n in enumerate(nodes, 1) if self.holds(n, tree, i, len(nodes))]
        return nodes

    def first(self, node, value):
        if value[0] == "string":
            return value[1]
        if value[0] == "name":
            return self.rows[node].name if self.rows[node].type == "ELEMENT" else ""
        if value[0] == "normalize-space":
            return " ".join(re.split(r"[ \t\r\n]+", self.first(node, value[1]).strip(" \t\r\n")))
        found = sorted(self.steps({node}, value[1]), key=lambda n: n if isinstance(n, tuple) else (n, ""))
        return self.text(found[0]) if found else ""

    def compare(self, text, operator, literal):
        if literal[0] == "string" and operator in ("eq", "ne"):
            return getattr(text, OPS[operator])(literal[1])
        number = lambda t: float(t) if re.fullmatch(r"\s*-?(\d+(\.\d*)?|\.\d+)\s*", str(t)) else float("nan")
        return getattr(number(text), OPS[operator])(number(literal[1]))

    def holds(self, node, tree, place, size):
        kind = tree[0]
        if kind == "and":
            return all(self.holds(node, t, place, size) for t in tree[1:])
        if kind == "or":
            return any(self.holds(node, t, place, size) for t in tree[1:])
        if kind == "not":
            return not self.holds(node, tree[1], place, size)
        if kind == "place":
            return getattr(float(place), OPS[tree[1]])(tree[2][1] if tree[2][0] == "number" else size - tree[2][1])
        if kind == "has":
            return bool(self.steps({node}, tree[1]))
        if kind in ("contains", "starts-with"):
            held = self.first(node, tree[1])
            return tree[2] in held if kind == "contains" else held.startswith(tree[2])
        _, operator, value, literal = tree
        if value[0] == "path":
            return any(self.compare(self.text(n), operator, literal) for n in self.steps({node}, value[1]))
        if value[0] == "count":
            return self.compare(str(len(self.steps({node}, value[1]))), operator, literal)
        if value[0] == "string-length":
            return self.compare(str(len(self.first(node, value[1]))), operator, literal)
        return self.compare(self.first(node, value), operator, literal)

    def query(self, paths):
        found = set()
        for path in paths:
            start = {None}
            if path.group:
                start = self.where(sorted(self.query(path.group[0])), path.group[1])
            found |= set(self.steps(start, path.steps))
        return found


@pytest.fixture(scope="module")
def trees(spark):
    rng = random.Random(4)

    def build(depth):
        node = ET.Element(rng.choice("abc"))
        for key in "kz":
            if rng.random() < 0.3:
                node.set(key, rng.choice(["1", "2", "x y", ""]))
        node.text = rng.choice(["", "v", " 7 ", "é𝒳v"])
        for _ in range(rng.randrange(4) if depth else 0):
            node.append(build(depth - 1))
            node[-1].tail = rng.choice(["", "", "v", "t\n"])
        if rng.random() < 0.1:
            node.append(ET.Comment("v"))
        return node

    texts = []
    for _ in range(7):
        top = ET.Element("r")
        top.extend(build(4) for _ in range(3))
        texts.append(ET.tostring(top, "unicode"))
    texts += ["<a/>", "<r><a><a><a>v</a></a></a></r>"]
    nodes = M.parse_xml(spark.createDataFrame(list(enumerate(texts)), "id long, t string"), "id", "t")
    rows = nodes.collect()
    return spark.createDataFrame(rows, nodes.schema).cache(), {i: Naive([r for r in rows if r.id == i]) for i in range(len(texts))}


QUERIES = """
//b/ancestor::a
//b/ancestor-or-self::*[@k]
//c/following-sibling::*
//a/preceding-sibling::b/@k
//a[@k='1']/following::b
//b[@z]/preceding::*
//a/descendant::b/parent::*
/descendant-or-self::node()/child::b[2]
//b/self::b/..
/r/child::*/descendant-or-self::c
//b//ancestor::c
//a//.
//c//..
//a[b]
//a[b/c]
//a[b[2]/c]
//*[.='v']
//*[b='v']
//*[.//c]
//*[.//c/@k]
//*[b/@k='1' or not(c)]
//b[ancestor::a/@k]
//b[following-sibling::c]
//*[preceding::a[@k='2']]
//b[../c]
//text()[.='v']/..
//text()[..//b]
//*[text()='v' and @k != '1']
//*[@*='2']
//*[@k > 1]
//*[b = 7]
//*[string-length(.) < 3]
//*[count(b) = 2]
//*[count(a/b) >= 2]
//*[count(.//b) > 3]
//*[count(a//b/@k) > 0]
//*[count(text()) = 0]
//*[normalize-space(b) = '7']
//*[contains(., 'é')]
//*[contains(a/b, 'v')]
//*[starts-with(.//b, 'v')]
//*[string(b/@k) = '1']
//*[name() = 'a' and 2 > count(*)]
(//b)[2]
(//b)[last()]/..
(//a | //c)[position() < 3]/b
(//b[@k])[last()-1]
//c/following-sibling::*[1]
//c/following-sibling::b[2]
//c/following-sibling::*[last()]
//c/preceding-sibling::*[1]
//c/preceding-sibling::*[@k][last()-1]
//b/following-sibling::*[position() > 1]
//b/following-sibling::*[position() < 2][@k]
//b/preceding-sibling::node()[position() != 1]
//b/ancestor::*[1]
//b/ancestor::a[2]
//b/ancestor-or-self::b[1]
//b/ancestor-or-self::b[2]/@k
//b/ancestor::*[last()]
//b/ancestor::*[last()-1]
//b[@k]/following::c[1]
//b[@k]/following::c[3]
//b[@k]/following::*[last()]
//a/descendant::b[1]
//a/descendant::b[2]
//a/descendant-or-self::a[2]
//a/descendant::*[last()]
//b/..[1]
//b/.[1]
//*[a[last()]/b]
//a[position() mod 1]
//a[b][last()]
//a[@k or @z][position() > 1 and position() < 3]
//comment() | //a/@k
//*[comment()='v']
//b[. = 'v'][1]
/r/a[1]//b[1]
//*[a//text()='v']
//*[not(ancestor::*)]
b[c]
//*[c and (@k='1' or (@z)) and not(missing)]
""".strip().splitlines()


@pytest.mark.parametrize("query", [q for q in QUERIES if " mod " not in q])
def test_paths_node_by_node(trees, query):
    nodes, naive = trees
    paths = parse_path(query)
    held = [(i, n) for i, document in naive.items() for n in document.query(paths)]
    want = sorted((i, *n) if isinstance(n, tuple) else (i, n, "") for i, n in held)
    found = X.xpath_query(nodes, query)
    kind = F.when(F.col("type") == "ATTRIBUTE", F.col("name")).otherwise("")
    got = sorted(tuple(r) for r in found.select("id", "node_id", kind).collect())
    assert got == want


def test_queries_find_something(trees):
    _, naive = trees
    empty = [q for q in QUERIES if " mod " not in q and not any(d.query(parse_path(q)) for d in naive.values())]
    assert len(empty) < 4, empty


@pytest.mark.parametrize(
    "query",
    ["//a[position() mod 1]", "//a/preceding::b[1]", "//a/namespace::x", "//b[c = d]", "//b[foo(.)]", "//a/following::b[position() > 1]", "//a[count(..) = 1]", "//a/@k[1]", "/..", "//a[b]]", "//@k/a", "//a[following::b[1]]"],
)
def test_paths_that_are_not_known(trees, query):
    with pytest.raises(ValueError):
        X.xpath_query(trees[0], query)


def test_brackets_and_bars_inside_quotes(spark):
    nodes = M.parse_html(spark.createDataFrame([(1, '<div id="a]b">x|y</div><p id="q">z')], "id long, t string"), "id", "t")
    found = X.xpath_query(nodes, "//div[@id='a]b'] | //p[@id=\"q\"]").orderBy("node_id").collect()
    assert [r.name for r in found] == ["div", "p"]
    assert X.xpath_query(nodes, "//*[.='x|y']").count() == 1


def test_no_join_on_the_document_alone(trees):
    """Every join has the document and a node number as equal keys."""
    nodes, _ = trees
    for query in ["//b/ancestor::a", "//c/following-sibling::*[2]", "//*[.='v']", "//*[count(.//b) > 3]", "//b/ancestor::a[2]", "//b[@k]/following::c[3]", "(//b)[2]", "//*[contains(a/b, 'v')]"]:
        plan = X.xpath_query(nodes, query)._jdf.queryExecution().executedPlan().toString()
        joins = re.findall(r"Join \[([^\]]*)\], \[", plan)
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert joins or query == "(//b)[2]"
        assert all("," in keys for keys in joins), joins


def test_content_of_all_nodes_is_cut_from_one_text(spark):
    """The text of a document is in one row with its nodes, and in none of a node."""
    deep = "".join(f"<a>é{i}" for i in range(200)) + "</a>" * 200
    nodes = M.parse_xml(spark.createDataFrame([(1, deep), (2, "<a/>")], "id long, t string"), "id", "t")
    held = {(r.id, r.depth): r.node_content for r in N.node_content(nodes).where("type = 'ELEMENT'").collect()}
    assert held[1, 150] == "".join(f"é{i}" for i in range(150, 200)) and held[2, 0] == ""
    plan = N.node_content(nodes)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
