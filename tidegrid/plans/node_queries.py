"""Queries on node tables of pages and of XML texts."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.registry import register_functions
from tidegrid.operators import nodes as N
from tidegrid.operators import xpath as X
from tidegrid.plans.inputs import on_all_cores, page_nodes, table, xml_documents, xml_nodes
from tidegrid.plans.registry import query
from tidegrid.sources import markup as M

PLACES = ["node_id", "parent_id", "pos", "type", "name"]

# Pages without what scripts, styles and comments hold.
BARE = """
bare AS (SELECT page_id, html, regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'),
  '(<script[^>]*>|<style[^>]*>).*?(</script>|</style>)', '\\1\\2', 'gs') AS h FROM pages)"""


def _found(nodes, doc, paths):
    """What each of several named paths finds."""
    parts = [X.xpath_query(nodes, path).select(doc, F.lit(name).alias("found"), "content") for name, path in paths.items()]
    return reduce(DataFrame.unionByName, parts)


def _count(tag):
    return f"len(regexp_extract_all(h, '<{tag}[ >]'))"


def _plain(text):
    for entity, mark in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;?", "&")):
        text = f"regexp_replace({text}, '{entity}', '{mark}', 'g')"
    return text


@query(f"""WITH {BARE}, t AS (SELECT unnest(regexp_extract_all(h, '<([a-z][a-z0-9]*)[ >]', 1)) AS name FROM bare)
SELECT name, count(*) AS nodes FROM t GROUP BY name""")
def parse_html(spark, folder):
    elements = page_nodes(spark, folder, ["type", "name"]).where(F.col("type") == "ELEMENT")
    return elements.groupBy("name").agg(F.count(F.lit(1)).alias("nodes"))


@query(f"""WITH {BARE} SELECT page_id, '/html' AS path, regexp_extract(h, '<html lang="([^"]*)"', 1) AS lang FROM bare""")
def node_root(spark, folder):
    roots = N.node_root(page_nodes(spark, folder, ["parent_id", "type", "path", "attrs"]))
    return roots.select("page_id", "path", F.col("attrs")["lang"].alias("lang"))


@query(f"""WITH {BARE} SELECT 'DTD' AS type, count(*) AS nodes FROM bare UNION ALL SELECT 'COMMENT', count(*) FROM bare
UNION ALL SELECT 'CDATA', 2 * count(*) FROM bare
UNION ALL SELECT 'ELEMENT', sum(len(regexp_extract_all(h, '<[a-z][a-z0-9]*[ >]')))::BIGINT FROM bare
UNION ALL SELECT 'TEXT', sum(len(regexp_extract_all(regexp_replace(h, '<!DOCTYPE html>', ''), '>[^<]+')))::BIGINT FROM bare""")
def node_type(spark, folder):
    return N.node_type_profile(page_nodes(spark, folder, ["type"]))


@query(f"""WITH {BARE} SELECT page_id, unnest(regexp_extract_all(h, ' (lang|charset|href|class)="([^"]*)"', 1)) AS key,
  unnest(regexp_extract_all(h, ' (lang|charset|href|class)="([^"]*)"', 2)) AS value FROM bare""")
def node_attributes(spark, folder):
    return N.node_attributes(page_nodes(spark, folder, ["node_id", "type", "name", "attrs"])).select("page_id", "key", "value")


# The nodes of an order as XML: the children of the root in order, and the text below each element.
_CHILDREN = ["customer", "comment()", "price", "tag[1]", "text()", "tag[2]"]
_ELEMENTS = ["customer", "price", "tag[1]", "tag[2]"]


def _relations():
    at = lambda name: f"/order/{name}"
    pairs = list(zip(_CHILDREN, _CHILDREN[1:]))
    following = [(c, next(e for e in _CHILDREN[i + 1 :] if e in _ELEMENTS)) for i, c in enumerate(_CHILDREN[:-1])]
    rows = [("next", at(a), at(b)) for a, b in pairs] + [("previous", at(b), at(a)) for a, b in pairs]
    rows += [("next element", at(a), at(b)) for a, b in following]
    rows += [("child", "/order", at(e)) for e in _ELEMENTS] + [("first child", "/order", at("customer"))]
    rows += [("first child", at(e), at(e) + "/text()") for e in _ELEMENTS]
    rows += [("parent", at(c), "/order") for c in _CHILDREN] + [("parent", at(e) + "/text()", at(e)) for e in _ELEMENTS]
    rows += [("sibling", "/order", at(e)) for e in _ELEMENTS]
    return ", ".join(f"('{r}', '{a}', '{b}')" for r, a, b in rows)


@query(f"""SELECT o_orderkey AS doc_id, relation, path, other FROM orders,
(VALUES {_relations()}) r(relation, path, other) WHERE o_orderkey % 100 <> 0""")
def node_relations(spark, folder):
    """Every node of every document with its parent, children, neighbours and siblings."""
    columns = ["node_id", "parent_id", "depth", "pos", "type", "name", "path", "element_no"]
    nodes = xml_nodes(spark, folder, columns)
    pair = lambda frame, name, other: frame.select("doc_id", F.lit(name).alias("relation"), "node_id", F.col(other).alias("other_id"))
    parts = [
        pair(N.node_next(nodes), "next", "next_id"),
        pair(N.node_next_element(nodes), "next element", "next_id"),
        pair(N.node_prev(nodes), "previous", "prev_id"),
        pair(N.node_children(nodes), "child", "child_id"),
        pair(N.node_child(nodes), "first child", "child_id"),
        pair(N.node_siblings(nodes, nodes.where("name = 'price'")).withColumnRenamed("parent_id", "node_id"), "sibling", "sibling_id"),
    ]
    related = reduce(DataFrame.unionByName, parts).where(F.col("other_id").isNotNull())
    paths = nodes.select("doc_id", "node_id", "path")
    others = paths.select("doc_id", F.col("node_id").alias("other_id"), F.col("path").alias("other"))
    shown = related.join(paths, ["doc_id", "node_id"]).join(others, ["doc_id", "other_id"]).select("doc_id", "relation", "path", "other")
    parents = N.node_parent(nodes).where(F.col("parent_path").isNotNull())
    return shown.unionByName(parents.select("doc_id", F.lit("parent").alias("relation"), "path", F.col("parent_path").alias("other")))


@query("""
SELECT o_orderkey AS doc_id, unnest([1, 3, 4, 8])::INT AS code, unnest([5, 4, 1, 1])::BIGINT AS nodes FROM orders WHERE o_orderkey % 100 <> 0""")
def node_type_code(spark, folder):
    nodes = M.parse_xml(xml_documents(spark, folder), "doc_id", "raw", columns=["type"])
    return nodes.groupBy("doc_id", N.node_type_code().alias("code")).agg(F.count(F.lit(1)).alias("nodes"))


@query(f"""WITH {BARE}, t AS (SELECT unnest(regexp_extract_all(h, '<([a-z][a-z0-9]*)[ >]', 1)) AS name FROM bare)
SELECT name, count(*) AS nodes FROM t GROUP BY name
UNION ALL SELECT '#comment', count(*) FROM bare
UNION ALL SELECT '#cdata', 2 * count(*) FROM bare""")
def node_name(spark, folder):
    named = page_nodes(spark, folder, ["type", "name"]).where(~F.col("type").isin("TEXT", "DTD"))
    return named.groupBy("name").agg(F.count(F.lit(1)).alias("nodes"))


@query(f"""WITH {BARE}, l AS (SELECT page_id, {_count("li")} AS n FROM bare)
SELECT page_id, '/html/body/nav/ul/li' || CASE WHEN n > 1 THEN '[' || unnest(range(1, n + 1)) || ']' ELSE '' END AS path FROM l
UNION ALL SELECT page_id, '/html/head/title' FROM l UNION ALL SELECT page_id, '/html/body/comment()' FROM l""")
def node_path(spark, folder):
    wanted = F.col("name").isin("li", "title", "#comment")
    return page_nodes(spark, folder, ["name", "path"]).where(wanted).select("page_id", "path")


@query(f"""WITH {BARE} SELECT page_id, unnest(['h1', 'title', 'footer', 'nav']) AS name, unnest([
  {_plain("regexp_extract(h, '(?s)<h1>(.*?)</h1>', 1)")}, {_plain("regexp_extract(h, '(?s)<title>(.*?)</title>', 1)")},
  {_plain("regexp_extract(h, '(?s)<footer>(.*?)</footer>', 1)")},
  {_plain("regexp_replace(regexp_extract(h, '(?s)<nav>(.*?)</nav>', 1), '<[^>]*>', '', 'g')")}]) AS content FROM bare""")
def node_content(spark, folder):
    nodes = page_nodes(spark, folder, stored=True)
    picked = nodes.where(F.col("name").isin("h1", "title", "footer", "nav"))
    return N.node_content(nodes, picked, "content_text").select("page_id", "name", F.col("content_text").alias("content"))


@query("""
SELECT o_orderkey AS doc_id, unnest(['/order', '/order/customer', '/order/price', '/order/tag[1]', '/order/tag[2]']) AS path,
  unnest([o_custkey || '<' || o_totalprice || '>a & b' || chr(10) || '  ' || o_orderpriority, o_custkey::VARCHAR, '<' || o_totalprice || '>',
  'a & b', o_orderpriority]) AS content FROM orders WHERE o_orderkey % 100 <> 0""")
def node_content_all(spark, folder):
    columns = ["node_id", "type", "path", "content", "text_start", "text_end"]
    nodes = xml_nodes(spark, folder, columns)
    whole = N.node_content(nodes, out="whole").where("type = 'ELEMENT'")
    return whole.select("doc_id", "path", F.col("whole").alias("content"))


@query("""
SELECT o_orderkey AS doc_id, unnest(['customer', 'price', 'tag', 'tag']) AS name,
  unnest([chr(10) || '  ', chr(10) || '  ', chr(10) || '  ', '']) AS text FROM orders WHERE o_orderkey % 100 <> 0""")
def node_list(spark, folder):
    columns = ["node_id", "parent_id", "depth", "pos", "type", "name", "content"]
    nodes = xml_nodes(spark, folder, columns)
    listed = N.node_list(nodes, (F.col("type") == "ELEMENT") & (F.col("depth") == 1), "text")
    return listed.select("doc_id", "name", "text")


@query(f"""WITH {BARE} SELECT unnest(['html', 'head', 'body', 'nav', 'ul', 'li', 'article', 'p', 'b']) AS parent, unnest([
  2 * count(*), 4 * count(*), 4 * count(*), count(*), sum({_count("li")})::BIGINT, sum({_count("a")})::BIGINT,
  sum({_count("h1")} + {_count("p")})::BIGINT, sum({_count("b")})::BIGINT, sum({_count("br")})::BIGINT]) AS children FROM bare""")
def node_children(spark, folder):
    nodes = page_nodes(spark, folder, stored=True)
    parents = nodes.where(F.col("type") == "ELEMENT").select("page_id", "node_id", F.col("name").alias("parent"))
    pairs = N.node_children(nodes).drop("name").join(parents, ["page_id", "node_id"])
    return pairs.groupBy("parent").agg(F.count(F.lit(1)).alias("children"))


@query(f"""WITH {BARE} SELECT page_id, {_count("p")} + 1 AS siblings FROM bare""")
def node_siblings(spark, folder):
    nodes = page_nodes(spark, folder, stored=True)
    pairs = N.node_siblings(nodes, nodes.where(F.col("name") == "h1"))
    return pairs.groupBy("page_id").agg(F.count(F.lit(1)).alias("siblings"))


@query(f"""WITH {BARE} SELECT page_id, regexp_extract(html, '<!--(.*?)-->', 1) AS comment FROM bare""")
def node_next(spark, folder):
    nodes = page_nodes(spark, folder, stored=True)
    comments = nodes.where(F.col("type") == "COMMENT").select(
        "page_id", F.col("node_id").alias("next_id"), F.col("content").alias("comment")
    )
    found = N.node_next(nodes, "COMMENT").where(F.col("name") == "nav").join(comments, ["page_id", "next_id"])
    return found.select("page_id", "comment")


@query(f"""WITH {BARE} SELECT page_id, {_count("li")} - 1 AS with_next FROM bare""")
def node_next_element(spark, folder):
    items = N.node_next_element(page_nodes(spark, folder, PLACES)).where(F.col("name") == "li")
    return items.groupBy("page_id").agg(F.count("next_id").alias("with_next"))


@query(f"""WITH {BARE} SELECT page_id, {_count("li")} - 1 AS with_prev, 4::BIGINT AS in_head FROM bare""")
def node_prev(spark, folder):
    linked = N.node_prev(N.node_prev(page_nodes(spark, folder, PLACES)), "ELEMENT", "prev_element_id")
    later = F.count(F.when(F.col("name") == "li", F.col("prev_id")))
    head = F.count_if(F.col("name").isin("title", "style", "script")) + F.count_if(
        (F.col("name") == "meta") & F.col("prev_element_id").isNull()
    )
    return linked.groupBy("page_id").agg(later.alias("with_prev"), head.alias("in_head"))


@query(f"""WITH {BARE} SELECT page_id, {_count("a")} + {_count("b")} AS with_text FROM bare""")
def node_child(spark, folder):
    nodes = page_nodes(spark, folder, stored=True)
    owners = nodes.where(F.col("name").isin("a", "b")).select("page_id", "node_id")
    found = N.node_child(nodes, "TEXT").join(owners, ["page_id", "node_id"])
    return found.groupBy("page_id").agg(F.count(F.lit(1)).alias("with_text"))


@query(f"""WITH {BARE} SELECT unnest(['li', 'a', 'p', 'b', 'br', 'h1']) AS name,
  unnest(['ul', 'li', 'article', 'p', 'b', 'article']) AS parent_name, unnest([sum({_count("li")}), sum({_count("a")}),
  sum({_count("p")}), sum({_count("b")}), sum({_count("br")}), sum({_count("h1")})])::BIGINT AS nodes FROM bare""")
def node_parent(spark, folder):
    with_parent = N.node_parent(page_nodes(spark, folder, stored=True))
    wanted = with_parent.where(F.col("name").isin("li", "a", "p", "b", "br", "h1"))
    return wanted.groupBy("name", "parent_name").agg(F.count(F.lit(1)).alias("nodes"))


@query(f"""WITH {BARE} SELECT page_id, unnest(regexp_extract_all(regexp_extract(h, '(?s)<nav>.*</nav>'), '<a href="([^"]*)"', 1)) AS href FROM bare""")
def xpath_query(spark, folder):
    found = X.xpath_query(page_nodes(spark, folder, ["node_id", "type", "name", "path", "attrs"]), "//nav//a/@href")
    return found.select("page_id", F.col("content").alias("href"))


@query(f"""WITH {BARE} SELECT page_id, {_plain("regexp_extract(h, '(?s)<div class=.ad.>(.*?)</div>', 1)")} AS ad,
  {_plain("list_extract(regexp_extract_all(h, '(?s)<a [^>]*>(.*?)</a>', 1), 2)")} AS second_link FROM bare""")
def xpath_predicates(spark, folder):
    nodes = page_nodes(spark, folder, stored=True)
    ads = X.xpath_query(nodes, "//div[@class='ad']/text()").select("page_id", F.col("content").alias("ad"))
    links = X.xpath_query(nodes, "/html/body//ul/li[2]//text()").select("page_id", F.col("content").alias("second_link"))
    return ads.join(links, "page_id")


@query(f"""
WITH {BARE}, p AS (SELECT page_id, regexp_extract_all(regexp_extract(h, '(?s)<nav>.*</nav>'), '<a href="([^"]*)"', 1) AS l,
  regexp_extract_all(h, '(?s)<a [^>]*>(.*?)</a>', 1) AS t, {_plain("regexp_extract(h, '(?s)<div class=.ad.>(.*?)</div>', 1)")} AS ad,
  {_plain("regexp_extract(h, '(?s)<h1>(.*?)</h1>', 1)")} AS title FROM bare),
z AS (SELECT page_id, l, {_plain("t")} AS t FROM (SELECT page_id, unnest(l) AS l, unnest(t) AS t FROM p))
SELECT page_id, 'ancestor' AS found, title AS content FROM p
UNION ALL SELECT page_id, 'following sibling', ad FROM p
UNION ALL SELECT page_id, 'second to last', l[-2] FROM p WHERE len(l) > 1
UNION ALL SELECT page_id, 'preceding', l FROM z
UNION ALL SELECT page_id, 'group', {_plain("t[2]")} FROM p WHERE len(t) > 1
UNION ALL SELECT page_id, 'after the second', unnest(l[3:]) FROM p
UNION ALL SELECT page_id, 'counted', l[1] FROM p WHERE len(l) > 5
UNION ALL SELECT page_id, 'text', l FROM z WHERE contains(t, 'an')
UNION ALL SELECT page_id, 'equal', l FROM z WHERE t = 'the'
UNION ALL SELECT page_id, 'short', l FROM z WHERE length(t) < 4
UNION ALL SELECT page_id, 'next', ad FROM p""")
def xpath_axes(spark, folder):
    return _found(
        page_nodes(spark, folder, stored=True),
        "page_id",
        {
            "ancestor": "//b/ancestor::article[h1]/h1/text()",
            "following sibling": "//nav[ul/li]/following-sibling::div[@class='ad']/text()",
            "second to last": "//li[last()]/preceding-sibling::li[1]/a/@href",
            "preceding": "//footer/preceding::a/@href",
            "group": "(//nav//a)[2]/text()",
            "after the second": "//li[position() = 2]/following-sibling::li/a/@href",
            "counted": "//nav[count(ul/li) > 5]/ul/li[1]/a/@href",
            "text": "//li[contains(., 'an')]/a/@href",
            "equal": "//ul[li]/li[a = 'the']/a/@href",
            "short": "//a[string-length(.) < 4]/@href",
            "next": "//nav/following::text()[1]",
        },
    )


@query("""
WITH o AS (SELECT *, o_orderkey AS doc_id FROM orders WHERE o_orderkey % 100 <> 0)
SELECT doc_id, 'after a text' AS found, o_orderpriority AS content FROM o
UNION ALL SELECT doc_id, 'child is', doc_id::VARCHAR FROM o WHERE o_orderpriority = '5-LOW'
UNION ALL SELECT doc_id, 'number', o_custkey::VARCHAR FROM o WHERE o_custkey > 70
UNION ALL SELECT doc_id, 'before', o_custkey::VARCHAR FROM o
UNION ALL SELECT doc_id, 'back up', o_orderstatus FROM o
UNION ALL SELECT doc_id, 'last of all', o_orderpriority FROM o
UNION ALL SELECT doc_id, 'length', doc_id::VARCHAR FROM o WHERE length(o_custkey::VARCHAR) = 2
UNION ALL SELECT doc_id, 'last of the group', o_orderpriority FROM o
UNION ALL SELECT doc_id, 'whole', doc_id::VARCHAR FROM o WHERE contains(o_custkey || '<' || o_totalprice, '7<1')""")
def xpath_axes_xml(spark, folder):
    return _found(
        xml_nodes(spark, folder),
        "doc_id",
        {
            "after a text": "//tag[. = 'a & b']/following-sibling::tag/text()",
            "child is": "/order[tag = '5-LOW']/@id",
            "number": "/order/customer[. > 70]/text()",
            "before": "/order/price/preceding-sibling::*[1]/text()",
            "back up": "//tag[last()]/text()/ancestor::order[count(tag) = 2 and price/text()]/@status",
            "last of all": "//customer/following::text()[last()]",
            "length": "/order[string-length(customer) = 2]/@id",
            "last of the group": "(//tag | //price)[last()]/text()",
            "whole": "/order[contains(., '7<1')]/@id",
        },
    )


@query("""
SELECT o_orderkey AS doc_id, o_orderkey::VARCHAR AS id, o_orderstatus AS status, o_custkey::VARCHAR AS customer,
  '<' || o_totalprice || '>' AS price, 'a & b' AS tag FROM orders WHERE o_orderkey % 100 <> 0""")
def parse_xml(spark, folder):
    nodes = M.parse_xml(xml_documents(spark, folder), "doc_id", "raw", columns=["path", "content", "attrs"])
    at = F.col("path")
    text = {p: F.max(F.when(at == f"/order/{p}/text()", F.col("content"))) for p in ("customer", "price", "tag[1]")}
    root = F.when(at == "/order", F.col("attrs"))
    return nodes.groupBy("doc_id").agg(
        F.max(root["id"]).alias("id"),
        F.max(root["status"]).alias("status"),
        text["customer"].alias("customer"),
        text["price"].alias("price"),
        text["tag[1]"].alias("tag"),
    )


@query("SELECT o_orderkey AS doc_id FROM orders WHERE o_orderkey % 100 = 0")
def xml_quarantine(spark, folder):
    return M.xml_quarantine(xml_documents(spark, folder), "doc_id", "raw").select("doc_id")


@query("SELECT o_orderkey AS doc_id, unnest(['a & b', o_orderpriority]) AS tag FROM orders WHERE o_orderkey % 100 <> 0")
def xpath_query_xml(spark, folder):
    nodes = xml_nodes(spark, folder)
    return X.xpath_query(nodes, "/order[@status]/tag/text()").select("doc_id", F.col("content").alias("tag"))


@query("""
WITH o AS (SELECT * FROM orders WHERE o_orderkey % 100 <> 0)
SELECT o_orderkey AS doc_id, 'last' AS found, o_orderpriority AS content FROM o
UNION ALL SELECT o_orderkey, 'before last', 'a & b' FROM o
UNION ALL SELECT o_orderkey, 'below two', 'a & b' FROM o
UNION ALL SELECT o_orderkey, 'contains', o_orderpriority FROM o WHERE contains(o_orderpriority, 'URGENT')
UNION ALL SELECT o_orderkey, 'equal', o_orderpriority FROM o WHERE o_orderpriority = '5-LOW'
UNION ALL SELECT o_orderkey, 'children', o_orderkey::VARCHAR FROM o WHERE o_orderstatus = 'F' OR o_orderkey::VARCHAR LIKE '1%'
UNION ALL SELECT o_orderkey, 'either', unnest([o_custkey::VARCHAR, '<' || o_totalprice || '>']) FROM o""")
def xpath_conditions(spark, folder):
    nodes = xml_nodes(spark, folder)
    paths = {
        "last": "/order/tag[last()]/text()",
        "before last": "/order/tag[last()-1]/text()",
        "below two": "/order/tag[position() < 2]/text()",
        "contains": "//tag[contains(text(), 'URGENT')]/text()",
        "equal": "//tag[text()='5-LOW']/text()",
        "children": "/order[customer and not(missing) and (@status='F' or starts-with(@id, '1'))]/@id",
        "either": "/order/customer/text() | /order/price/text()",
    }
    return _found(nodes, "doc_id", paths)


@query(f"""WITH {BARE}, t AS (SELECT unnest(regexp_extract_all(h, '<([a-z][a-z0-9]*)[ >]', 1)) AS name FROM bare)
SELECT name, count(*) AS nodes FROM t GROUP BY name""")
def register_node_functions(spark, folder):
    register_functions(spark)
    on_all_cores(table(spark, folder, "pages"), "page_id").createOrReplaceTempView("saved_pages")
    return spark.sql("""
        SELECT n.name, count(*) AS nodes FROM saved_pages, LATERAL parse_html(html) n
        WHERE n.type = 'ELEMENT' GROUP BY n.name""")
