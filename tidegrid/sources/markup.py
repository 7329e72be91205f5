"""XML and HTML text to a node table, one row per node.

Building a tree needs a stack per document, which no built-in operator has, so
each document is read once by the tokenizer of the Python standard library, in
Arrow batches. The rows carry what later steps need to stay plain joins,
filters and windows: the preorder number of a node and of its last descendant,
its place among its siblings, and where its text lies in that of the document.
"""

from collections import Counter
from html.parser import HTMLParser
from operator import itemgetter
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import types as T

# Rows per Arrow batch that a task hands back to Spark.
BATCH_ROWS = 20_000

NODE_FIELDS = [
    ("node_id", T.IntegerType(), pa.int32()),
    ("parent_id", T.IntegerType(), pa.int32()),
    ("last_desc", T.IntegerType(), pa.int32()),
    ("depth", T.IntegerType(), pa.int32()),
    ("pos", T.IntegerType(), pa.int32()),
    ("nth", T.IntegerType(), pa.int32()),
    ("element_no", T.IntegerType(), pa.int32()),
    ("type", T.StringType(), pa.string()),
    ("name", T.StringType(), pa.string()),
    ("path", T.StringType(), pa.string()),
    ("content", T.StringType(), pa.string()),
    ("attrs", T.MapType(T.StringType(), T.StringType()), pa.map_(pa.string(), pa.string())),
    ("text_start", T.IntegerType(), pa.int32()),
    ("text_end", T.IntegerType(), pa.int32()),
]

# The names of the node types, in the order of their codes 1 to 20.
NODE_TYPES = [
    "ELEMENT",
    "ATTRIBUTE",
    "TEXT",
    "CDATA",
    "ENTITY_REF",
    "ENTITY",
    "PI",
    "COMMENT",
    "DOCUMENT",
    "DOCUMENT_TYPE",
    "DOCUMENT_FRAG",
    "NOTATION",
    "HTML_DOCUMENT",
    "DTD",
    "ELEMENT_DECL",
    "ATTRIBUTE_DECL",
    "ENTITY_DECL",
    "NAMESPACE_DECL",
    "XINCLUDE_START",
    "XINCLUDE_END",
]

# HTML elements without content, with raw content, and of the head.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style"}
HEAD = set("base link meta script style title noscript".split())

# Which open elements a start tag ends, and where the search stops.
PARAGRAPH_ENDS = set(
    "address article aside blockquote center details dir div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    **{part: ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}) for part in ("thead", "tbody", "tfoot")},
    **{tag: ({"p"}, {"table", "td", "th", "button", "object"}) for tag in PARAGRAPH_ENDS},
}


class _Tree:
    """The nodes of one document in preorder, with the stack of open elements."""

    def __init__(self, keep_blanks=True):
        self.nodes, self.stack, self.text_at, self.keep_blanks = [], [], 0, keep_blanks
        self.open_names = Counter()

    def add(self, kind, name=None, content=None, attrs=None):
        node = {
            "node_id": len(self.nodes),
            "parent_id": self.stack[-1]["node_id"] if self.stack else None,
            "last_desc": len(self.nodes),
            "depth": len(self.stack),
            "type": kind,
            "name": name,
            "content": content,
            "attrs": attrs,
            "text_start": self.text_at,
        }
        if kind in ("TEXT", "CDATA"):
            self.text_at += len(content)
        node["text_end"] = self.text_at
        self.nodes.append(node)
        return node

    def open(self, name, attrs):
        self.stack.append(self.add("ELEMENT", name, attrs=attrs))
        self.open_names[name] += 1

    def close(self):
        node = self.stack.pop()
        self.open_names[node["name"]] -= 1
        node["last_desc"], node["text_end"] = len(self.nodes) - 1, self.text_at

    def text(self, data, kind="TEXT"):
        before = self.nodes[-1] if self.nodes else None
        parent = self.stack[-1]["node_id"] if self.stack else None
        if before and before["type"] == kind == "TEXT" and before["parent_id"] == parent:
            before["content"] += data
            self.text_at += len(data)
            before["text_end"] = self.text_at
        else:
            self.add(kind, "#text" if kind == "TEXT" else "#cdata", data)

    def rows(self, paths=True):
        """The nodes with their places among siblings and, where wanted, their paths."""
        while self.stack:
            self.close()
        if not self.keep_blanks:
            self._drop_blanks()
        named, children, elements = {}, {}, {}
        for node in self.nodes:
            parent, element = node["parent_id"], node["type"] == "ELEMENT"
            node["step"] = step = node["name"] if element else _step(node)
            node["pos"] = children[parent] = children.get(parent, -1) + 1
            node["nth"] = named[parent, step] = named.get((parent, step), 0) + 1
            if element:
                elements[parent] = elements.get(parent, 0) + 1
            node["element_no"] = elements[parent] if element else None
        for node in self.nodes if paths else ():
            parent, step = node["parent_id"], node["step"]
            path = f"/{step}" if parent is None else f"{self.nodes[parent]['path']}/{step}"
            node["path"] = f"{path}[{node['nth']}]" if named[parent, step] > 1 else path
        return self.nodes

    def _drop_blanks(self):
        kept = [n for n in self.nodes if n["type"] != "TEXT" or n["content"].strip()]
        number = {n["node_id"]: i for i, n in enumerate(kept)}
        ids = [n["node_id"] for n in kept]
        removed, at = [0] * (len(self.nodes) + 1), 0
        for i, n in enumerate(self.nodes):
            removed[i] = at
            at += i not in number
        removed[len(self.nodes)] = at
        self.nodes = kept
        text = 0
        for i, n in zip(ids, kept):
            n["last_desc"] -= removed[n["last_desc"] + 1]
            n["node_id"] = number[i]
            n["parent_id"] = None if n["parent_id"] is None else number[n["parent_id"]]
        for n in kept:
            n["text_start"] = text
            text += len(n["content"]) if n["type"] in ("TEXT", "CDATA") else 0
            n["text_end"] = text
        for n in reversed(kept):
            n["text_end"] = kept[n["last_desc"]]["text_end"]


def _step(node):
    if node["type"] in ("TEXT", "CDATA"):
        return "text()"
    if node["type"] == "COMMENT":
        return "comment()"
    if node["type"] == "PI":
        return f"processing-instruction('{node['name']}')"
    return "" if node["type"] == "DTD" else node["name"]


class _HtmlReader(HTMLParser):
    """Tokens of any markup to a tree; no input is an error."""

    def __init__(self, tree, implied=True):
        super().__init__(convert_charrefs=True)
        self.tree, self.implied, self.html, self.body = tree, implied, False, False

    def _top(self):
        return self.tree.stack[-1]["name"] if self.tree.stack else None

    def _imply(self, tag=None):
        """Open html, head or body where the page left them out."""
        if not self.implied:
            return
        if not self.html and tag != "html":
            self.handle_starttag("html", [])
        if self.body or tag in ("html", "head", "body", "frameset"):
            return
        names = self.tree.open_names
        if tag in HEAD:
            if not names["head"]:
                self.tree.open("head", None)
        elif not names["title"]:
            if self._top() == "head":
                self.tree.close()
            if len(self.tree.stack) == 1:
                self.handle_starttag("body", [])

    def handle_starttag(self, tag, attrs):
        attrs = dict(reversed(attrs)) if attrs else None
        if tag == "html" and self.html or tag == "body" and self.body:
            return
        if tag == "body":
            while len(self.tree.stack) > 1:
                self.tree.close()
        self._imply(tag)
        self.html, self.body = self.html or tag == "html", self.body or tag == "body"
        ended, stops = ENDS.get(tag, ((), ()))
        if any(self.tree.open_names[name] for name in ended):
            cut = len(self.tree.stack)
            for i in reversed(range(cut)):
                name = self.tree.stack[i]["name"]
                if name in stops:
                    break
                if name in ended:
                    cut = i
            while len(self.tree.stack) > cut:
                self.tree.close()
        self.tree.open(tag, attrs)
        if tag in VOID:
            self.tree.close()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self._top() == tag:
            self.tree.close()

    def handle_endtag(self, tag):
        # The end of the page ends html and body, so that trailing nodes stay inside.
        if tag in ("html", "body") or not self.tree.open_names[tag]:
            return
        while self.tree.stack:
            name = self.tree.stack[-1]["name"]
            self.tree.close()
            if name == tag:
                return

    def handle_data(self, data):
        parent = self._top()
        if parent in RAW:
            self.tree.text(data, "CDATA")
        elif data.strip() or parent not in (None, "html", "head"):
            self._imply()
            self.tree.text(data)

    def handle_comment(self, data):
        self.tree.add("COMMENT", "#comment", data)

    def handle_decl(self, decl):
        self.tree.add("DTD", (decl.split() + ["", ""])[1].lower(), decl)

    def unknown_decl(self, data):
        self.tree.add("COMMENT", "#comment", f"[{data}]")

    def handle_pi(self, data):
        self.tree.add("PI", data.split(None, 1)[0].rstrip("?") if data.strip("?") else "", data)


def _html_nodes(text, options):
    tree = _Tree(not options.get("noblanks"))
    reader = _HtmlReader(tree, not options.get("noimplied"))
    reader.feed(text.removeprefix("\ufeff"))
    reader.close()
    return tree.rows(options.get("paths", True)), None


def _xml_nodes(text, options):
    """The nodes of an XML text, and the error where it is not well formed."""
    tree = _Tree(not options.get("noblanks"))
    parser = expat.ParserCreate("utf-8")
    parser.ordered_attributes, parser.buffer_text, parser.buffer_size = True, True, 65536
    section = []

    def start(name, attrs):
        pairs = {k: v for k, v in zip(attrs[::2], attrs[1::2]) if k != "xmlns" and not k.startswith("xmlns:")}
        tree.open(name, pairs or None)

    def text_node(data):
        if section:
            section.append(data)
        elif tree.stack:
            tree.text(data)

    def end_section():
        data = "".join(section[1:])
        section.clear()
        tree.text(data, "TEXT" if options.get("nocdata") else "CDATA")

    parser.StartElementHandler = start
    parser.EndElementHandler = lambda name: tree.close()
    parser.CharacterDataHandler = text_node
    parser.CommentHandler = lambda data: tree.add("COMMENT", "#comment", data)
    parser.ProcessingInstructionHandler = lambda target, data: tree.add("PI", target, data)
    parser.StartCdataSectionHandler = lambda: section.append("")
    parser.EndCdataSectionHandler = end_section
    parser.StartDoctypeDeclHandler = lambda name, *rest: tree.add("DTD", name)
    error = None
    try:
        parser.Parse(text.removeprefix("\ufeff").encode("utf-8", "replace"), True)
    except expat.ExpatError as failure:
        error = str(failure)
    if error and not options.get("recover"):
        return [], error
    return tree.rows(options.get("paths", True)), error


def _id_arrow(frame, doc_id):
    kind = frame.schema[doc_id].dataType
    types = {"long": pa.int64(), "integer": pa.int32(), "string": pa.string()}
    if kind.typeName() not in types:
        raise ValueError("a document id is a string or an integer")
    return types[kind.typeName()]


def _maps(values):
    """Dictionaries of texts, or None, as an Arrow column, made of two flat ones."""
    starts, keys, items = [], [], []
    for held in values:
        starts.append(None if held is None else len(keys))
        if held:
            keys.extend(held)
            items.extend(held.values())
    offsets = pa.array([*starts, len(keys)], pa.int32())
    return pa.MapArray.from_arrays(offsets, pa.array(keys, pa.string()), pa.array(items, pa.string()))


def _parse(frame, doc_id, body, read, options, columns):
    documents = frame.select(doc_id, body).where(f"`{body}` IS NOT NULL")
    id_type = _id_arrow(frame, doc_id)
    fields = [f for f in NODE_FIELDS if columns is None or f[0] in columns]
    options = {**options, "paths": columns is None or "path" in columns}
    schema = T.StructType([frame.schema[doc_id], *[T.StructField(n, t) for n, t, _ in fields]])
    arrow = pa.schema([(doc_id, id_type), *[(n, t) for n, _, t in fields]])

    def parse(batches):
        ids, held = [], []
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                nodes, _ = read(text, options)
                ids.extend([key] * len(nodes))
                held.extend(nodes)
                if len(held) >= BATCH_ROWS:
                    yield to_batch(ids, held)
                    ids, held = [], []
        if held:
            yield to_batch(ids, held)

    def to_batch(ids, nodes):
        columns = [pa.array(ids, id_type)]
        for name, _, kind in fields:
            values = list(map(itemgetter(name), nodes))
            columns.append(_maps(values) if name == "attrs" else pa.array(values, kind))
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    return documents.mapInArrow(parse, schema)


def parse_xml(frame, doc_id, body, recover=False, noblanks=False, nocdata=False, columns=None):
    """The node table of XML texts.

    A text that is not well formed gives no nodes and a row in `xml_quarantine`;
    with `recover` it gives the nodes up to the error. `noblanks` leaves out
    blank text, `nocdata` makes sections plain text. `columns` names the node
    columns that are wanted, since Spark cannot prune what a tokenizer returns.
    """
    options = {"recover": recover, "noblanks": noblanks, "nocdata": nocdata}
    return _parse(frame, doc_id, body, _xml_nodes, options, columns)


def parse_html(frame, doc_id, body, noblanks=False, noimplied=False, columns=None):
    """The node table of HTML texts; any text gives a tree.

    `noimplied` does not add html, head and body where a page leaves them out,
    `columns` names the node columns that are wanted.
    """
    return _parse(frame, doc_id, body, _html_nodes, {"noblanks": noblanks, "noimplied": noimplied}, columns)


def xml_quarantine(frame, doc_id, body):
    """The documents that are not well-formed XML, with the error."""
    id_type = _id_arrow(frame, doc_id)
    schema = T.StructType([frame.schema[doc_id], T.StructField("error", T.StringType())])

    def check(batches):
        for batch in batches:
            found = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                error = _xml_nodes(text, {})[1]
                if error:
                    found.append((key, error))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in found], id_type), pa.array([e for _, e in found], pa.string())],
                schema=pa.schema([(doc_id, id_type), ("error", pa.string())]),
            )

    return frame.select(doc_id, body).where(f"`{body}` IS NOT NULL").mapInArrow(check, schema)


def read_xml_rows(spark, path, row_tag, schema=None):
    """XML files by row tag with Spark's reader, for data of a known shape."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader if schema is None else reader.schema(schema)).load(path)
