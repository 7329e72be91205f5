"""Steps between the nodes of a node table, for all documents at once.

A document is one row of the input, so its nodes, and what is grouped by
document here, are bounded by the size of one row.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegrid.sources.markup import NODE_TYPES

TEXTS = ["TEXT", "CDATA"]


def _document(nodes):
    return nodes.columns[0]


def _siblings(nodes):
    return Window.partitionBy(_document(nodes), "parent_id").orderBy("pos")


def _attach(nodes, other, on, columns):
    """Add columns of a related node, matched by document and by `on` = its number."""
    doc = _document(nodes)
    related = other.select(
        F.col(doc).alias("_doc"), F.col("node_id").alias("_id"), *[F.col(c).alias(a) for c, a in columns.items()]
    )
    return nodes.join(related, (F.col(doc) == F.col("_doc")) & (F.col(on) == F.col("_id")))


def node_root(nodes):
    """The root element of each document."""
    return nodes.where(F.col("parent_id").isNull() & (F.col("type") == "ELEMENT"))


def node_type_profile(nodes):
    """How many nodes there are of each type."""
    return nodes.groupBy("type").agg(F.count(F.lit(1)).alias("nodes"))


def node_type_code(kind="type"):
    """The number of a node type, from 1."""
    names = F.array(*[F.lit(name) for name in NODE_TYPES])
    return F.nullif(F.array_position(names, F.col(kind) if isinstance(kind, str) else kind), F.lit(0)).cast("int")


def node_attributes(nodes):
    """One row per attribute of an element; those without a value are left out."""
    doc = _document(nodes)
    pairs = nodes.where(F.col("type") == "ELEMENT").select(doc, "node_id", "name", F.explode("attrs").alias("key", "value"))
    return pairs.where(F.col("value").isNotNull())


def document_text(nodes):
    """The whole text of each document."""
    doc = _document(nodes)
    texts = nodes.where(F.col("type").isin(TEXTS)).groupBy(doc).agg(
        F.sort_array(F.collect_list(F.struct("node_id", "content"))).alias("_texts")
    )
    return texts.select(doc, F.array_join(F.transform("_texts", lambda t: t["content"]), "").alias("text"))


def node_content(nodes, picked=None, out="node_content"):
    """Add the text of the whole subtree of each node, or of each `picked` node.

    The text of a subtree is one slice of the text of its document. Texts and
    picked nodes of a document meet in one row, and slices are cut there, so the
    text is held once and no node meets its descendants. Text of four bytes a
    character can be cut anywhere at once, without a count from its start.
    """
    doc = _document(nodes)
    picked = nodes if picked is None else picked
    texts = nodes.where(F.col("type").isin(TEXTS)).select(doc, F.struct("node_id", "content").alias("_t"))
    # Nodes that are not elements have their text with them.
    rest = picked.where(F.col("type") != "ELEMENT").withColumn(out, F.col("content"))
    asked = picked.where(F.col("type") == "ELEMENT").select(doc, F.struct(*picked.columns).alias("_p"))
    held = texts.unionByName(asked, allowMissingColumns=True).groupBy(doc).agg(
        F.sort_array(F.collect_list("_t")).alias("_t"), F.collect_list("_p").alias("_p")
    )
    whole = F.encode(F.array_join(F.transform("_t", lambda t: t["content"]), ""), "UTF-32")
    cut = held.where(F.size("_p") > 0).select(whole.alias("_whole"), F.explode("_p").alias("_p"))
    start, size = 4 * F.col("_p.text_start"), 4 * (F.col("_p.text_end") - F.col("_p.text_start"))
    slices = F.decode(F.substr("_whole", start + 1, size), "UTF-32")
    shown = cut.select("_p.*", slices.alias(out))
    return shown.unionByName(rest)


def node_list(nodes, wanted=None, out="node_list"):
    """The text of each node's text siblings from itself on, for all nodes or those `wanted`.

    It is the end of the text that the children of one parent have together, so
    no node meets its siblings.
    """
    doc = _document(nodes)
    text = F.col("type").isin(TEXTS)
    earlier = _siblings(nodes).rowsBetween(Window.unboundedPreceding, -1)
    skipped = F.sum(F.when(text, F.length("content"))).over(earlier)
    placed = nodes.withColumns({"_skip": F.coalesce(skipped, F.lit(0)), "_parent": F.coalesce("parent_id", F.lit(-1))})
    picked = placed if wanted is None else placed.where(wanted)
    own = (
        nodes.where(text)
        .groupBy(doc, F.coalesce("parent_id", F.lit(-1)).alias("_parent"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "content"))).alias("_texts"))
        .select(doc, "_parent", F.array_join(F.transform("_texts", lambda t: t["content"]), "").alias("_own"))
    )
    rest = F.substr("_own", (F.col("_skip") + 1).cast("int"))
    listed = picked.join(own, [doc, "_parent"], "left").withColumn(out, F.coalesce(rest, F.lit("")))
    return listed.drop("_skip", "_parent", "_own")


def node_children(nodes):
    """Pairs of a node and each of its element children, in order."""
    doc = _document(nodes)
    children = nodes.where((F.col("type") == "ELEMENT") & F.col("parent_id").isNotNull())
    return children.select(
        doc, F.col("parent_id").alias("node_id"), F.col("node_id").alias("child_id"), "name", "element_no"
    )


def node_siblings(nodes, picked):
    """All element children of the parents of the picked nodes, in order.

    Nodes with one parent have the same siblings, themselves included, so these
    come once per `parent_id`.
    """
    doc = _document(nodes)
    parents = picked.where(F.col("parent_id").isNotNull()).select(doc, "parent_id")
    elements = nodes.where(F.col("type") == "ELEMENT").select(
        doc, "parent_id", F.col("node_id").alias("sibling_id"), "name", "element_no"
    )
    return elements.join(parents, [doc, "parent_id"], "left_semi")


def node_next(nodes, node_type=None, out="next_id"):
    """Add the number of the next sibling, of a type or of any."""
    if node_type is None:
        return nodes.withColumn(out, F.lead("node_id").over(_siblings(nodes)))
    # From the last sibling back, so that the frame only ever grows.
    backwards = Window.partitionBy(_document(nodes), "parent_id").orderBy(F.col("pos").desc())
    later = backwards.rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.when(F.col("type") == node_type, F.col("node_id"))
    return nodes.withColumn(out, F.min(wanted).over(later))


def node_next_element(nodes, out="next_id"):
    """Add the number of the next element sibling."""
    return node_next(nodes, "ELEMENT", out)


def node_prev(nodes, node_type=None, out="prev_id"):
    """Add the number of the preceding sibling, of a type or of any."""
    if node_type is None:
        return nodes.withColumn(out, F.lag("node_id").over(_siblings(nodes)))
    earlier = _siblings(nodes).rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.when(F.col("type") == node_type, F.col("node_id"))
    return nodes.withColumn(out, F.max(wanted).over(earlier))


def node_child(nodes, node_type=None):
    """The first child, of a type or of any, of each node that has one."""
    doc = _document(nodes)
    wanted = nodes.where(F.col("parent_id").isNotNull())
    if node_type is not None:
        wanted = wanted.where(F.col("type") == node_type)
    return wanted.groupBy(doc, F.col("parent_id").alias("node_id")).agg(F.min("node_id").alias("child_id"))


def node_parent(nodes):
    """Add name and path of each node's parent; top nodes have none."""
    columns = {"name": "parent_name", "path": "parent_path"}
    return _attach(nodes, nodes.where(F.col("type") == "ELEMENT"), "parent_id", columns).drop("_doc", "_id")
