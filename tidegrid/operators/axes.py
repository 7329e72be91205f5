"""Sets of nodes that stand in a relation to other nodes, for all documents at once.

A node is the interval of preorder numbers from itself to its last descendant.
With the nodes of a document in order, all that a step along an axis must know
of the other nodes is one running value: the farthest end of those opened so
far (descendants), the next one to come (ancestors), the first that is closed
(following) or the last to be opened (preceding). So no step pairs nodes: it is
a window over one document or over the children of one parent, or an equi-join
of a node with its parent.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

OTHERS = Window.unboundedPreceding


def document(nodes):
    return nodes.columns[0]


def match(nodes, other, columns, how="left_semi"):
    """Join nodes with (document, number) pairs: `columns` maps a column of `nodes` to one of `other`."""
    doc = document(nodes)
    kept = [F.col(c).alias(f"_to_{c}") for c in {doc, *columns.values()}]
    same = F.col(doc) == F.col(f"_to_{doc}")
    for own, theirs in columns.items():
        same = same & (F.col(own) == F.col(f"_to_{theirs}"))
    extra = [] if how == "left_semi" else [c for c in other.columns if c not in (doc, *columns.values())]
    # Few bytes of a file are many nodes, so no side is sent whole to all tasks.
    joined = nodes.join(other.select(*kept, *extra).hint("merge"), same, how)
    return joined if how == "left_semi" else joined.drop(*[f"_to_{c}" for c in {doc, *columns.values()}])


def marked(nodes, found, out="_in"):
    """All nodes, with true for those found."""
    doc = document(nodes)
    flags = found.select(doc, "node_id").distinct().withColumn(out, F.lit(True))
    return match(nodes, flags, {"node_id": "node_id"}, "left")


def in_order(nodes, backwards=False):
    """The window of a document from its first node, or from its last."""
    return Window.partitionBy(document(nodes)).orderBy(F.col("node_id").desc() if backwards else F.col("node_id"))


def family(nodes, backwards=False):
    """The window of the children of one parent."""
    return Window.partitionBy(document(nodes), "parent_id").orderBy(F.col("pos").desc() if backwards else F.col("pos"))


def reach(nodes, found, axis):
    """The nodes on an axis of any of those found, each once."""
    if axis == "self":
        return found
    if axis == "child":
        return match(nodes, found, {"parent_id": "node_id"})
    if axis == "parent":
        return match(nodes, found.where(F.col("parent_id").isNotNull()).select(document(nodes), "parent_id"), {"node_id": "parent_id"})
    held = marked(nodes, found)
    at, end = F.when(F.col("_in"), F.col("node_id")), F.when(F.col("_in"), F.col("last_desc"))
    own = 0 if axis.endswith("-or-self") else -1
    if axis in ("below", "descendant", "descendant-or-self"):
        known = F.max(end).over(in_order(nodes).rowsBetween(OTHERS, own)) >= F.col("node_id")
    elif axis in ("ancestor", "ancestor-or-self"):
        known = F.min(at).over(in_order(nodes, True).rowsBetween(OTHERS, own)) <= F.col("last_desc")
    elif axis == "following":
        known = F.min(end).over(in_order(nodes).rowsBetween(OTHERS, -1)) < F.col("node_id")
    elif axis == "preceding":
        known = F.max(at).over(in_order(nodes, True).rowsBetween(OTHERS, -1)) > F.col("last_desc")
    else:
        known = F.max("_in").over(family(nodes, axis == "preceding-sibling").rowsBetween(OTHERS, -1))
    return held.withColumn("_known", known).where("_known").drop("_in", "_known")


def placed(nodes, context, candidates, axis, operator, place):
    """Those candidates that stand at a place along an axis, counted from any context node.

    `place` is ("number", n) or ("last", m), the last but m. Candidates have one
    rank in their order, and a context node one number of candidates that it
    has behind it, so the place from a node to a candidate is the difference of
    the two, and a place is found by an equi-join on rank less n.
    """
    kind, number = place
    if axis in ("following-sibling", "preceding-sibling"):
        return _among_siblings(nodes, context, candidates, axis == "preceding-sibling", operator, kind, int(number) if number == int(number) else number)
    if operator != "eq" or axis == "preceding":
        raise ValueError(f"a position of this kind along {axis} is not known")
    if number != int(number) or kind == "number" and number < 1:
        return candidates.limit(0)
    if axis in ("ancestor", "ancestor-or-self"):
        return _among_ancestors(nodes, context, candidates, axis, kind, int(number))
    return _in_document(nodes, context, candidates, axis, kind, int(number))


def _among_siblings(nodes, context, candidates, backwards, operator, kind, number):
    doc, order = document(nodes), family(nodes, backwards)
    held = marked(marked(nodes, context, "_from"), candidates, "_to")
    rank = F.count("_to").over(order.rowsBetween(OTHERS, 0))
    held = held.withColumn("_rank", rank)
    before = F.when(F.col("_from"), F.col("_rank"))
    held = held.withColumns(
        {
            "_near": F.max(before).over(order.rowsBetween(OTHERS, -1)),
            "_far": F.min(before).over(order.rowsBetween(OTHERS, -1)),
            "_all": F.count("_to").over(Window.partitionBy(doc, "parent_id")),
            "_parent": F.coalesce("parent_id", F.lit(-1)),
        }
    )
    found = held.where(F.col("_to") & F.col("_near").isNotNull())
    least, most = F.col("_rank") - F.col("_near"), F.col("_rank") - F.col("_far")
    if kind == "last":
        found = found.where(getattr(F.col("_rank"), f"__{operator}__")(F.col("_all") - number))
    elif operator == "eq":
        behind = held.where("_from").select(doc, "_parent", F.col("_rank").alias("_behind")).distinct()
        found = match(found.withColumn("_want", F.col("_rank") - number), behind, {"_parent": "_parent", "_want": "_behind"})
    elif operator == "ne":
        found = found.where((least != number) | (most != number))
    else:
        found = found.where(getattr(least if operator in ("lt", "le") else most, f"__{operator}__")(number))
    return found.select(nodes.columns)


def opened(nodes, candidates, out):
    """All nodes, with the number of candidates that are open above each: begun before it and not yet ended."""
    doc = document(nodes)
    ends = candidates.groupBy(doc, "last_desc").agg(F.count(F.lit(1)).alias("_ends"))
    held = match(marked(nodes, candidates, "_to"), ends, {"node_id": "last_desc"}, "left")
    change = F.when(F.col("_to"), 1).otherwise(0) - F.coalesce("_ends", F.lit(0))
    above = F.coalesce(F.sum(change).over(in_order(nodes).rowsBetween(OTHERS, -1)), F.lit(0))
    return held.withColumn(out, above).drop("_ends")


def _among_ancestors(nodes, context, candidates, axis, kind, number):
    doc = document(nodes)
    held = opened(nodes, candidates, "_above")
    reached = reach(nodes, context, axis)
    if kind == "last":
        return match(held.where(F.col("_to") & (F.col("_above") == number)), reached, {"node_id": "node_id"}).select(nodes.columns)
    selves = axis == "ancestor-or-self"
    own = F.col("_above") + F.when(F.col("_to") & F.lit(selves), 1).otherwise(0)
    asked = marked(held, context, "_from").where(F.coalesce("_from", F.lit(False))).select(doc, own.alias("_want"), "node_id", F.lit(None).cast("int").alias("_end"))
    given = held.where("_to").select(doc, (F.col("_above") + number).alias("_want"), "node_id", F.col("last_desc").alias("_end"))
    # Context nodes with as many open candidates above as the one wanted lies deep: the next of them must lie inside it.
    later = Window.partitionBy(doc, "_want").orderBy(F.col("node_id").desc()).rangeBetween(OTHERS, 0 if selves else -1)
    both = asked.unionByName(given).withColumn("_next", F.min(F.when(F.col("_end").isNull(), F.col("node_id"))).over(later))
    return match(nodes, both.where("_next <= _end").select(doc, "node_id"), {"node_id": "node_id"})


def _in_document(nodes, context, candidates, axis, kind, number):
    """Along `following`, `descendant` and `descendant-or-self`."""
    doc = document(nodes)
    held = marked(nodes, candidates, "_to").withColumn("_rank", F.count("_to").over(in_order(nodes).rowsBetween(OTHERS, 0)))
    held = held.withColumn("_all", F.count("_to").over(Window.partitionBy(doc)))
    ranks = held.select(doc, "node_id", F.col("_rank").alias("_seen"), F.coalesce("_to", F.lit(False)).alias("_own"))
    asked = context.select(doc, "node_id", "last_desc").distinct()
    ends = held.select(doc, "node_id", F.col("_rank").alias("_inside"), "_all")
    at_end = match(asked, ends, {"last_desc": "node_id"}, "left")
    if axis == "following":
        behind, limit = F.col("_inside"), F.lit(None).cast("long")
    else:
        at_end = match(at_end, ranks, {"node_id": "node_id"}, "left")
        selves = F.col("_own").cast("int") if axis == "descendant-or-self" else F.lit(0)
        behind, limit = F.col("_seen") - selves, F.col("_inside")
    # Nodes that have as many candidates behind them differ in how many they reach.
    asked = at_end.withColumns({"_behind": behind.cast("long"), "_limit": limit})
    if kind == "last":
        asked = asked if axis == "following" else asked.withColumn("_all", F.col("_limit"))
        want = asked.select(doc, (F.col("_all") - number).alias("_want"), "_behind").where("_want > _behind").drop("_behind")
    else:
        want = asked.where((F.col("_behind") + number <= F.col("_limit")) | F.col("_limit").isNull()).select(doc, (F.col("_behind") + number).alias("_want"))
    return match(held.where("_to"), want.distinct(), {"_rank": "_want"}).select(nodes.columns)
