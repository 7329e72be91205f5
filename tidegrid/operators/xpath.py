"""Location paths over a node table.

The steps without predicates at the front of a path are one regular expression
on the name path of a node, so `//nav//a` is a filter. Each later step is a
sweep over the nodes in document order or an equi-join with the parent (see
`axes`). A condition on what stands around a node is worked out backwards: from
the nodes at the end of its path, by the inverse axes, to the nodes that it
holds for. No step pairs nodes with each other, and no join is on the document
alone.
"""

import re
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.operators.axes import document, in_order, marked, match, placed, reach
from tidegrid.operators.nodes import node_content
from tidegrid.operators.paths import INVERSE, SELF, Path, has_place, parse_path

KINDS = {"text()": ["TEXT", "CDATA"], "comment()": ["COMMENT"]}
SIBLING_PLACES = ("child", "below")
DEEP = ("below", "descendant")


def xpath_query(nodes, query):
    """The nodes of every document that match a location path.

    Supported are `/`, `//`, all axes but `namespace`, names, `*`, `text()`,
    `comment()`, `node()`, `.`, `..`, `@name`, `@*`, alternatives with `|`, and
    groups as in `(//li)[2]/a`. Predicates are joined by `and`, `or` and
    `not(...)`; they hold positions (`[2]`, `[last()-1]`, `[position() < 3]`),
    paths that lead from the node (`[ul/li]`, `[ancestor::nav/@id]`), paths,
    `count(path)`, `string(path)`, `normalize-space(path)`,
    `string-length(path)` and `name()` compared with a text or a number, and
    `contains` and `starts-with` of a path and a text. A path compared with a
    value holds if one of its nodes does; a function takes its first node. Text
    of an element is that of its whole subtree.

    Along the axes of siblings any position can be asked for, along
    `following`, `descendant` and `ancestor` one from the start or the end,
    along `preceding` none; such a position stands alone in its brackets, and
    conditions on the order of nodes in `count` and functions hold paths of
    children with at most one step to descendants. Anything else raises
    ValueError. A path without a slash in front matches anywhere. An attribute
    comes as a row of type ATTRIBUTE with the number of its element. A node
    that several alternatives find comes once.
    """
    return _alternatives(nodes, parse_path(query))


def _alternatives(nodes, paths):
    found = [_path(nodes, path) for path in paths]
    if len(found) == 1:
        return found[0]
    shown = [c for c in (document(nodes), "node_id", "type", "name", "path", "content") if c in nodes.columns]
    if not any("ATTRIBUTE" == p.steps[-1].axis.upper() for p in paths if p.steps):
        keys = reduce(DataFrame.unionByName, [f.select(document(nodes), "node_id") for f in found])
        return match(nodes, keys, {"node_id": "node_id"})
    return reduce(DataFrame.unionByName, [f.select(shown) for f in found]).distinct()


def _path(nodes, path):
    steps = path.steps
    if path.group:
        found = _in_group(nodes, _alternatives(nodes, path.group[0]), path.group[1])
    else:
        found, steps = _front(nodes, steps)
    for step in steps:
        found = _step(nodes, found, step)
    return found


def _in_group(nodes, found, predicates):
    """Predicates of a group: positions count all its nodes of a document, in their order."""
    if predicates and "last_desc" not in found.columns:
        raise ValueError("a group with conditions holds no attributes")
    for tree in predicates:
        columns = found.columns
        if has_place(tree):
            whole = Window.partitionBy(document(nodes))
            found = found.withColumns({"_rank": F.row_number().over(whole.orderBy("node_id")), "_size": F.count(F.lit(1)).over(whole)})
        found = _where(nodes, found, tree).select(columns)
    return found


def _front(nodes, steps):
    """The nodes that the first steps lead to, from the document, and the steps that are left."""
    front = []
    for step in steps:
        if step.axis not in SIBLING_PLACES:
            break
        front.append(step)
        if step.predicates or step.test in KINDS or step.test == "node()":
            break
    if front:
        names = F.regexp_replace("path", r"\[\d+\]", "")
        found = nodes.where(names.rlike(_front_regex(front)))
        if front[-1].test != "node()":
            found = found.where(_kind(front[-1].test))
        return _filter(nodes, found, front[-1]), steps[len(front) :]
    if steps[0].axis in ("descendant", "descendant-or-self"):
        # All nodes lie below the document, which itself is not among them.
        after = steps[1] if len(steps) > 1 else SELF
        if steps[0] == ("descendant-or-self", "node()", ()) and after.axis == "child":
            return _front(nodes, (after._replace(axis="below"), *steps[2:]))
        if any(has_place(p) for p in steps[0].predicates):
            raise ValueError("a position below the document is asked for as (//name)[n]")
        return _filter(nodes, nodes.where(_test(steps[0].test)), steps[0]), steps[1:]
    raise ValueError(f"a path has no element to begin at before {steps[0].axis}")


def _front_regex(front):
    parts = []
    for step in front:
        name = r"[^/]+" if step.test in ("*", "node()") else re.escape(step.test)
        parts.append(("/(?:[^/]+/)*" if step.axis == "below" else "/") + name)
    return r"\A" + "".join(parts) + r"\z"


def _kind(test):
    return F.col("type").isin(KINDS.get(test, ["ELEMENT"]))


def _test(test):
    if test == "node()":
        return F.lit(True)
    return _kind(test) if test == "*" or test in KINDS else _kind(test) & (F.col("name") == test)


def _step(nodes, found, step):
    if step.axis == "attribute":
        return _attributes(found, step.test)
    first = next((i for i, p in enumerate(step.predicates) if has_place(p)), None)
    if first is None or step.axis in SIBLING_PLACES or step.axis in ("self", "parent"):
        return _filter(nodes, reach(nodes, found, step.axis).where(_test(step.test)), step)
    # Along other axes a place depends on the node it is counted from.
    before, tree, after = step.predicates[:first], step.predicates[first], step.predicates[first + 1 :]
    if tree[0] != "place" or any(has_place(p) for p in after):
        raise ValueError(f"a position along {step.axis} stands alone in its brackets")
    candidates = _filter(nodes, nodes.where(_test(step.test)), step._replace(predicates=before))
    found = placed(nodes, found, candidates, step.axis, tree[1], tree[2])
    return _filter(nodes, found, step._replace(predicates=after))


def _filter(nodes, found, step):
    """Apply the predicates of one step from left to right; places count among the children of a parent."""
    stored = {"*": "element_no"}.get(step.test, "nth")
    for number, tree in enumerate(step.predicates):
        first = number == 0 and step.axis in SIBLING_PLACES and step.test != "node()"
        if first and tree[:2] == ("place", "eq") and tree[2][0] == "number":
            found = found.where(F.col(stored) == tree[2][1])
            continue
        columns = found.columns
        if has_place(tree) and step.axis in SIBLING_PLACES:
            within = Window.partitionBy(document(nodes), "parent_id")
            found = found.withColumns({"_rank": F.row_number().over(within.orderBy("pos")), "_size": F.count(F.lit(1)).over(within)})
        elif has_place(tree):
            # Itself, or the parent: one node.
            found = found.withColumns({"_rank": F.lit(1), "_size": F.lit(1)})
        found = _where(nodes, found, tree).select(columns)
    return found


def _where(nodes, found, tree):
    """The rows that a condition holds for; columns that it needs are added to `found`."""
    asked = {}

    def ask(frame, column):
        """Bring a column of (document, node_id) rows to the nodes."""
        nonlocal found
        name = f"_asked_{len(asked)}"
        asked[name] = True
        found = match(found, frame.select(document(nodes), "node_id", F.col(column).alias(name)), {"node_id": "node_id"}, "left")
        return F.col(name)

    def text(value):
        kind = value[0]
        if kind == "string":
            return F.lit(value[1])
        if kind == "name":
            return F.when(F.col("type") == "ELEMENT", F.col("name")).otherwise("")
        if kind == "normalize-space":
            return F.regexp_replace(F.regexp_replace(text(value[1]), r"\A[ \t\r\n]+|[ \t\r\n]+\z", ""), r"[ \t\r\n]+", " ")
        steps = value[1]
        if steps[-1].axis == "attribute" and len(steps) == 1 and steps[0].test != "*":
            return F.coalesce(F.try_element_at("attrs", F.lit(steps[0].test)), F.lit(""))
        return F.coalesce(ask(_first_text(nodes, found, steps), "_text"), F.lit(""))

    def column(tree):
        kind = tree[0]
        if kind in ("and", "or"):
            one, two = column(tree[1]), column(tree[2])
            return one & two if kind == "and" else one | two
        if kind == "not":
            return ~column(tree[1])
        if kind == "place":
            _, operator, (what, number) = tree
            other = F.lit(number) if what == "number" else F.col("_size") - number
            return getattr(F.col("_rank"), f"__{operator}__")(other)
        if kind == "has":
            return exists(tree[1], None)
        if kind == "contains":
            return text(tree[1]).contains(tree[2])
        if kind == "starts-with":
            return text(tree[1]).startswith(tree[2])
        _, operator, value, literal = tree
        if value[0] == "path":
            return exists(value[1], (operator, literal))
        if value[0] == "count":
            counted = F.coalesce(ask(_counts(nodes, value[1]), "_count"), F.lit(0))
            return _compare(counted.cast("string"), operator, literal)
        held = F.length(text(value[1])).cast("string") if value[0] == "string-length" else text(value)
        return _compare(held, operator, literal)

    def exists(steps, wanted):
        if len(steps) == 1 and steps[0].axis == "attribute":
            return F.coalesce(_holds_attribute(steps[0].test, wanted), F.lit(False))
        holders = _holders(nodes, steps, wanted).select(document(nodes), "node_id").distinct()
        return F.coalesce(ask(holders.withColumn("_yes", F.lit(True)), "_yes"), F.lit(False))

    condition = column(tree)
    return found.where(condition)


def _compare(held, operator, literal):
    """A text compared with a text, or as a number with a number; one that is no number differs from any."""
    kind, value = literal
    if kind == "string" and operator in ("eq", "ne"):
        return getattr(held, f"__{operator}__")(value)
    if kind == "string":
        try:
            value = float(value)
        except ValueError:
            return F.lit(False)
    number = F.when(F.trim(held, F.lit(" \t\r\n")).rlike(r"\A-?([0-9]+(\.[0-9]*)?|\.[0-9]+)\z"), F.trim(held, F.lit(" \t\r\n")).try_cast("double"))
    return F.coalesce(getattr(number, f"__{operator}__")(value), F.lit(operator == "ne"))


def _holds_attribute(name, wanted):
    if name != "*":
        there = F.array_contains(F.map_keys("attrs"), name)
        return there if wanted is None else there & _compare(F.coalesce(F.try_element_at("attrs", F.lit(name)), F.lit("")), *wanted)
    if wanted is None:
        return F.size("attrs") > 0
    return F.exists(F.map_values("attrs"), lambda value: _compare(F.coalesce(value, F.lit("")), *wanted))


def _ends(nodes, step, wanted=None):
    """All nodes that a step can lead to, whose text compares as wanted; places count among siblings."""
    if any(has_place(p) for p in step.predicates) and step.axis not in (*SIBLING_PLACES, "self", "parent"):
        raise ValueError(f"a position along {step.axis} in a condition is not known")
    ends = _filter(nodes, nodes.where(_test(step.test)), step)
    if wanted is None:
        return ends
    operator, literal = wanted
    if operator == "eq" and literal[0] == "string":
        # Only elements with as much text are looked into.
        size = F.col("text_end") - F.col("text_start")
        ends = ends.where((F.col("type") != "ELEMENT") | (size == len(literal[1])))
    columns = ends.columns
    held = ends.withColumn("_text", F.col("content")) if step.test in KINDS else node_content(nodes, ends, "_text")
    return held.where(_compare(F.coalesce("_text", F.lit("")), operator, literal)).select(columns)


def _holders(nodes, steps, wanted):
    """The nodes from which a path leads to an end whose text compares as wanted: back from there, step by step."""
    steps = list(steps)
    if steps[-1].axis == "attribute":
        current = nodes.where(_holds_attribute(steps.pop().test, wanted))
    else:
        last = steps.pop()
        current = reach(nodes, _ends(nodes, last, wanted), INVERSE[last.axis])
    while steps:
        step = steps.pop()
        if any(has_place(p) for p in step.predicates):
            current = match(_ends(nodes, step), current, {"node_id": "node_id"})
        else:
            current = _filter(nodes, current.where(_test(step.test)), step)
        current = reach(nodes, current, INVERSE[step.axis])
    return current


def _chain(steps):
    """Steps to children with at most one to descendants, each end reached once."""
    deep = [s for s in steps if s.axis in DEEP]
    if len(deep) > 1 or any(s.axis not in ("child", "self", *DEEP) for s in steps):
        raise ValueError("only paths of children with one step to descendants can be counted or read")
    return [s for s in steps if s != SELF]


def _counts(nodes, steps):
    """(document, node_id, _count): how many nodes a path leads to."""
    doc = document(nodes)
    steps = list(steps)
    if steps[-1].axis == "attribute":
        name = steps.pop().test
        held = F.size("attrs") if name == "*" else F.array_contains(F.map_keys("attrs"), name).cast("int")
        current = nodes.select(doc, "node_id", F.coalesce(held, F.lit(0)).cast("long").alias("_count")).where("_count > 0")
    else:
        current = None
    for step in reversed(_chain(steps)):
        ends = _ends(nodes, step)
        ends = ends.withColumn("_count", F.lit(1).cast("long")) if current is None else match(ends, current, {"node_id": "node_id"}, "inner")
        if step.axis == "child":
            current = ends.where(F.col("parent_id").isNotNull()).groupBy(doc, F.col("parent_id").alias("node_id")).agg(F.sum("_count").alias("_count"))
            continue
        # A sum over the nodes of a subtree is the running sum at its end less that at its top.
        held = match(nodes, ends.select(doc, "node_id", "_count"), {"node_id": "node_id"}, "left")
        run = held.withColumn("_run", F.coalesce(F.sum("_count").over(in_order(nodes).rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
        last = run.select(doc, "node_id", F.col("_run").alias("_end"))
        tops = match(run.select(doc, "node_id", "last_desc", "_run"), last, {"last_desc": "node_id"}, "inner")
        current = tops.select(doc, "node_id", (F.col("_end") - F.col("_run")).alias("_count")).where("_count > 0")
    if current is None:
        current = nodes.select(doc, "node_id", F.lit(1).cast("long").alias("_count"))
    return current


def _first_text(nodes, found, steps):
    """(document, node_id, _text): the text of the first node that a path leads to, for the nodes found."""
    doc = document(nodes)
    steps = list(steps)
    name = steps.pop().test if steps[-1].axis == "attribute" else None
    if name == "*":
        raise ValueError("the first of all attributes has no order")
    chain = _chain(steps)
    if any(s.axis in DEEP for s in chain[:-1]):
        raise ValueError("the first node of a path is read where only its last step goes to descendants")
    if not chain and name is None:
        if steps and any(s != SELF for s in steps):
            raise ValueError("unknown path in a function")
        return node_content(nodes, found, "_text").select(doc, "node_id", "_text").distinct()
    current = None
    for step in reversed(chain):
        ends = _ends(nodes, step)
        if current is None:
            ends = ends if name is None else ends.where(_holds_attribute(name, None))
            ends = ends.withColumn("_end", F.col("node_id"))
        else:
            ends = match(ends, current, {"node_id": "node_id"}, "inner")
        if step.axis == "child":
            current = ends.where(F.col("parent_id").isNotNull()).groupBy(doc, F.col("parent_id").alias("node_id")).agg(F.min("_end").alias("_end"))
            continue
        held = marked(nodes, ends)
        following = F.min(F.when(F.col("_in"), F.col("node_id"))).over(in_order(nodes, True).rowsBetween(Window.unboundedPreceding, -1))
        current = held.withColumn("_end", following).where("_end <= last_desc").select(doc, "node_id", "_end")
    current = match(current, found.select(doc, "node_id"), {"node_id": "node_id"})
    ends = match(nodes, current, {"node_id": "_end"})
    if name is not None:
        texts = ends.select(doc, "node_id", F.try_element_at("attrs", F.lit(name)).alias("_text"))
    else:
        texts = node_content(nodes, ends, "_text").select(doc, "node_id", "_text")
    return match(current, texts, {"_end": "node_id"}, "inner").select(doc, "node_id", "_text")


def _attributes(found, name):
    doc = found.columns[0]
    rows = found.select(doc, "node_id", "path", F.explode("attrs").alias("name", "content"))
    if name != "*":
        rows = rows.where(F.col("name") == name)
    return rows.select(
        doc,
        "node_id",
        F.lit("ATTRIBUTE").alias("type"),
        "name",
        F.concat("path", F.lit("/@"), F.col("name")).alias("path"),
        "content",
    )
