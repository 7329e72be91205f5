"""JSON values: types, paths, keys, text."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.tables import match_wildcard
from tidegrid.session import store

# Levels of nesting that one job opens; the first, which reads all texts, opens few.
LEVELS, FIRST_LEVELS = 8, 2

# Our names of the types that a variant can have.
TYPE_NAMES = {
    "OBJECT": "object",
    "ARRAY": "array",
    "STRING": "string",
    "BOOLEAN": "boolean",
    "VOID": "null",
    "NONE": "error",
}


def _column(value):
    return F.col(value) if isinstance(value, str) else value


def json_type(value):
    """`object`, `array`, `string`, `number`, `boolean`, `null`, or `error` for no value."""
    # The schema is asked for once; other names than these are numbers.
    schema = F.coalesce(F.substring_index(F.schema_of_variant(_column(value)), "<", 1), F.lit("NONE"))
    names = F.create_map(*[F.lit(text) for pair in TYPE_NAMES.items() for text in pair])
    return F.coalesce(F.try_element_at(names, schema), F.lit("number"))


def path_segments(key):
    """The segments of a key: `.a.0.b`, a plain name, an index, or a list of these."""
    if isinstance(key, int):
        return [key]
    if isinstance(key, str):
        if not key.startswith("."):
            return [int(key) if key.isdigit() else key]
        return [int(s) if s.isdigit() else s for s in key[1:].split(".")]
    return [segment for k in key for segment in path_segments(k)]


def json_value(value, key, as_type="variant", ignore_case=False):
    """The value at a path, null where there is none."""
    value, segments = _column(value), path_segments(key)
    if ignore_case:
        for s in segments:
            value = _step_in_any_case(value, s)
        return F.try_variant_get(value, "$", as_type)
    if any("'" in s and '"' in s for s in segments if isinstance(s, str)):
        raise ValueError("a key cannot have both kinds of quotes")
    quoted = [f"[{s}]" if isinstance(s, int) else f'["{s}"]' if "'" in s else f"['{s}']" for s in segments]
    return F.try_variant_get(value, "$" + "".join(quoted), as_type)


def json_first_value(raw, key):
    """The value at a path of a JSON text, as text; of a repeated key the first one."""
    steps = "".join(f"[{s}]" if isinstance(s, int) else f"['{s}']" for s in path_segments(key))
    return F.get_json_object(_column(raw), "$" + steps)


def has_duplicate_keys(raw):
    """Whether the object of a JSON text has a key twice; null if it is no object."""
    keys = F.json_object_keys(_column(raw))
    return F.size(keys) != F.size(F.array_distinct(keys))


def _step_in_any_case(value, segment):
    if isinstance(segment, int):
        return F.try_variant_get(value, f"$[{segment}]", "variant")
    entries = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    same = F.filter(entries, lambda e: F.lower(e["key"]) == segment.lower())
    return F.get(same, F.lit(0))["value"]


def json_stringify(value):
    """A value as compact JSON text."""
    return F.to_json(_column(value))


def json_object(*columns):
    """Columns as the text of one JSON object, nulls included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def json_array(*columns):
    """Columns of any types as the text of one JSON array."""
    texts = [F.coalesce(_json_text(_column(c)), F.lit("null")) for c in columns]
    return F.concat(F.lit("["), F.concat_ws(",", *texts), F.lit("]"))


def _json_text(column):
    held = F.to_json(F.struct(column.alias("v")))
    return F.when(column.isNotNull(), F.substr(held, F.lit(6), F.length(held) - 6))


def json_quote(text):
    """Text as a JSON string literal."""
    return _json_text(_column(text).cast("string"))


def json_path_split(path):
    """A dotted path as an array of segments."""
    return F.split(F.substr(_column(path), F.lit(2)), r"\.")


def json_path_join(segments):
    """An array of segments as a dotted path."""
    segments = _column(segments)
    return F.when(F.size(segments) > 0, F.concat(F.lit("."), F.array_join(segments, "."))).otherwise("")


def nesting_depth(raw):
    """How deep the objects and arrays of a JSON text nest; 0 for a text that is not valid."""
    raw = _column(raw)
    bare = F.regexp_replace(raw, r'"(?:[^"\\]++|\\.)*+"', "")
    brackets = F.split(F.regexp_replace(bare, r"[^\[\]{}]++", ""), "")
    walk = F.aggregate(
        brackets,
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("top")),
        lambda at, c: _deeper(at, F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0)),
    )
    return F.when(F.try_parse_json(raw).isNotNull(), walk["top"]).otherwise(0)


def _deeper(at, change) -> Column:
    now = at["now"] + change
    return F.struct(now.alias("now"), F.greatest(at["top"], now).alias("top"))


def json_keys(frame, raw, pattern="*", max_depth=None):
    """One row per key path of each JSON text, with the type of its value.

    The pattern applies to the key of every level; where it does not match, the
    levels below are left out as well. Array items are keys `0`, `1`, and so on.
    A text that is not valid has no keys.

    A job opens at most `LEVELS` levels, one `explode` each, so its plan does
    not grow with the data. The keys found are stored in the shared folder, and
    the next job opens the objects and arrays that are still open: a node keeps
    its value only if it is one, so plain values are passed on without theirs. The deepest nesting of the valid
    texts, measured over the table unless given, tells how many jobs there
    are; a text deeper than a given `max_depth` fails the query instead of
    losing keys.
    """
    checked = F.try_parse_json(raw)
    if max_depth is None:
        max_depth = frame.agg(F.max(nesting_depth(raw))).first()[0] or 0
    else:
        fits = nesting_depth(raw) <= max_depth
        checked = F.when(fits, checked).otherwise(
            F.raise_error(F.lit(f"JSON text nests deeper than {max_depth}")).cast("variant")
        )
    others = [c for c in frame.columns if c != raw]
    node = F.struct(F.lit("").alias("path"), F.lit("").alias("type"), checked.alias("value"), F.lit(True).alias("open"))
    rows, parts = frame.select(*others, node.alias("node"), F.lit("").alias("_from")), []
    begin = 0
    while begin < max(1, max_depth):
        end = min(max_depth, begin + (LEVELS if begin else FIRST_LEVELS))
        for _ in range(begin, end):
            rows = rows.withColumn("node", F.explode(_with_children(F.col("node"), pattern)))
        begin = max(end, 1)
        if begin < max_depth:
            rows = store(rows, "keys")
        # The node a job begins with was given out by the one before.
        given = rows.where(F.col("node.path") != F.col("_from"))
        parts.append(given.select(*others, F.col("node.path").alias("path"), F.col("node.type").alias("type")))
        rows = rows.where(F.col("node.open")).withColumn("_from", F.col("node.path"))
    return reduce(DataFrame.unionByName, parts)


def _matching(entries, pattern):
    return entries if pattern == "*" else F.filter(entries, lambda e: match_wildcard(e["key"], pattern))


def _with_children(node, pattern):
    """The node itself, no longer open, and its children where it was open."""
    path, value = node["path"], node["value"]
    nothing = F.lit(None).cast("variant")
    itself = F.array(F.struct(path.alias("path"), node["type"].alias("type"), nothing.alias("value"), F.lit(False).alias("open")))

    def typed(key, value):
        return F.struct(F.concat(path, F.lit("."), key).alias("path"), json_type(value).alias("type"), value.alias("value"))

    def child(made):
        nests = made["type"].isin("object", "array")
        held = F.when(nests, made["value"]).otherwise(nothing)
        return F.struct(made["path"].alias("path"), made["type"].alias("type"), held.alias("value"), nests.alias("open"))

    none = F.array().cast("array<struct<path:string,type:string,value:variant,open:boolean>>")
    members = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    items = F.transform(
        F.try_variant_get(value, "$", "array<variant>"), lambda v, i: F.struct(i.cast("string").alias("key"), v.alias("value"))
    )
    found = [
        F.transform(F.transform(_matching(a, pattern), lambda e: typed(e["key"], e["value"])), child)
        for a in (members, items)
    ]
    children = F.coalesce(*found, none)
    return F.when(node["open"], F.concat(itself, children)).otherwise(itself)


def json_key_inventory(frame, raw, pattern="*", max_depth=None):
    """For each key path and type the number of texts that have it."""
    single = frame.select(raw)
    keys = json_keys(single, raw, pattern, max_depth)
    return keys.groupBy("path", "type").agg(F.count(F.lit(1)).alias("documents"))
