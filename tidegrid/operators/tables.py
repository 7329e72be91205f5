"""Typing, profiles, lookups and replacement on whole tables."""

from pyspark.sql import functions as F

from tidegrid.operators.series import _names

# How dates, times of day and numbers are written.
ISO_DATE = r"\A\d{4}-\d{1,2}-\d{1,2}\z"
ISO_TIME = r"\A\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\z"
SLASHED_DATE = r"\A\d{1,2}/\d{1,2}/\d{4}\z"
NUMBER = r"\A[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"
CLOCK = r"\A\d{1,2}:[0-5]\d(:[0-5]\d)?\z"
# Fixed value: day 25569 of a spreadsheet is 1970-01-01.
SERIAL_EPOCH = 25569
CELL_TYPES = ["num", "bool", "int", "date", "time", "str"]


def to_number(text):
    """A number from plain or scientific notation."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def convert_cell(cell, to):
    """One column to `num`, `bool`, `int`, `date`, `time` or `str`.

    A cell that does not convert becomes null. Integers truncate, booleans are
    true for any number but zero, times are a fraction of a day.
    """
    if to not in CELL_TYPES:
        raise ValueError(f"unknown cell type {to!r}")
    text = F.trim(F.col(cell) if isinstance(cell, str) else cell)
    number = to_number(text)
    if to == "str":
        return text
    if to == "num":
        return number
    if to == "int":
        return F.when((number > -2147483649.0) & (number < 2147483648.0), number.cast("int"))
    if to == "bool":
        word = F.when(F.lower(text) == "true", True).when(F.lower(text) == "false", False)
        return F.coalesce(word, number != 0)
    if to == "date":
        return to_date(text)
    part = [F.get(F.split(text, ":"), F.lit(i)).try_cast("int") for i in range(3)]
    seconds = part[0] * 3600 + part[1] * 60 + F.coalesce(part[2], F.lit(0))
    return F.when(text.rlike(CLOCK) & (seconds < 86400), seconds / F.lit(86400.0))


def to_date(text):
    """A date from an ISO date or time, from `month/day/year`, or from a spreadsheet day number."""
    serial = to_number(text)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(serial).cast("int") - SERIAL_EPOCH)
    return (
        F.when(text.rlike(ISO_DATE), text.try_cast("date"))
        .when(text.rlike(ISO_TIME), text.try_cast("timestamp_ntz").cast("date"))
        .when(text.rlike(SLASHED_DATE), F.try_to_timestamp(text, F.lit("M/d/yyyy")).cast("date"))
        .when((serial >= 0) & (serial < 2958466), day)
    )


def convert_columns(frame, types):
    """Convert string columns by a `{column: type}` mapping."""
    return frame.withColumns({c: convert_cell(c, to) for c, to in types.items()})


def conversion_errors(frame, types):
    """For each converted column, how many cells did not convert."""
    failed = [
        F.count_if(F.col(c).isNotNull() & convert_cell(c, to).isNull()).alias(c) for c, to in types.items()
    ]
    counts = frame.agg(*failed)
    return counts.unpivot([], list(types), "column", "errors")


def type_profile(frame, columns=None):
    """For each string column, the number of cells that read as each type."""
    columns = columns or [f.name for f in frame.schema if f.dataType.typeName() == "string"]
    cells = frame.select(*columns).unpivot([], columns, "column", "cell")
    text = F.trim("cell")
    kind = (
        F.when(text.isNull() | (text == ""), "nil")
        .when(to_number(text).isNotNull(), "num")
        .when(F.lower(text).isin("true", "false"), "bool")
        .when(to_date(text).isNotNull(), "date")
        .otherwise("str")
    )
    return cells.groupBy("column", kind.alias("type")).agg(F.count(F.lit(1)).alias("cells"))


def shape_profile(frame, key):
    """Rows, columns and cells of the array that each key holds."""
    key = _names(key)
    width = F.lit(len(frame.columns) - len(key)).cast("long")
    rows = F.count(F.lit(1))
    return frame.groupBy(*key).agg(rows.alias("n_rows"), width.alias("n_columns"), (rows * width).alias("n_cells"))


def match_wildcard(text, pattern):
    """Whether a whole text matches a pattern of `*`, `?` and `~` escapes, in any case."""
    text = F.col(text) if isinstance(text, str) else text
    return text.rlike(wildcard_regex(pattern))


def wildcard_regex(pattern):
    """The regular expression of a wildcard pattern."""
    parts, escaped = [], False
    for c in pattern:
        if escaped:
            parts.append(f"\\x{{{ord(c):x}}}")
        elif c in "*?":
            parts.append(".*" if c == "*" else ".")
        elif c != "~":
            parts.append(f"\\x{{{ord(c):x}}}")
        escaped = c == "~" and not escaped
    return "(?isu)^" + "".join(parts) + ("\\x{7e}" if escaped else "") + "\\z"


def lookup_first(frame, key, table, table_key, value, order, out=None):
    """For each row the value of the first entry in `table` with the same key.

    Keys match in any case, `order` ranks the entries, no match gives null.
    """
    folded = F.lower(F.col(table_key).cast("string"))
    first = table.groupBy(folded.alias("_lookup")).agg(F.min_by(value, F.struct(*_names(order))).alias(out or value))
    keyed = frame.withColumn("_lookup", F.lower(F.col(key).cast("string")))
    return keyed.join(first, "_lookup", "left").drop("_lookup")


def patch_source(base, patch, key):
    """Replace all rows of the keys in `patch` by the rows of `patch`."""
    keys = patch.select(*_names(key)).distinct()
    return base.join(keys, _names(key), "left_anti").unionByName(patch)
