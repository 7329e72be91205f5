"""Slices and lines of texts."""

from pyspark.sql import functions as F

from tidegrid.sources.snapshots import strip_bom


def view_slice(text, offset=0, count=None):
    """`count` characters from `offset`, all by default, after a byte order mark.

    Where `count` is a string the text ends before its first occurrence, or
    before its last one if the offset is negative; the offset then is not a cut.
    """
    text = strip_bom(text)
    if isinstance(count, str):
        if offset < 0:
            kept = F.length(text) - F.length(F.substring_index(text, count, -1)) - len(count)
            return F.when(text.contains(count), F.substr(text, F.lit(1), kept)).otherwise(text)
        return F.substring_index(F.substr(text, F.lit(offset + 1)), count, 1)
    if offset < 0:
        raise ValueError("a negative offset needs a text to end at")
    if count is None:
        return F.substr(text, F.lit(offset + 1))
    return F.substr(text, F.lit(offset + 1), F.lit(max(count, 0)))


def view_len(text):
    """The number of characters."""
    return F.length(text).cast("long")


def view_bytes(text):
    """The number of bytes in UTF-8."""
    return F.octet_length(text).cast("long")


def view_drop(text, count):
    """Text without its first `count` characters, or without its last where negative."""
    text = F.col(text) if isinstance(text, str) else text
    if count >= 0:
        return F.substr(text, F.lit(count + 1))
    return F.substr(text, F.lit(1), F.greatest(F.length(text) + count, F.lit(0)))


def broken(line, width):
    """A line in parts of at most `width` characters, broken at the last space that fits, or at the width where there is none."""
    pattern = rf"[^\n]{{1,{width}}}(?: |\z)|[^\n]{{1,{width}}}"
    parts = F.regexp_extract_all(line, F.lit(pattern), F.lit(0))
    return F.when(F.length(line) <= width, F.array(line)).otherwise(F.transform(parts, lambda part: F.regexp_replace(part, r" \z", "")))


def split_lines(frame, text, width=None, out="line"):
    """One row per line of each text, numbered from 0.

    With a `width`, longer lines are broken at the last space that fits, or at
    the width where there is none.
    """
    lines = F.split(strip_bom(text), "\n")
    lines = F.when(F.element_at(lines, -1) == "", F.slice(lines, F.lit(1), F.size(lines) - 1)).otherwise(lines)
    if width:
        lines = F.flatten(F.transform(lines, lambda line: broken(line, width)))
    others = [c for c in frame.columns if c != text]
    return frame.select(*others, F.posexplode(lines).alias("line_no", out))
