"""Records and fields of CSV files in Arrow batches, for tasks that read blocks of lines in their order.

A task puts the lines of its blocks together and splits them itself, by the
steps of `csvtext._records`, so that only what a record holds of a second block
is brought together by Spark.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidegrid.sources.lines import BLOCK, parts_of
from tidegrid.sources.snapshots import BOM

# Noncharacters: never part of interchanged text.
RECORD, FIELD, QUOTE, ESCAPE, BROKEN = "\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3", "\ufdd4"
# The bytes that all of them begin with.
_MARK = RECORD.encode()[:2]

# What a block has to know of its file, as the last bits of its number: whether it begins inside of quotes, or behind an
# escape, whether it ends the file, with a separator, and whether it begins the file.
INSIDE, GLUED, ENDED, FIRST, STATES = 1, 2, 4, 8, 16


def _flags(lines, rs, esc):
    """What each line changes: whether it has an odd number of quotes, ends with an escape, and holds anything."""
    plain = bare = lines
    escaped = bool(esc) and pc.any(_has(lines, esc.encode())).as_py()
    if escaped:
        plain = pc.replace_substring(lines, esc * 2, ESCAPE)
        bare = pc.replace_substring(plain, esc + '"', QUOTE)
    quotes = pc.count_substring(bare, '"').to_numpy() & 1
    ends = pc.ends_with(plain, esc).to_numpy(zero_copy_only=False) if escaped else np.zeros(len(lines), bool)
    trimmed = _trimmed(lines, rs)
    empty = pc.or_(pc.equal(trimmed, ""), pc.equal(trimmed, BOM))
    return quotes, ends, ~empty.to_numpy(zero_copy_only=False)


def _listed(cuts, values):
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values)


class _Block:
    """The portions of records in one block, whose lines come piece by piece.

    A portion is what a block holds of one record: all of it, or what goes on
    from the block before, or what goes on into the next. Of the record that a
    quote which is never closed leaves open, numbered `open_no`, no more than
    the first line is held.
    """

    def __init__(self, state, base, open_no, rs, esc):
        self.state, self.open_no, self.rs, self.esc = state, open_no, rs, esc
        self.odd, self.glued = state & INSIDE, bool(state & GLUED)
        self.bare = bool(state & FIRST)
        # The portion that lines are added to: its record, whether that began here, and with an empty line.
        self.no, self.begun, self.filled = base - 1, False, True
        self.held, self.count = [], 0

    def _hold(self, lines):
        if self.no != self.open_no:
            self.held.append(lines)
        elif self.begun and not self.count:
            self.held.append(lines[:1])
        self.count += len(lines)

    def _texts(self, lines, cuts):
        """The lines between each two cuts as one text."""
        if cuts[-1] - cuts[0] == len(cuts) - 1:
            texts = lines[int(cuts[0]) : int(cuts[-1])]
        else:
            texts = pc.binary_join(_listed(cuts, lines), self.rs)
        if self.bare:
            first = texts[:1].view(pa.binary())[0].as_py().removeprefix(BOM.encode())
            texts = pa.concat_arrays([pa.array([first]).view(texts.type), texts[1:]])
        return texts

    def add(self, lines, whole):
        """(row_no, parts, begun, text) of the portions that end within these lines: the `whole` records, or else the others."""
        quotes, ends, full = _flags(lines, self.rs, self.esc)
        after = (self.odd + np.cumsum(quotes, dtype=np.int64)) & 1
        begins = np.empty(len(after), bool)
        begins[0] = not (self.odd or self.glued)
        np.logical_not(after[:-1] | ends[:-1], out=begins[1:])
        self.odd, self.glued = int(after[-1]), bool(ends[-1])
        cuts = np.flatnonzero(begins)
        if not len(cuts):
            self._hold(lines)
            return None
        filled = full[cuts]
        numbers = self.no + np.cumsum(filled)
        begun = np.ones(len(cuts), bool)
        if self.count or cuts[0]:
            # What is held goes on up to the first beginning.
            lines = pa.concat_arrays([*self.held, lines])
            cuts = np.concatenate([[0], cuts + self.count])
            filled, begun = np.concatenate([[self.filled], filled]), np.concatenate([[self.begun], begun])
            numbers = np.concatenate([[self.no], numbers])
        kept = np.flatnonzero(filled[:-1] & begun[:-1] if whole else ~begun[:-1])
        found = None
        if len(kept):
            texts = self._texts(lines, cuts[: kept[-1] + 2])
            texts = texts if len(texts) == len(kept) else texts.take(pa.array(kept))
            found = numbers[kept], np.diff(cuts)[kept], begun[kept], texts
        self.bare = self.bare and len(cuts) == 1
        self.no, self.begun, self.filled = int(numbers[-1]), True, bool(filled[-1])
        self.held, self.count = [], 0
        self._hold(lines[int(cuts[-1]) :])
        return found

    def close(self, whole):
        """The portion that the block ends with, and whether its record is the open one."""
        broken = self.no == self.open_no
        done = self.begun and not (broken or self.odd or self.glued)
        if not self.count or not self.filled or done != whole:
            return None
        text = pa.nulls(1, pa.string())
        if self.held:
            lines = pa.concat_arrays(self.held)
            text = self._texts(lines, np.array([0, len(lines)]))
            # An escape before the separator that ends a file keeps it.
            if self.glued and self.state & ENDED and len(lines) == self.count:
                text = pc.binary_join_element_wise(text, self.rs, "")
        return np.array([self.no]), np.array([self.count]), np.array([self.begun]), text, np.array([broken])


def _portions(batches, rs, esc, whole):
    """(block, row_no, parts, begun, text, broken) of blocks whose columns are `_id`, `_base`, `_open_no` and `line`."""
    here, block = None, None
    for batch in batches:
        for part in parts_of(batch, "_id"):
            place, *known = [part.column(c)[0].as_py() for c in ("_id", "_base", "_open_no")]
            if place != here:
                last = block and block.close(whole)
                if last:
                    yield here, *last
                here, block = place, _Block(place % STATES, *known, rs, esc)
            found = block.add(part.column("line"), whole)
            if found:
                yield here, *found, np.zeros(len(found[0]), bool)
    last = block and block.close(whole)
    if last:
        yield here, *last


def whole_records(rs, fs, esc):
    """A function of batches: (_id, row_no, parts, fields) of the records that begin and end in one block."""

    def each(batches):
        for here, numbers, parts, _, texts, _ in _portions(batches, rs, esc, True):
            order, fields = fields_of(texts, rs, fs, esc)
            columns = [pa.array(c if order is None else c[order]) for c in (np.full(len(numbers), here), numbers, parts)]
            yield pa.RecordBatch.from_arrays([*columns, fields], names=["_id", "row_no", "parts", "fields"])

    return each


def cut_records(rs, esc):
    """A function of batches: (_id, row_no, parts, begun, broken, text), what blocks hold of records that lie in several, or are never closed."""

    def each(batches):
        for here, numbers, parts, begun, texts, broken in _portions(batches, rs, esc, False):
            columns = [pa.array(c) for c in (np.full(len(numbers), here), numbers, parts, begun, broken)]
            yield pa.RecordBatch.from_arrays([*columns, texts], names=["_id", "row_no", "parts", "begun", "broken", "text"])

    return each


def with_fields(rs, fs, esc):
    """A function of batches that puts the fields of the column `text` in its place."""

    def each(batches):
        for batch in batches:
            order, fields = fields_of(batch.column("text"), rs, fs, esc)
            batch = batch if order is None else batch.take(pa.array(order))
            place = batch.schema.get_field_index("text")
            columns, names = [*batch.columns], [*batch.schema.names]
            columns[place], names[place] = fields, "fields"
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return each


_SUMMED = ["block", "_change", "_last", "_all_out", "_all_in", "_first", "_bytes", "_width"]
SUMMARY = ", ".join(["path string", *[f"{name} long" for name in _SUMMED]])


def summaries(rs, fs, esc):
    """A function of batches: one row for each block, with what its lines change, whatever state it begins in.

    `_change` is whether its number of quotes is odd, `_last` whether its last
    line ends with an escape, `_all_out` and `_all_in` are how many records
    begin in it if it begins outside of quotes, or inside, `_first` is whether
    its first line holds anything. `_width` is the number of fields of the first
    record of a file, if that ends in this block.
    """

    schema = pa.schema([("path", pa.string()), *[(name, pa.int64()) for name in _SUMMED]])

    def each(batches):
        here, row, block = None, None, None

        def close():
            if block:
                row["_width"] = _first_width(block.close(True), rs, fs, esc)
            return row

        for batch in batches:
            rows = []
            for part in parts_of(batch, *BLOCK):
                place = [part.column(c)[0].as_py() for c in BLOCK]
                lines = part.column("line")
                quotes, ends, full = _flags(lines, rs, esc)
                if place != here:
                    if row:
                        rows.append(close())
                    here, row = place, dict.fromkeys(_SUMMED, 0) | dict(zip(BLOCK, place)) | {"_first": int(full[0]), "_width": None}
                    block = None if place[1] else _Block(FIRST, 0, None, rs, esc)
                after = (row["_change"] + np.cumsum(quotes, dtype=np.int64)) & 1
                before = np.concatenate([[row["_change"]], after[:-1]])
                filled = full & (np.concatenate([[row["_last"]], ends[:-1]]) == 0)
                row["_all_in"] += int(before[filled].sum())
                row["_all_out"] += int(filled.sum() - before[filled].sum())
                row["_change"], row["_last"] = int(after[-1]), int(ends[-1])
                row["_bytes"] += pc.sum(pc.binary_length(lines)).as_py() + len(lines) * len(rs.encode())
                if block:
                    row["_width"] = _first_width(block.add(lines, True), rs, fs, esc)
                    block = block if row["_width"] is None else None
            yield pa.RecordBatch.from_pylist(rows, schema)
        yield pa.RecordBatch.from_pylist([close()] if row else [], schema)

    return each


def _first_width(found, rs, fs, esc):
    if not found:
        return None
    # These lines may still hold bytes that are no text.
    text = found[3][:1].view(pa.binary())[0].as_py().decode(errors="replace")
    return len(fields_of(pa.array([text]), rs, fs, esc)[1][0])


def _has(texts, pattern):
    return pc.match_substring(texts.view(pa.binary()), pattern)


def _trimmed(lines, rs):
    ended = rs == "\n" and pc.any(pc.ends_with(lines, "\r")).as_py()
    return pc.ascii_rtrim(lines, characters="\r") if ended else lines


def _split_quoted(texts, rs, fs, esc):
    """Fields of records with quotes or escapes, by the steps of `csvtext._records`."""
    replace = pc.replace_substring
    if esc:
        texts = replace(texts, esc * 2, ESCAPE)
        for plain, mark in {rs: RECORD, fs: FIELD, '"': QUOTE}.items():
            texts = replace(texts, esc + plain, mark)
    pieces = pc.split_pattern(texts, '"')
    cuts, values = pieces.offsets.to_numpy(), pieces.values
    inside = (np.arange(len(values)) - np.repeat(cuts[:-1], np.diff(cuts))) % 2 == 1
    values = pc.if_else(pa.array(inside), replace(replace(values, rs, RECORD), fs, FIELD), values)
    last = np.zeros(len(values), bool)
    last[cuts[1:] - 1] = True
    if (inside & last).any():
        values = pc.if_else(pa.array(inside & last), pc.binary_join_element_wise(BROKEN, values, ""), values)
    lines = _trimmed(pc.binary_join(_listed(cuts, values), '"'), rs)
    if pc.any(_has(lines, rs.encode())).as_py():
        filled = [[v for v in _trimmed(pc.list_flatten(row), rs).to_pylist() if v] for row in _each(pc.split_pattern(lines, rs))]
        lines = pa.array([row[0] if row else None for row in filled], lines.type)
    fields = pc.split_pattern(lines, fs)
    bare = fields.values
    for side, low, high in ((pc.starts_with, 1, None), (pc.ends_with, 0, -1)):
        bare = pc.if_else(side(bare, '"'), pc.utf8_slice_codeunits(bare, low, high), bare)
    bare = replace(bare, '""', '"')
    for mark, plain in ((RECORD, rs), (FIELD, fs), (QUOTE, '"'), (ESCAPE, esc), (BROKEN, "")):
        bare = replace(bare, mark, plain)
    return pa.ListArray.from_arrays(fields.offsets, bare, mask=fields.is_null() if fields.null_count else None)


def _each(lists):
    return (lists[i : i + 1] for i in range(len(lists)))


def fields_of(texts, rs, fs, esc):
    """The fields of records, and the order that they come in, if not that of the texts: a plain split tells most, and comes first."""
    odd = np.zeros(len(texts), bool)
    for pattern in filter(None, (b'"', esc.encode(), _MARK)):
        odd |= _has(texts, pattern).to_numpy(zero_copy_only=False)
    plain, other = np.flatnonzero(~odd), np.flatnonzero(odd)
    if not len(other):
        return None, pc.split_pattern(_trimmed(texts, rs), fs)
    if not len(plain):
        return None, _split_quoted(texts, rs, fs, esc)
    split = pc.split_pattern(_trimmed(texts.take(pa.array(plain)), rs), fs)
    return np.concatenate([plain, other]), pa.concat_arrays([split, _split_quoted(texts.take(pa.array(other)), rs, fs, esc)])
