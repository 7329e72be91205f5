"""Comma separated text, one document per row.

Quoted parts are found by splitting at the quote character: every second piece
lies inside quotes. Separators in those pieces, and escaped characters
anywhere, are replaced by code points that Unicode reserves for internal use,
so that plain splits then give records and fields in time linear in the text.
"""

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegrid.operators.tables import to_date, to_number
from tidegrid.session import store
from tidegrid.sources import csvblocks as B
from tidegrid.sources.lines import BLOCK, block_lines, carried, file_sizes
from tidegrid.sources.snapshots import BOM, strip_bom

_RECORD, _FIELD, _QUOTE, _ESCAPE, _BROKEN = B.RECORD, B.FIELD, B.QUOTE, B.ESCAPE, B.BROKEN


def read_csv_files(spark, path, schema, rs="\n", fs=",", esc="\\", header=False):
    """CSV files by Spark's reader; rows that do not fit keep their text in `_corrupt`."""
    return (
        spark.read.schema(f"{schema}, _corrupt string")
        .options(sep=fs, escape=esc, quote='"', header=header, mode="PERMISSIVE")
        .options(columnNameOfCorruptRecord="_corrupt", multiLine=True, lineSep=rs)
        .csv(path)
    )


def _records(text, rs, fs, esc):
    """Text -> array of records (broken, fields).

    A quote that is never closed breaks its record, which then holds the rest
    of the text.
    """
    marks = {rs: _RECORD, fs: _FIELD, '"': _QUOTE}
    if esc:
        text = F.replace(text, F.lit(esc * 2), F.lit(_ESCAPE))
        for plain, mark in marks.items():
            text = F.replace(text, F.lit(esc + plain), F.lit(mark))
    pieces = F.split(text, '"')
    hidden = F.transform(
        pieces,
        lambda piece, i: F.when(
            i % 2 == 1,
            F.concat(
                F.when(i == F.size(pieces) - 1, _BROKEN).otherwise(""),
                F.replace(F.replace(piece, F.lit(rs), F.lit(_RECORD)), F.lit(fs), F.lit(_FIELD)),
            ),
        ).otherwise(piece),
    )
    lines = F.split(F.array_join(hidden, '"'), re.escape(rs))
    lines = F.transform(lines, lambda line: F.rtrim(line, F.lit("\r")) if rs == "\n" else line)
    lines = F.filter(lines, lambda line: line != "")

    def restore(field):
        bare = F.replace(F.regexp_replace(field, r'\A"|"\z', ""), F.lit('""'), F.lit('"'))
        for mark, plain in ((_RECORD, rs), (_FIELD, fs), (_QUOTE, '"'), (_ESCAPE, esc), (_BROKEN, "")):
            bare = F.replace(bare, F.lit(mark), F.lit(plain))
        return bare

    return F.transform(
        lines,
        lambda line: F.struct(
            line.contains(_BROKEN).alias("broken"), F.transform(F.split(line, re.escape(fs)), restore).alias("fields")
        ),
    )


def _rows(frame, body, rs, fs, esc):
    key = [c for c in frame.columns if c != body]
    parsed = frame.select(*key, _records(strip_bom(body), rs, fs, esc).alias("_all"))
    # Each record gets the width itself, so that no row carries its whole text.
    # The outer form, since Spark would parse a second time to filter out empty texts.
    width = F.size(F.get("_all", F.lit(0))["fields"]).alias("width")
    records = F.transform("_all", lambda r: F.struct(width, r["broken"].alias("broken"), r["fields"].alias("fields")))
    rows = parsed.select(*key, F.posexplode_outer(records).alias("row_no", "_record"))
    return rows.where(F.col("row_no").isNotNull()).select(
        *key, "_record.width", "_record.broken", "row_no", "_record.fields"
    )


def parse_csv(frame, body, columns=None, rs="\n", fs=",", esc="\\", offset=0, count=None, header=False):
    """Rows of CSV text, all fields strings, numbered from 0 within a document.

    The first record sets the width: shorter rows are padded with nulls, wider
    ones are left to `csv_quarantine`. `offset` rows are skipped and at most
    `count` returned per document; `header` skips the first record as names.
    Fields come as `fields`, or as one column each where `columns` names them.
    """
    rows = _rows(frame, body, rs, fs, esc).where((F.size("fields") <= F.col("width")) & ~F.col("broken"))
    first = offset + (1 if header else 0)
    rows = rows.where(F.col("row_no") >= first)
    if count is not None:
        rows = rows.where(F.col("row_no") < first + count)
    key = [c for c in frame.columns if c != body]
    if columns:
        return rows.select(*key, "row_no", *[F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(columns)])
    padding = F.array_repeat(F.lit(None).cast("string"), F.col("width") - F.size("fields"))
    return rows.select(*key, "row_no", F.concat("fields", padding).alias("fields"))


def csv_quarantine(frame, body, rs="\n", fs=",", esc="\\"):
    """The rows that have more fields than the first record of their document, and what follows a quote that is never closed."""
    rows = _rows(frame, body, rs, fs, esc).where((F.size("fields") > F.col("width")) | F.col("broken"))
    return rows.drop("broken").withColumn("n_fields", F.size("fields"))


def parse_csv_timeseries(frame, body, columns, rs="\n", fs=",", esc="\\"):
    """Rows that begin with a digit: a date, then numbers named by `columns`.

    Rows whose date cannot be read, or that have more fields, are left to
    `timeseries_quarantine`.
    """
    rows, held = _series_rows(frame, body, columns, rs, fs, esc)
    first = F.get("fields", F.lit(0))
    key = [c for c in frame.columns if c != body]
    return rows.where(~held).select(
        *key,
        "row_no",
        to_date(first).alias("date"),
        *[to_number(F.trim(F.get("fields", F.lit(i + 1)))).alias(c) for i, c in enumerate(columns)],
    )


def timeseries_quarantine(frame, body, columns, rs="\n", fs=",", esc="\\"):
    """The rows that begin with a digit but not with a date, have too many fields, or follow a quote that is never closed."""
    rows, held = _series_rows(frame, body, columns, rs, fs, esc)
    return rows.where(held).select(*[c for c in frame.columns if c != body], "row_no", "fields")


def _series_rows(frame, body, columns, rs, fs, esc):
    first = F.get("fields", F.lit(0))
    rows = _rows(frame, body, rs, fs, esc).where(first.rlike("^[0-9]") | F.col("broken"))
    return rows, F.col("broken") | to_date(first).isNull() | (F.size("fields") > len(columns) + 1)


def _marked(spark, path, rs, esc):
    """(path, block, line): the lines of files, with a mark in place of bytes that are no text, as Spark's split puts it there."""
    marked = F.when(F.is_valid_utf8("line"), F.col("line")).otherwise(F.get(F.split("line", "(?!)"), F.lit(0)))
    return block_lines(spark, path, rs).withColumn("line", marked)


def _file_blocks(spark, path, rs, esc, fs=","):
    """For each block of each file the state that it begins in and how many records begin before it.

    Each block is read under both states, inside of quotes or not, and what it
    changes in either is carried over the blocks. One row a block, stored, so
    that it is found once; `_id` numbers the blocks and holds their state.
    """
    blocks = block_lines(spark, path, rs).mapInArrow(B.summaries(rs, fs, esc), B.SUMMARY)
    order, whole = Window.partitionBy("path").orderBy("block"), Window.partitionBy("path")
    state = blocks.withColumns(
        {
            "_start": F.coalesce(F.sum("_change").over(carried(blocks)) % 2, F.lit(0)),
            "_before": F.coalesce(F.lag("_last").over(order), F.lit(0)),
        }
    )
    # A block that begins outside of quotes but behind an escape goes on with the record before.
    less = F.when((F.col("_start") == 0) & (F.col("_before") == 1), F.col("_first")).otherwise(0)
    begun = F.when(F.col("_start") == 0, F.col("_all_out") - less).otherwise(F.col("_all_in"))
    inside, left = F.col("_start") == 1, (F.col("_start") + F.col("_change")) % 2 == 1
    state = state.withColumn("_begun", begun).select(
        *BLOCK,
        inside.alias("_inside"),
        (F.col("_before") == 1).alias("_glued"),
        (inside | left | (F.col("_before") == 1) | (F.col("_last") == 1)).alias("_cut"),
        F.coalesce(F.sum("_begun").over(carried(blocks)), F.lit(0)).alias("_base"),
        F.when(F.sum("_change").over(whole) % 2 == 1, F.sum("_begun").over(whole) - 1).alias("_open_no"),
        (F.col("block") == F.max("block").over(whole)).alias("_end"),
        F.sum("_bytes").over(whole).alias("_bytes"),
        F.max("_width").over(whole).cast("int").alias("_width"),
    )
    # Lines do not tell whether a separator ends the file; its size does, with or without a byte order mark.
    ended = F.col("_end") & (F.col("file_size") - F.col("_bytes")).isin(0, 3)
    bits = ((B.INSIDE, F.col("_inside")), (B.GLUED, F.col("_glued")), (B.ENDED, ended), (B.FIRST, F.col("block") == 0))
    known = state.join(file_sizes(spark, path), "path").select(
        (F.monotonically_increasing_id() * B.STATES + sum(F.when(holds, bit).otherwise(0) for bit, holds in bits)).alias("_id"),
        *BLOCK,
        "_base",
        "_open_no",
        "_cut",
        "_width",
    )
    return store(known, "blocks")


def _of_blocks(lines, blocks):
    """Marked lines with what their block has to know; these are few, and the lines stay in their order."""
    known = F.broadcast(blocks.select(*BLOCK, "_id", "_base", "_open_no"))
    return lines.join(known, BLOCK).drop(*BLOCK)


def _file_records(lines, blocks, rs, fs=",", esc="\\"):
    """(_id, row_no, parts, fields): the records of marked lines that begin and end in one block, each of one line or more.

    A task puts them together by itself; no line is shuffled.
    """
    return _of_blocks(lines, blocks).mapInArrow(B.whole_records(rs, fs, esc), "_id long, row_no long, parts long, fields array<string>")


def _cut_records(lines, blocks, rs, esc):
    """(path, row_no, parts, broken, text): the records that lie in several blocks, or are left open at the end of a file.

    Each block holds at most two of them. A quote that is never closed leaves
    the first line of its record, as broken, and the number of its lines.
    """
    held = _of_blocks(lines, blocks.where("_cut"))
    pieces = held.mapInArrow(B.cut_records(rs, esc), "_id long, row_no long, parts long, begun boolean, broken boolean, text string")
    pieces = pieces.join(blocks.select("_id", *BLOCK), "_id")
    ordered = F.sort_array(F.collect_list(F.when(~F.col("broken"), F.struct("block", "text"))))
    joined = pieces.groupBy("path", "row_no", "broken").agg(
        F.sum("parts").alias("parts"),
        F.array_join(F.transform(ordered, lambda p: p["text"]), rs).alias("_whole"),
        F.max(F.when(F.col("begun"), F.col("text"))).alias("_first"),
    )
    text = F.when(F.col("broken"), F.col("_first")).otherwise(F.col("_whole"))
    return joined.select("path", "row_no", "parts", "broken", text.alias("text"))


def _file_rows(spark, path, rs, fs, esc):
    """The records of files with their fields and the width of their file."""
    lines, blocks = _marked(spark, path, rs, esc), _file_blocks(spark, path, rs, esc, fs)
    records, width = _file_records(lines, blocks, rs, fs, esc), F.size("fields").alias("width")
    widths = blocks.where("block = 0 AND _width IS NOT NULL").select("path", F.col("_width").alias("width"))
    # A file may begin with blocks of empty lines.
    late = blocks.where("block > 0 AND _base = 0")
    if not late.isEmpty():
        found = _file_records(lines, late, rs, fs, esc).where("row_no = 0").join(late.select("_id", "path"), "_id")
        widths = widths.unionByName(found.select("path", width))
    cut = None
    if not blocks.where("_cut").isEmpty():
        cut = store(_cut_records(lines, blocks, rs, esc), "cut").mapInArrow(
            B.with_fields(rs, fs, esc), "path string, row_no long, parts long, broken boolean, fields array<string>"
        )
        widths = widths.unionByName(cut.where("row_no = 0").select("path", width))
    widths = store(widths, "widths")
    known = F.broadcast(blocks.select("_id", "path").join(widths, "path"))
    columns = ["path", "row_no", "parts", "broken", "fields", "width"]
    rows = records.withColumn("broken", F.lit(False)).join(known, "_id").select(*columns)
    return rows if cut is None else rows.unionByName(cut.join(widths, "path").select(*columns))


def parse_csv_files(spark, path, columns=None, rs="\n", fs=",", esc="\\", offset=0, count=None, header=False):
    """Rows of CSV files, as `parse_csv` gives them of texts, with `path` in front; a large file is read by many tasks."""
    rows = _file_rows(spark, path, rs, fs, esc).where((F.size("fields") <= F.col("width")) & ~F.col("broken"))
    first = offset + (1 if header else 0)
    rows = rows.where(F.col("row_no") >= first)
    if count is not None:
        rows = rows.where(F.col("row_no") < first + count)
    if columns:
        return rows.select("path", "row_no", *[F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(columns)])
    padding = F.array_repeat(F.lit(None).cast("string"), F.col("width") - F.size("fields"))
    return rows.select("path", "row_no", F.concat("fields", padding).alias("fields"))


def csv_files_quarantine(spark, path, rs="\n", fs=",", esc="\\"):
    """The rows of CSV files that have more fields than the first one of their file, and what follows a quote that is never closed.

    Of the latter only the first line is shown, and how many lines there are.
    """
    rows = _file_rows(spark, path, rs, fs, esc).where((F.size("fields") > F.col("width")) | F.col("broken"))
    return rows.select("path", "row_no", F.col("parts").alias("lines"), "broken", "fields", F.size("fields").alias("n_fields"))
