"""Lines of large files, in order, each file read by many tasks.

Spark's text reader cuts a file into blocks of bytes and hands the lines that
begin in a block to one task, in their order. Counts inside a block need
nothing but that order, so a task runs over its lines once, in Arrow batches,
and no line is shuffled for it. What a block adds is one row; a running sum
over the blocks of a file, of which there are far fewer than lines, carries
counts and states from block to block.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegrid.session import store
from tidegrid.sources.snapshots import strip_bom

BLOCK = ["path", "block"]


def block_lines(spark, path, sep="\n"):
    """(path, block, line): the lines of files, with the place where their block begins."""
    rows = spark.read.option("lineSep", sep).text(path)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def file_sizes(spark, path):
    """(path, file_size): the bytes of each file, from the listing."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.col("length").alias("file_size"))


def parts_of(batch, *keys):
    """The pieces of an Arrow batch that are each of one block; the rows of a block come one after the other."""
    columns = [batch.column(key) for key in keys]
    # A batch seldom holds more than one block.
    if not batch.num_rows or all(c[0] == c[-1] for c in columns):
        return [batch] if batch.num_rows else []
    changed = np.zeros(batch.num_rows - 1, bool)
    for column in columns:
        codes = column.dictionary_encode().indices.to_numpy()
        changed |= codes[1:] != codes[:-1]
    ends = [*(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
    return [batch.slice(low, high - low) for low, high in zip([0, *ends], ends)]


def in_turn(frame, counted, run):
    """Add columns that depend on the rows of a block before: `run` gets the Arrow columns of one piece of a block and its state, None at first.

    `counted` names the columns to add, all long. `run` returns their values
    and the state for the next piece.
    """
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema], *[f"{c} long" for c in counted]])

    def each(batches):
        place, state = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            added = []
            for part in parts_of(batch, *BLOCK):
                here = [part.column(c)[0].as_py() for c in BLOCK]
                state = state if here == place else None
                values, state = run(part, state)
                place = here
                added.append(values)
            columns = [pa.array(np.concatenate(column), pa.int64()) for column in zip(*added)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *counted])

    return frame.mapInArrow(each, schema)


def carried(blocks):
    """The window of the blocks of a file that come before one."""
    return Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def _place(batch, state):
    first = state or 0
    return [np.arange(first, first + batch.num_rows)], first + batch.num_rows


def read_lines(spark, path, width=None, sep="\n"):
    """(path, line_no, line): one row per line of each file, numbered from 0, without a leading byte order mark.

    A file of any size is read by as many tasks as it has blocks. With a
    `width`, longer lines are broken as `split_lines` breaks them, and numbers
    count what they are broken into; a single line is one row of one task.
    """
    lines = block_lines(spark, path, sep)
    first = (F.col("block") == 0) & (F.col("_at") == 0)
    numbered = in_turn(lines, ["_at"], _place)
    numbered = numbered.withColumn("line", F.when(first, strip_bom("line")).otherwise(F.col("line")))
    if width:
        from tidegrid.functions.text import broken

        numbered = numbered.select(*BLOCK, "_at", F.posexplode(broken(F.col("line"), width)).alias("_part", "line"))
        parts = numbered.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("_n"))
        numbered = in_turn(numbered.drop("_at", "_part"), ["_at"], _place)
    else:
        parts = lines.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    # Stored, its size is known before the join, so that lines stay where they are.
    bases = store(parts.select(*BLOCK, F.coalesce(F.sum("_n").over(carried(parts)), F.lit(0)).alias("_base")), "blocks")
    return numbered.join(bases, BLOCK).select("path", (F.col("_base") + F.col("_at")).alias("line_no"), "line")
