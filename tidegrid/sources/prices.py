"""Directories of daily price files and of their results."""

import os
import re
import shutil
import uuid
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tidegrid.session import local_folder

# The header of a price file and the types of its fields.
HEADER = ["Date", "Open", "High", "Low", "Close", "Adj Close", "Volume"]
COLUMNS = {
    "date": "date",
    "open": "double",
    "high": "double",
    "low": "double",
    "close": "double",
    "adj_close": "double",
    "volume": "long",
}
# What Spark writes as `%` and two digits in the name of a folder, and the folder of rows without a value.
UNSAFE, NO_VALUE = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]"""), "__HIVE_DEFAULT_PARTITION__"
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _files(spark, path, partitioned):
    """One row per file with its lines; daily bars of one symbol are short files.

    Spark's own discovery of folders `symbol=...` takes time that grows with the
    square of their number, so the symbol is taken from the path.
    """
    file = F.col("_metadata.file_path")
    before = spark.conf.get(LISTING)
    # A few tasks a core; by default Spark starts one for each folder, up to 10,000.
    spark.conf.set(LISTING, min(int(before), 4 * spark.sparkContext.defaultParallelism))
    try:
        texts = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    finally:
        spark.conf.set(LISTING, before)
    if partitioned:
        # Decoded as a part of the path, and then as the name of a folder.
        name = _decoded(F.regexp_extract(file, "(?i)^.*/symbol=([^/]*)/", 1))
        symbol = F.when(~name.isin("", NO_VALUE), F.coalesce(_decoded(name, F.try_url_decode), name))
    else:
        symbol = _decoded(F.regexp_extract(file, r"([^/]+)\.csv$", 1))
    return texts.select(file.alias("file"), F.split("value", "\r?\n").alias("lines"), symbol.alias("symbol"))


def _decoded(name, decode=F.url_decode):
    return decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _has_header():
    return F.rtrim(F.get("lines", F.lit(0))) == ",".join(HEADER)


def _rows(spark, path, partitioned):
    """The lines below the header of the files that have one, split and read."""
    files = _files(spark, path, partitioned).where(_has_header())
    below = F.slice("lines", F.lit(2), F.greatest(F.size("lines") - 1, F.lit(0)))
    rows = files.select("file", "symbol", F.posexplode(below).alias("at", "line"))
    rows = rows.where(F.trim("line") != "").withColumn("cells", F.split(F.rtrim("line"), ","))
    values = {c: F.get("cells", F.lit(i)).try_cast(t) for i, (c, t) in enumerate(COLUMNS.items())}
    # Only the text `null` is a missing value.
    read = [(F.get("cells", F.lit(i)) == "null") | v.isNotNull() for i, v in enumerate(values.values())]
    good = reduce(lambda a, b: a & b, read, F.size("cells") == len(COLUMNS))
    return rows.withColumn("good", F.coalesce(good, F.lit(False))), values


def read_prices(spark, path, partitioned=False):
    """All price files below a folder as bars with their `symbol`, in one pass.

    The symbol is the file name, or the folder `symbol=...` where `partitioned`.
    A file counts only if its first line is the exact header; the others are
    listed by `rejected_price_files`. The text `null` marks a missing value; a
    line with any other cell that cannot be read, or with too few or too many,
    is left to `price_quarantine`.
    """
    rows, values = _rows(spark, path, partitioned)
    return rows.where("good").select("symbol", *[v.alias(c) for c, v in values.items()])


def price_quarantine(spark, path, partitioned=False):
    """The lines of accepted files that cannot be read: file, symbol, line number from 1, and text."""
    rows, _ = _rows(spark, path, partitioned)
    return rows.where("NOT good").select("file", "symbol", (F.col("at") + 2).alias("line_no"), "line")


def rejected_price_files(spark, path, partitioned=False):
    """The price files whose first line is not the header; Spark's readers pass over empty files, which have no line."""
    return _files(spark, path, partitioned).where(~F.coalesce(_has_header(), F.lit(False))).select("file", "symbol")


def write_prices(bars, path):
    """Write bars as price files, in folders `symbol=...`."""
    named = bars.select("symbol", *[F.col(c).alias(h) for c, h in zip(COLUMNS, HEADER)])
    # Ranges keep a small symbol in one file and spread a long one over several.
    ordered = named.repartitionByRange("symbol", "Date").sortWithinPartitions("symbol", "Date")
    folder = _new_folder(bars.sparkSession, path)
    if folder:
        line = F.to_csv(F.struct(*[f"`{h}`" for h in HEADER]), {"nullValue": "null"})
        _write_by_tasks(ordered.select("symbol", line.alias("value")), folder, ",".join(HEADER))
    else:
        ordered.write.partitionBy("symbol").option("header", True).option("nullValue", "null").csv(path)


def write_lines(ordered, path):
    """Write `symbol, value` as lines of text, in folders `symbol=...`; each task has its rows in the order of symbols."""
    folder = _new_folder(ordered.sparkSession, path)
    if folder:
        _write_by_tasks(ordered.select("symbol", "value"), folder)
    else:
        ordered.write.partitionBy("symbol").text(path)


def _new_folder(spark, path):
    """The folder of a new path on the plain file system; None elsewhere, and for a path that exists, which Spark's writer refuses."""
    folder = local_folder(spark, path)
    return None if folder is None or os.path.lexists(folder) else folder


def _write_by_tasks(ordered, folder, head=None):
    """Write lines of text as Spark's writer does, a file for each symbol of a task, without a process for each file.

    On the plain file system Spark's writer starts two for each file, to set its
    rights and those of its checksums, which takes nearly all of the time where
    files are many and short. As with Spark's writer, each attempt of a task has
    a folder of its own, and only those of attempts that succeeded are moved to
    their place.
    """
    waiting = os.path.join(folder, f"_waiting-{uuid.uuid4().hex}")
    os.makedirs(waiting)
    first = head.encode() + b"\n" if head else b""

    def write(batches):
        attempt = uuid.uuid4().hex
        mine = os.path.join(waiting, attempt)
        os.mkdir(mine)
        current, file = None, None
        try:
            for batch in batches:
                values, start = batch.column("value").to_pylist(), 0
                runs = pc.run_end_encode(batch.column("symbol"))
                for symbol, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                    name = "symbol=" + (UNSAFE.sub(lambda c: f"%{ord(c[0]):02X}", symbol) if symbol else NO_VALUE)
                    if name != current:
                        if file:
                            file.close()
                        os.mkdir(os.path.join(mine, name))
                        current, file = name, open(os.path.join(mine, name, f"part-{attempt}.txt"), "xb")
                        file.write(first)
                    file.write(b"\n".join(values[start:end]) + b"\n")
                    start = end
        finally:
            if file:
                file.close()
        yield pa.record_batch({"attempt": [attempt]})

    try:
        lines = ordered.select("symbol", F.coalesce(F.col("value"), F.lit("")).cast("binary").alias("value"))
        for row in lines.mapInArrow(write, "attempt string").collect():
            mine = os.path.join(waiting, row.attempt)
            for name in os.listdir(mine):
                _move(os.path.join(mine, name), os.path.join(folder, name))
    finally:
        shutil.rmtree(waiting, ignore_errors=True)
    open(os.path.join(folder, "_SUCCESS"), "xb").close()


def _move(found, place):
    """Move a symbol's folder to its place, or its files, where another task has the symbol too."""
    if not os.path.isdir(place):
        os.rename(found, place)
        return
    for file in os.listdir(found):
        os.rename(os.path.join(found, file), os.path.join(place, file))


def write_series(cumulative, path, file_format="parquet", per_symbol=False):
    """Write `date, cum_intraday, cum_overnight` by symbol.

    Rows are stored in ranges of symbol and date, so that a reader of one symbol
    skips most files. `per_symbol` makes a folder for each symbol, which suits
    a limited number of symbols only.
    """
    rows = cumulative.select("symbol", "date", "cum_intraday", "cum_overnight")
    ordered = rows.repartitionByRange("symbol", "date").sortWithinPartitions("symbol", "date")
    writer = ordered.write.partitionBy("symbol") if per_symbol else ordered.write
    writer.format(file_format).option("header", True).save(path)


def read_series(spark, path, file_format="parquet"):
    """Read back what `write_series` wrote, in either layout."""
    schema = "symbol string, date date, cum_intraday double, cum_overnight double"
    return spark.read.schema(schema).format(file_format).option("header", True).load(path)
