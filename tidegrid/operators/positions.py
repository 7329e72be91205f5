"""Rows of long series by position, from a stored table that is read only where rows are asked for.

The table holds every row with its position in its series, in folders of so
many positions each, and beside it the length of each series. Asking for rows
turns positions into folders, so Spark's partition pruning leaves all others
unread, and nothing is sorted or numbered again.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.series import ONE_SERIES, join_on_key, position
from tidegrid.session import scratch_path, store

AT, FOLDER, LENGTH = "_at", "_segment", "_length"


class Indexed(NamedTuple):
    """A stored series: its rows by position, the length of each series, its key, and the positions of one folder."""

    rows: DataFrame
    lengths: DataFrame
    key: list
    size: int
    columns: list


def index(series, size=1_000_000, path=None):
    """Store a series by position, below `path` or in the shared folder."""
    spark = series.frame.sparkSession
    path = path or scratch_path(spark, "positions")
    placed = series.add(**{AT: position()}).rows()
    columns = placed.drop(AT).columns
    key = [k for k in series.key if k != ONE_SERIES]
    foldered = placed.withColumn(FOLDER, F.expr(f"{AT} div {size}"))
    # By ranges of folder, key and position, so that a long series is many files and a folder few.
    foldered.repartitionByRange(FOLDER, *key, AT).sortWithinPartitions(FOLDER, *key, AT).write.partitionBy(FOLDER).parquet(f"{path}/rows")
    kinds = foldered.select(*columns, AT, FOLDER).schema
    rows = spark.read.schema(kinds).parquet(f"{path}/rows")
    rows.groupBy(*key).agg(F.count(F.lit(1)).alias(LENGTH)).write.parquet(f"{path}/lengths")
    return Indexed(rows, spark.read.parquet(f"{path}/lengths"), key, size, columns)


def gather(indexed, wanted, at="position"):
    """The rows that a table of keys and 0-based positions asks for, with the other columns of that table.

    Negative positions count from the end. A position may be asked for more
    than once; one beyond the series gives no row, a null one neither.
    """
    others = [c for c in wanted.columns if c not in (*indexed.key, at)]
    clash = set(others) & set(indexed.columns)
    if clash:
        raise ValueError(f"columns of both tables: {sorted(clash)}")
    asked = join_on_key(wanted, indexed.lengths, indexed.key) if indexed.key else wanted.crossJoin(F.broadcast(indexed.lengths))
    place = F.when(F.col(at) < 0, F.col(LENGTH) + F.col(at)).otherwise(F.col(at))
    asked = asked.withColumn(AT, place.cast("long")).where((F.col(AT) >= 0) & (F.col(AT) < F.col(LENGTH)))
    asked = store(asked.select(*indexed.key, at, *others, AT, F.expr(f"{AT} div {indexed.size}").alias(FOLDER)), "asked")
    # As many numbers as there are folders, at most.
    folders = [r[0] for r in asked.select(FOLDER).distinct().collect()]
    renamed = asked.select(*[F.col(c).alias(f"_on_{c}") for c in (*indexed.key, AT, FOLDER)], F.col(at).alias("_asked"), *others)
    same = [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in indexed.key]
    same += [F.col(c) == F.col(f"_on_{c}") for c in (FOLDER, AT)]
    held = indexed.rows.where(F.col(FOLDER).isin(folders)).join(renamed, same)
    return held.select(*indexed.columns, F.col("_asked").alias(at), *others)


def take(indexed, count):
    """The first `count` rows of each series, or the last where it is negative."""
    return _part(indexed, count, True)


def drop(indexed, count):
    """All but the first `count` rows of each series, or all but the last where it is negative."""
    return _part(indexed, count, False)


def _part(indexed, count, keep):
    rows = indexed.rows
    if count >= 0:
        near = rows.where(F.col(FOLDER) <= (count - 1) // indexed.size) if keep else rows.where(F.col(FOLDER) >= count // indexed.size)
        return near.where(F.col(AT) < count if keep else F.col(AT) >= count).select(indexed.columns)
    # Folders before the end of the shortest series, or behind that of the longest, have nothing to give.
    ends = indexed.lengths.agg(F.min(LENGTH), F.max(LENGTH)).first()
    if ends[0] is None:
        return rows.select(indexed.columns)
    near = rows.where(F.col(FOLDER) >= max(ends[0] + count, 0) // indexed.size) if keep else rows.where(F.col(FOLDER) <= max(ends[1] + count - 1, -1) // indexed.size)
    long = join_on_key(near, indexed.lengths, indexed.key) if indexed.key else near.crossJoin(F.broadcast(indexed.lengths))
    inside = F.col(AT) >= F.col(LENGTH) + count
    return long.where(inside if keep else ~inside).select(indexed.columns)
