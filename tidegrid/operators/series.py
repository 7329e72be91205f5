"""Ordered, keyed series.

A series is the set of rows of one key, read in a total order. Running values
need the rows of a key one after another, so a plain window would put a whole
key on one task. `Series` keeps that plan while the table is small enough for
one task, and beyond that cuts long keys into segments:

1. A sample of (key, order) picks cut points, only for keys longer than a
   segment. There are at most `MAX_CUTS` of them, whatever the size of the data.
2. Every row of such a key gets the number of its segment; one shuffle on
   (key, segment) serves all windows that follow.
3. A window runs inside each segment. One total per segment (at most
   2 * MAX_CUTS rows, broadcast) carries the value over from earlier segments.

Any cut points give the same result; the sample only balances the work.
"""

from collections.abc import Callable
from dataclasses import dataclass, replace
from math import ceil
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.operators import exact
from tidegrid.session import store

SEGMENT_ROWS = 4_000_000
MAX_CUTS = 65_536
SAMPLES_PER_CUT = 16
# Spark applies a row number limit before the shuffle too, up to this many rows.
TAKE_AHEAD = 1000
# Numbers that one row makes at a time.
SEQUENCE_BLOCK = 65_536

SEGMENT = "_segment"
ONE_SERIES = "_series"
HELPERS = (SEGMENT, ONE_SERIES)


@dataclass(frozen=True)
class Running:
    """A running value: inside a segment, its total, and how totals carry over.

    A `backwards` one reads the series from its end.
    """

    local: Callable
    total: Callable
    carry: Callable
    combine: Callable
    backwards: bool = False
    needs_first: bool = False
    # The column and the kind of a sum, which over doubles is worked out exactly.
    summed: tuple | None = None


def running_sum(value, exclusive=False):
    """Sum of the rows up to this one, or of the rows before it.

    Sums of doubles are exact until they are rounded once, so they have the same
    bits wherever a series is cut and in whatever order its parts are added.
    """
    value = _column(value)
    last = -1 if exclusive else 0
    return Running(
        summed=(value, exclusive),
        local=lambda w, order: F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, last)),
        total=lambda order: F.sum(value),
        carry=lambda total, w: F.sum(total).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        combine=lambda local, carry, first: F.coalesce(local + carry, local, carry),
    )


def running_product(value):
    """Product of the rows up to this one; nulls are left out."""
    value = _column(value)
    return Running(
        local=lambda w, order: F.product(value).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        total=lambda order: F.product(value),
        carry=lambda total, w: F.product(total).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        combine=lambda local, carry, first: F.coalesce(local * carry, local, carry),
    )


def previous(value):
    """The value of the row before this one."""
    value = _column(value)
    return Running(
        local=lambda w, order: F.lag(value).over(w),
        total=lambda order: F.max_by(value, order),
        carry=lambda total, w: F.lag(total).over(w),
        combine=lambda local, carry, first: F.when(first, carry).otherwise(local),
        needs_first=True,
    )


def position(from_end=False):
    """The 0-based number of the row within its series, from its start or its end."""
    return Running(
        backwards=from_end,
        local=lambda w, order: F.row_number().over(w).cast("long") - 1,
        total=lambda order: F.count(F.lit(1)),
        carry=lambda total, w: F.sum(total).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        combine=lambda local, carry, first: local + F.coalesce(carry, F.lit(0)),
    )


class Cuts(NamedTuple):
    """The sorted cut points of each long key, the most that one key has, and the number of all."""

    table: DataFrame
    most: int
    all: int


class Series:
    """Rows of `frame` as one series per `key`, in the total order `order`.

    An empty `key` makes the whole table one series. `bounded_by` names a frame
    with at least as many rows that is cheaper to count, such as the stored
    table that `frame` was aggregated from.
    """

    def __init__(self, frame: DataFrame, key, order, segment_rows=SEGMENT_ROWS, bounded_by=None):
        self.key = _names(key)
        self.order = _names(order)
        if not self.order:
            raise ValueError("a series needs an order")
        if not self.key:
            frame, self.key = frame.withColumn(ONE_SERIES, F.lit(0)), [ONE_SERIES]
        rows = (frame if bounded_by is None else bounded_by).count()
        self.split = rows > segment_rows
        # `plain` has the rows before any shuffle and `long_keys` those of them
        # that were cut, so that totals are aggregated before they are shuffled.
        self.plain, self.long_keys, self.frame, self.fresh = frame, None, frame, True
        cuts = self._cuts(frame, rows, segment_rows) if self.split else None
        self.split = bool(cuts and cuts.most)
        self.width = None
        if self.split:
            # As many tasks as there are segments, if that is more than usual.
            self.width = max(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), cuts.all)
            self.long_keys = self._mark(frame, cuts, "inner")
            self.frame = self._dealt(self._mark(frame, cuts, "left"))

    def _dealt(self, frame):
        return frame.repartition(self.width, *self.key, SEGMENT)

    def _with(self, frame, plain=None, long_keys=None):
        other = object.__new__(Series)
        other.key, other.order, other.split, other.width = self.key, self.order, self.split, self.width
        other.frame, other.plain, other.long_keys = frame, plain or self.plain, long_keys
        other.fresh = plain is not None
        return other

    def _cuts(self, frame, rows, segment_rows):
        step = max(ceil(segment_rows / SAMPLES_PER_CUT), ceil(rows / (MAX_CUTS * SAMPLES_PER_CUT)))
        here = F.struct(*self.order)
        # The sample places cut points only; every row stays in the result.
        sample = frame.select(*self.key, here.alias("_here")).sample(fraction=1 / step, seed=11)
        numbered = sample.withColumn("_n", F.row_number().over(Window.partitionBy(*self.key).orderBy("_here")))
        cuts = (
            numbered.where(F.col("_n") % SAMPLES_PER_CUT == 0)
            .groupBy(*self.key)
            .agg(F.collect_list("_here").alias("_points"))
        )
        # Collected so that every later pass over the data sees the same cuts.
        held = cuts.toArrow()
        fixed = frame.sparkSession.createDataFrame(held, cuts.schema)
        named = fixed.select(*[F.col(k).alias(f"_cut_{k}") for k in self.key], F.sort_array("_points").alias("_points"))
        sizes = [len(c) for c in held["_points"]]
        return Cuts(named, max(sizes, default=0), sum(sizes))

    def _mark(self, frame, cuts, how):
        """Number the segment of each row: how many cuts of its key are not above it."""
        same_key = [F.col(k).eqNullSafe(F.col(f"_cut_{k}")) for k in self.key]
        # At most MAX_CUTS cut points in all.
        joined = frame.join(F.broadcast(cuts.table), same_key, how).withColumns(
            {"_here": F.struct(*self.order), SEGMENT: F.when(F.col("_points").isNotNull(), 0)}
        )
        # Bisection, one compiled projection per step.
        low = F.col(SEGMENT)
        for step in reversed([1 << i for i in range(cuts.most.bit_length())]):
            above = F.get("_points", low + (step - 1)) <= F.col("_here")
            joined = joined.withColumn(SEGMENT, F.when(above, low + step).otherwise(low))
        return joined.drop("_here", "_points", *[f"_cut_{k}" for k in self.key])

    def window(self, backwards=False):
        """The window of one segment; the whole key where nothing was cut."""
        keys = [*self.key, SEGMENT] if self.split else self.key
        return Window.partitionBy(*keys).orderBy(*[F.col(c).desc() if backwards else F.col(c).asc() for c in self.order])

    def add(self, **running):
        """Add running values; all of them share one sort and one pass of totals.

        A cut series that already has some is stored in the shared folder
        first: the totals and the windows both read it, and without that each
        step would work out all steps before it twice.
        """
        doubles = self._doubles(running)
        if doubles:
            return self._add_exactly(running, doubles)
        if self.split and not self.fresh:
            stored = store(self.frame, "segments")
            held = self._with(self._dealt(stored), stored, stored.where(F.col(SEGMENT).isNotNull()))
            return held.add(**running)
        order = F.struct(*self.order)
        local = {name: r.local(self.window(r.backwards), order) for name, r in running.items()}
        if not self.split:
            return self._with(self.frame.withColumns(local))
        cut = self.frame.where(F.col(SEGMENT).isNotNull()) if self.long_keys is None else self.long_keys
        totals = cut.groupBy(*self.key, SEGMENT).agg(
            *[r.total(order).alias(f"_carry_{name}") for name, r in running.items()]
        )
        before = {
            False: Window.partitionBy(*self.key).orderBy(F.col(SEGMENT).asc()),
            True: Window.partitionBy(*self.key).orderBy(F.col(SEGMENT).desc()),
        }
        carries = totals.select(
            *[F.col(k).alias(f"_to_{k}") for k in [*self.key, SEGMENT]],
            *[r.carry(F.col(f"_carry_{name}"), before[r.backwards]).alias(f"_carry_{name}") for name, r in running.items()],
        )
        numbered = self.frame.withColumns({f"_local_{n}": c for n, c in local.items()})
        if any(r.needs_first for r in running.values()):
            numbered = numbered.withColumn("_first", F.row_number().over(self.window()) == 1)
        same = [F.col(k).eqNullSafe(F.col(f"_to_{k}")) for k in [*self.key, SEGMENT]]
        joined = numbered.join(F.broadcast(carries), same, "left")
        combined = joined.withColumns(
            {
                name: r.combine(F.col(f"_local_{name}"), F.col(f"_carry_{name}"), F.col("_first"))
                for name, r in running.items()
            }
        )
        spent = [f"_to_{k}" for k in [*self.key, SEGMENT]] + ["_first"]
        spent += [f"{p}_{n}" for p in ("_local", "_carry") for n in running]
        return self._with(combined.drop(*spent))

    def _doubles(self, running):
        """The running sums of doubles, by name."""
        sums = {name: r.summed for name, r in running.items() if r.summed}
        if not sums:
            return {}
        kinds = self.frame.select(*[value.alias(name) for name, (value, _) in sums.items()]).schema
        return {f.name: sums[f.name] for f in kinds if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def _add_exactly(self, running, doubles):
        """Add running values of which some are sums of doubles: these as sums of their pieces (see `exact`)."""
        series = self
        if not self.fresh:
            stored = store(self.frame, "segments")
            cut = stored.where(F.col(SEGMENT).isNotNull()) if self.split else None
            series = self._with(self._dealt(stored) if self.split else stored, stored, cut)
        rows = series.plain
        sizes = [b.alias(f"{name} {end}") for name, (value, _) in doubles.items() for b, end in zip(exact.bounds(value), ("least", "most"))]
        found = rows.agg(*sizes).first()
        cuts = {name: exact.places(found[f"{name} least"], found[f"{name} most"]) for name in doubles}
        parts = {name: value for name, value in running.items() if name not in doubles}
        for name, (value, exclusive) in doubles.items():
            held = [*exact.pieces(value, cuts[name]), exact.odd(value)]
            parts |= {f"_part_{name}_{i}": replace(running_sum(piece, exclusive), summed=None) for i, piece in enumerate(held)}
        added = series.add(**parts)
        for name in doubles:
            sums = [F.col(f"_part_{name}_{i}") for i in range(len(cuts[name]) + 1)]
            added = added.with_columns({f"_sign_{name}": exact.sign(sums[:-1])})
            whole = exact.standard(sums[:-1], F.col(f"_sign_{name}"), cuts[name])
            added = added.with_columns({name: F.coalesce(sums[-1], whole)}).drop(f"_sign_{name}", *[f"_part_{name}_{i}" for i in range(len(sums))])
        # The columns in the order in which they were asked for.
        others = [c for c in added.frame.columns if c not in running]
        return added._with(added.frame.select(*others, *running))

    def with_columns(self, columns):
        """Add plain columns."""
        frame = self.frame.withColumns(columns)
        if not self.fresh:
            return self._with(frame)
        cut = None if self.long_keys is None else self.long_keys.withColumns(columns)
        return self._with(frame, self.plain.withColumns(columns), cut)

    def where(self, condition):
        """Keep the rows that meet a condition; the cuts stay."""
        return self._with(self.frame.where(condition))

    def drop(self, *columns):
        """Drop columns."""
        return self._with(self.frame.drop(*columns))

    def rows(self):
        """The rows as a plain DataFrame."""
        return self.frame.drop(*HELPERS)


def diff(series, value, op="-", out="diff"):
    """Difference (`-`) or quotient (`/`) of each value and the one before it.

    The first value stays as it is. Division by zero gives null.
    """
    if op not in ("-", "/"):
        raise ValueError(f"unknown operator {op!r}")
    x, before = F.col(value), F.col("_before")
    change = x - before if op == "-" else F.try_divide(x, before)
    numbered = series.add(_before=previous(value), _at=position())
    result = numbered.with_columns({out: F.when(F.col("_at") == 0, x).otherwise(change)})
    return result.rows().drop("_before", "_at")


def scan(series, value, op="+", out="scan"):
    """Running sum (`+`) or running product (`*`), this row included."""
    if op not in ("+", "*"):
        raise ValueError(f"unknown operator {op!r}")
    return series.add(**{out: running_sum(value) if op == "+" else running_product(value)}).rows()


def cumprod(series, values=None, suffix="_cumprod"):
    """Running product of each of the given columns, or of every number beside key and order."""
    if values is None:
        numbers = [f.name for f in series.rows().schema if isinstance(f.dataType, T.NumericType)]
        values = [c for c in numbers if c not in (*series.key, *series.order)]
    return series.add(**{f"{v}{suffix}": running_product(v) for v in values}).rows()


def pnl(series, price, cash_flow, trade, initial=0.0):
    """Position, value and amount of a trading strategy.

    The position is the sum of earlier trades, the value marks position plus
    trade to the price, and the amount is cash flow received minus the cost of
    the trade. The initial account value enters the first value only.
    """
    x, c, g, d = F.col(price), F.col(cash_flow), F.col(trade), F.col("position")
    held = series.add(_held=running_sum(trade, exclusive=True), _at=position())
    placed = held.with_columns({"position": F.coalesce(F.col("_held"), F.lit(0.0))})
    start = F.when(F.col("_at") == 0, F.lit(float(initial))).otherwise(F.lit(0.0))
    return placed.with_columns({"value": (d + g) * x + start, "amount": d * c - g * x}).rows().drop("_held", "_at")


def take(series, count):
    """The first `count` rows of each series, or the last where it is negative."""
    if count == 0:
        return series.rows().limit(0)
    order = [F.col(c).asc() if count > 0 else F.col(c).desc() for c in series.order]
    if abs(count) <= TAKE_AHEAD:
        return _ranked(series, abs(count), order).drop("_rank")
    return _slice(series, count, keep=True)


def _ranked(series, count, order):
    """The first `count` rows of each series with their rank; a long key sends only so many rows per task."""
    rows = series.plain if series.fresh else series.frame
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*series.key).orderBy(*order)))
    return ranked.where(F.col("_rank") <= count).drop(*HELPERS)


def _numbered(series, count):
    """The rows of each series at positions below `count` (all if None), numbered from 0 as `_at`."""
    if count is not None and 0 < count <= TAKE_AHEAD and series.key:
        first = _ranked(series, count, [F.col(c).asc() for c in series.order])
        return first.withColumn("_at", F.col("_rank").cast("long") - 1).drop("_rank")
    rows = series.add(_at=position()).rows()
    return rows if count is None else rows.where(F.col("_at") < count)


def drop(series, count):
    """All but the first `count` rows, or all but the last where it is negative."""
    return series.rows() if count == 0 else _slice(series, count, keep=False)


def _slice(series, count, keep):
    inside = F.col("_at") < abs(count)
    return series.add(_at=position(from_end=count < 0)).rows().where(inside if keep else ~inside).drop("_at")


def gather(series, positions, columns=None, out="out_pos"):
    """The rows at 0-based `positions` of each series, in the given order.

    Positions may repeat; one beyond the end gives no row. None means all rows.
    `columns` are names or 0-based numbers, None means all.
    """
    if columns is not None:
        names = series.rows().columns
        columns = [names[c] if isinstance(c, int) else c for c in columns]
    numbered = _numbered(series, None if positions is None else max(positions, default=-1) + 1)
    if positions is None:
        picked = numbered.withColumnRenamed("_at", out)
    else:
        listed = numbered.sparkSession.createDataFrame(
            pa.table({out: pa.array(range(len(positions)), pa.int64()), "_at": pa.array(positions, pa.int64())})
        )
        # Bounded by the length of the argument.
        picked = numbered.join(F.broadcast(listed), "_at").drop("_at")
    kept = [k for k in series.key if k != ONE_SERIES]
    columns = [c for c in numbered.columns if c not in (*kept, "_at")] if columns is None else columns
    return picked.select(*kept, out, *columns)


def reshape(series, value, rows, columns, names=None):
    """Lay each series out as a grid of `rows` x `columns`, row by row.

    Surplus values are dropped and missing cells are null. The rows of one key
    and grid row are at most `columns` many, so no group is long.
    """
    names = names or [f"c{j}" for j in range(columns)]
    at = F.col("_at")
    key = [k for k in series.key if k != ONE_SERIES]
    kind = series.plain.schema[value].dataType
    cells = _numbered(series, rows * columns)

    def cell(row, column, held):
        return F.struct(row.alias("row"), column.alias("column"), held.cast(kind).alias("held"))

    own = F.array(cell(F.expr(f"_at div {columns}"), at % columns, F.col(value)))
    # The first row of a series also brings an empty cell for every grid row.
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(rows - 1).cast("long"))
    blank = F.transform(numbers, lambda row: cell(row, F.lit(None).cast("long"), F.lit(None)))
    placed = cells.select(*key, F.inline(F.when(at == 0, F.concat(own, blank)).otherwise(own)))
    grid = [F.max(F.when(F.col("column") == j, F.col("held"))).alias(name) for j, name in enumerate(names)]
    return placed.groupBy(*key, F.col("row").alias("grid_row")).agg(*grid)


def series_max(frame, key, value, out="series_max"):
    """The largest value of each series."""
    return frame.groupBy(*_names(key)).agg(F.max(value).alias(out))


def reflect(frame, key, value, out="reflected"):
    """Mirror each series at its maximum: `max - value`.

    The maximum is aggregated before the shuffle and joined back, so a long key
    is never held by one window.
    """
    tops = series_max(frame, key, value, "_top")
    joined = join_on_key(frame, tops, _names(key))
    return joined.withColumn(out, F.col("_top") - F.col(value)).drop("_top")


def sequence(frame, start, stop, incr=None, out="value"):
    """For each row, the numbers from `start` to `stop`, one output row each.

    Without an increment the step is 1 towards `stop`. An increment of at most 1
    is a step, whose sign follows the direction; a larger one is a number of
    evenly spaced points.
    """
    start, stop = _column(start).cast("double"), _column(stop).cast("double")
    incr = F.lit(0.0) if incr is None else F.coalesce(_column(incr).cast("double"), F.lit(0.0))
    points = incr > 1
    count = F.floor(incr)
    size = F.when(incr == 0, F.lit(1.0)).otherwise(F.abs(incr))
    direction = F.when(start > stop, F.lit(-1.0)).otherwise(F.lit(1.0))
    step = F.when(points, F.try_divide(stop - start, count - 1)).otherwise(size * direction)
    last = F.when(points, count - 1).otherwise(F.floor(F.abs(stop - start) / size))
    # In blocks, so that a long range is never one array.
    zero, block = F.lit(0).cast("long"), F.col("_block")
    tasks = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = F.when((count >= 2) | ~points, F.sequence(zero, F.expr(f"_last div {SEQUENCE_BLOCK}")))
    within = F.sequence(block * SEQUENCE_BLOCK, F.least((block + 1) * SEQUENCE_BLOCK - 1, F.col("_last")))
    return (
        frame.withColumns({"_start": start, "_step": step, "_last": last.cast("long")})
        .withColumn("_block", F.explode(blocks))
        # A row per block, so the blocks of a long range go to all tasks; with a
        # number of its own, since adaptive execution would join such small rows.
        .repartition(tasks, "_start", "_last", "_block")
        .withColumn("n", F.explode(within))
        .withColumn(out, F.col("_start") + F.col("n") * F.col("_step"))
        .drop("_start", "_step", "_last", "_block")
    )


def join_on_key(frame, per_key, key):
    """Add the columns of a table with one row per key.

    Spark broadcasts the small side when its measured size allows and otherwise
    splits a hot key of `frame` at run time. Null keys match each other.
    """
    renamed = per_key.select(
        *[F.col(k).alias(f"_on_{k}") for k in key], *[c for c in per_key.columns if c not in key]
    )
    same = [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in key]
    return frame.join(renamed, same, "left").drop(*[f"_on_{k}" for k in key])


def _names(names):
    return [names] if isinstance(names, str) else list(names)


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value
