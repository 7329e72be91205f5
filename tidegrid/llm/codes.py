"""Vectors as codes of their parts, by exact integer k-means with remembered bounds.

Each component x becomes floor(scale * x), and a vector is cut into equal parts
with a codebook for each part position. Between rounds every vector keeps, for
each part, the entry that it is assigned to and a lower bound on its distance
to each group of the other entries, with the round in which that bound was
taken. All earlier codebooks are kept too. A bound that is some rounds old is
lowered by the way that the entries of its group have really come since that
round, from codebook to codebook, not by the sum of their steps, which is
longer. Only groups whose bound then still reaches the distance to the own
entry are scanned again, exactly.

Codebooks are as large as the arguments say, whatever the table; the vectors
stay in the tasks, and sums are added up before they are shuffled.
"""

import hashlib
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.support import batch
from tidegrid.operators.series import join_on_key
from tidegrid.session import store

# Sums travel in pieces of so many bits, so that they are exact at any size.
LIMB = 32
# What rounding can take away from a root, with room to spare.
SLACK = 1e-9


class Codes(NamedTuple):
    """The rows with their codes, and the codebooks of each round, the last ones being final."""

    rows: DataFrame
    codebooks: list


def usable(vector):
    """True for a vector that is not null and holds no null and no component that is not finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def whole(values, scale):
    """floor(scale * x) of each number, as Python integers where these are large."""
    values = np.asarray(values, np.float64)
    scaled = values * scale
    if not len(values) or np.abs(scaled).max() < 2.0**52:
        return np.floor(scaled).astype(np.int64)
    return np.array([math.floor(v) * scale if abs(v) >= 2.0**52 else math.floor(v * scale) for v in values.tolist()], object)


def assign(points, book, place, own, bound, stamp, moved):
    """Assign points to their nearest entries; those of `own` are taken on where the bounds allow. All arrays are changed in place.

    `points` is n x w, `bound` and `stamp` are n x groups. Returns the exact
    squared distances. `moved[t]` holds, for each entry, how far it has come
    from the codebook of round t to this one.
    """
    n, entries = len(points), len(book)
    groups = bound.shape[1]
    size = -(-entries // groups)
    width = points.shape[1]
    reach = max([abs(int(v)) for v in (points.max(initial=0), points.min(initial=0), book.max(initial=0), book.min(initial=0))])
    plain = points.dtype != object and book.dtype != object and width * (2 * reach) ** 2 < 2**53
    if not plain:
        # Too large for floating point to be exact: no bounds, every entry in Python integers.
        best = np.empty(n, object)
        for i, point in enumerate(points.tolist()):
            squares = [sum((a - b) ** 2 for a, b in zip(point, entry)) for entry in book.tolist()]
            own[i] = min(range(entries), key=squares.__getitem__)
            best[i] = squares[own[i]]
        bound[:], stamp[:] = 0, place
        return best
    exact, centres = points.astype(np.float64), book.astype(np.float64)
    squares = (centres**2).sum(1)
    lengths = (exact**2).sum(1)
    if place == 0:
        best = np.full(n, np.inf)
        stale = np.ones((n, groups), bool)
    else:
        best = ((exact - centres[own]) ** 2).sum(1)
        stale = np.empty((n, groups), bool)
        now = np.sqrt(best) * (1 + SLACK) + SLACK
        for g in range(groups):
            way = np.array([moved[t][g * size : (g + 1) * size].max(initial=0) for t in range(place)] + [0.0])
            stale[:, g] = bound[:, g] - way[stamp[:, g]] <= now
    # The nearest of each group that is scanned, and the second nearest, for the bounds.
    first, nearest = best.copy(), own.astype(np.int64)
    scanned = []
    for g in range(groups):
        rows = np.flatnonzero(stale[:, g])
        low, high = g * size, min((g + 1) * size, entries)
        if not len(rows) or low >= high:
            continue
        far = lengths[rows, None] - 2 * (exact[rows] @ centres[low:high].T) + squares[low:high]
        at = far.argmin(1)
        least = far[np.arange(len(rows)), at]
        better = (least < first[rows]) | ((least == first[rows]) & (at + low < nearest[rows]))
        first[rows[better]], nearest[rows[better]] = least[better], at[better] + low
        scanned.append((g, low, high, rows, far))
    changed = nearest != own if place else np.zeros(n, bool)
    for g, low, high, rows, far in scanned:
        # The own entry is not among those that the bound speaks of.
        mine = nearest[rows]
        inside = (mine >= low) & (mine < high)
        far[np.flatnonzero(inside), mine[inside] - low] = np.inf
        bound[rows, g] = np.sqrt(far.min(1)) * (1 - 1e-6)
        stamp[rows, g] = place
    if changed.any():
        # The entry that a point leaves counts for its group's bound again, which may not have been scanned.
        rows = np.flatnonzero(changed)
        g = own[rows] // size
        left = np.sqrt(best[rows]) * (1 - 1e-6)
        way = np.array([moved[t].max(initial=0) for t in range(place)] + [0.0])
        older = np.maximum(bound[rows, g] - way[stamp[rows, g]] * (1 + SLACK) - SLACK, 0)
        bound[rows, g] = np.minimum(older, left)
        stamp[rows, g] = place
    own[:] = nearest
    return first


def _moved(history):
    """For each earlier round and part, how far each entry has come from there to the last codebooks, rounded up."""
    out = []
    for books in history[:-1]:
        parts = []
        for then, now in zip(books, history[-1]):
            squares = [sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for x, y in zip(then, now)]
            parts.append(np.array([math.nextafter(math.sqrt(s), math.inf) * (1 + SLACK) if s < 2**1000 else math.inf for s in squares]))
        out.append(parts)
    return out


def _passing(schema, parts, scale, history, groups, use):
    """A pass over all vectors: bring them to the last codebooks, and hand `use` the block and what was found."""
    place, moved = len(history) - 1, _moved(history)

    def run(batches):
        for block in batches:
            if not block.num_rows:
                continue
            n = block.num_rows
            numbers = whole(block.column("vector").flatten().to_numpy(zero_copy_only=False), scale).reshape(n, parts, -1)
            if place:
                held = [np.frombuffer(b"".join(block.column(c).to_pylist()), kind).copy() for c, kind in STATE]
                own, bound, stamp = held[0].reshape(n, parts), held[1].reshape(n, parts, groups), held[2].reshape(n, parts, groups)
            else:
                own, bound, stamp = np.zeros((n, parts), np.uint8), np.zeros((n, parts, groups), np.float32), np.zeros((n, parts, groups), np.uint8)
            errors = []
            for p in range(parts):
                book = np.array(history[-1][p], dtype=object)
                book = book.astype(np.int64) if all(abs(v) < 2**62 for v in book.ravel()) else book
                ways = [m[p] for m in moved]
                errors.append(assign(numbers[:, p], book, place, own[:, p], bound[:, p], stamp[:, p], ways))
            yield from use(block, numbers, own, bound, stamp, errors)

    return lambda frame: frame.mapInArrow(run, schema)


# Kept of each vector between rounds: its entries, its bounds, the rounds that these are of.
STATE = [("own", np.uint8), ("bound", np.float32), ("stamp", np.uint8)]


def _rows_of(array):
    flat = np.ascontiguousarray(array).reshape(len(array), -1)
    return pa.array([row.tobytes() for row in flat], pa.binary())


def _keep(block, numbers, own, bound, stamp, errors):
    held = [block.column(c) for c in ("id", "label", "vector")]
    arrays = [*held, _rows_of(own), _rows_of(bound), _rows_of(stamp)]
    yield pa.RecordBatch.from_arrays(arrays, names=["id", "label", "vector", *[c for c, _ in STATE]])


def _show(block, numbers, own, bound, stamp, errors):
    codes = [row.tobytes().hex() for row in np.ascontiguousarray(own)]
    total = [sum(int(e) for e in row) for row in zip(*errors)]
    total = pa.array([t if t < 2**63 else None for t in total], pa.int64())
    yield pa.RecordBatch.from_arrays([block.column("id"), block.column("label"), pa.array(codes, pa.string()), total], names=["id", "label", "code", "error"])


SUMS = "part int, entry int, position int, limb int, total long"


def _sums(rows, parts, scale):
    """How many parts each entry has, and their sums: (part, entry, position, limb, total), the count at position -1."""

    def run(batches):
        for block in batches:
            if not block.num_rows:
                continue
            numbers = whole(block.column("vector").flatten().to_numpy(zero_copy_only=False), scale).reshape(block.num_rows, parts, -1)
            own = np.frombuffer(b"".join(block.column("own").to_pylist()), np.uint8).reshape(-1, parts)
            out = []
            for p in range(parts):
                order = np.argsort(own[:, p], kind="stable")
                entries, starts, counts = np.unique(own[order, p], return_index=True, return_counts=True)
                # Blocks of at most 10,000 rows: sums of numbers below 2^52 may pass 2^63 only as Python integers.
                held = numbers[order, p]
                large = held.dtype != object and len(held) and np.abs(held).max() >= 2**48
                totals = np.add.reduceat(held.astype(object) if large else held, starts)
                for entry, count, sums in zip(entries.tolist(), counts.tolist(), totals.tolist()):
                    for position, value in enumerate([count, *sums], -1):
                        out += [(p, entry, position, limb, piece) for limb, piece in enumerate(_limbs(value))]
            yield batch(SUMS, *zip(*out))

    return rows.select("vector", "own").mapInArrow(run, SUMS).groupBy("part", "entry", "position", "limb").agg(F.sum("total").alias("total"))


def _limbs(value):
    """A whole number in pieces of LIMB bits, the last one with its sign."""
    out = []
    while not -(1 << LIMB) < value < 1 << LIMB:
        out.append(value & (1 << LIMB) - 1)
        value >>= LIMB
    return [*out, value]


def _next_books(books, totals):
    """Each entry's mean, rounded down; entries without parts stay. `totals` has a bounded number of rows."""
    sums = {}
    for row in totals.collect():
        key = (row.part, row.entry, row.position)
        sums[key] = sums.get(key, 0) + (row.total << LIMB * row.limb)
    return [
        [[sums[p, e, i] // sums[p, e, -1] for i in range(len(entry))] if (p, e, -1) in sums else entry for e, entry in enumerate(book)]
        for p, book in enumerate(books)
    ]


def compress(frame, id="vec_id", vector="embedding", label="label", parts=16, entries=64, rounds=2, scale=256, groups=4):
    """A code for each vector, its squared error, and the error of all vectors of its label.

    Rows whose vector is null or holds a null or a component that is not finite
    take no part, nor do those whose length is not the commonest one that can be
    cut into `parts` (of equally common ones the largest). Each codebook begins
    as that part of the vectors with the `entries` smallest identifiers, fewer if
    there are fewer; a null identifier comes last, and rows that share one are
    taken in the order of their vectors. In each round every part is assigned to the nearest
    entry, the lower one of equals, and entries move to the mean, rounded down.
    After the last round all are assigned once more.

    One row per row that takes part: id, code (two hexadecimal digits a part),
    error, label_error; null labels are one label. Numbers may be of any size; an error beyond a long is
    null. Columns of other names play no part. No row that takes part: no rows,
    and no codebooks.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits, so 1 to 256 entries")
    held = frame.select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector")).where(usable(F.col("vector")))
    kinds = _described(held)
    sizes = held.groupBy(F.size("vector").alias("size")).count().where((F.col("size") > 0) & (F.col("size") % parts == 0))
    common = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    if common is None:
        empty = held.limit(0).select("id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"))
        return Codes(empty, [])
    held = held.where(F.size("vector") == common["size"])
    seeds = held.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).collect()
    first = [whole(list(s.vector), scale).reshape(parts, -1).tolist() for s in seeds]
    history = [[[vector[p] for vector in first] for p in range(parts)]]
    state = f"{kinds}, " + ", ".join(f"{name} binary" for name, _ in STATE)
    rows = held
    for _ in range(rounds):
        rows = store(_passing(state, parts, scale, history, groups, _keep)(rows), "codes")
        history.append(_next_books(history[-1], _sums(rows, parts, scale)))
    shown = f"{kinds.rsplit(', ', 1)[0]}, code string, error long"
    coded = store(_passing(shown, parts, scale, history, groups, _show)(rows), "codes")
    # A null error makes the sum of its label unknown too.
    total = F.when(F.count("error") == F.count(F.lit(1)), F.try_sum(F.col("error").cast("decimal(38,0)")))
    errors = coded.groupBy("label").agg(total.try_cast("long").alias("label_error"))
    return Codes(join_on_key(coded, errors, ["label"]).select("id", "code", "error", "label_error"), history)


def _described(frame):
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema)


def digest(codebooks):
    """The SHA-256 of all entries of the last codebooks, as decimal numbers by part, entry and position."""
    numbers = [str(v) for book in codebooks[-1] for entry in book for v in entry] if codebooks else []
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def approximate(codebooks, code):
    """The whole numbers that a code stands for."""
    return [v for p, e in enumerate(bytes.fromhex(code)) for v in codebooks[-1][p][e]]
