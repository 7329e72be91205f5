"""Series operators against plain Python, on one long key and many short ones."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tidegrid.operators import series as S


@pytest.fixture(scope="module")
def data():
    """A third of the rows has key `hot`, another third a null key; ties in the first order column."""
    rng = random.Random(3)
    keys = ["hot", None, *[f"k{i}" for i in range(40)]]
    rows = []
    for i in range(3000):
        key = keys[0] if i % 3 == 0 else keys[1] if i % 3 == 1 else rng.choice(keys[2:])
        value = None if i % 97 == 0 else round(rng.uniform(-5, 5), 3)
        rows.append((key, rng.randrange(4), i, value))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data, "k string, a int, b int, x double").repartition(5)


@pytest.fixture(params=["whole", "split", "one series", "one series split"])
def case(request, frame, data):
    key = [] if "one series" in request.param else ["k"]
    rows = 100 if "split" in request.param else 10_000
    series = S.Series(frame, key, ["a", "b"], segment_rows=rows)
    assert series.split == ("split" in request.param)
    groups = {}
    for row in sorted(data, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0] if key else 0, []).append(row)
    return series, groups.values()


def by_b(frame, *columns):
    return {r["b"]: tuple(r[c] for c in columns) for r in frame.collect()}


def close(left, right):
    assert left.keys() == right.keys()
    for key in left:
        for x, y in zip(left[key], right[key]):
            assert (x is None) == (y is None), (key, left[key], right[key])
            assert x is None or math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9), key


def test_long_keys_are_cut(frame):
    series = S.Series(frame, "k", ["a", "b"], segment_rows=100)
    sizes = series.frame.groupBy("k", S.SEGMENT).count().collect()
    assert max(r["count"] for r in sizes) < 500
    assert {r.k for r in sizes if r[S.SEGMENT] is not None} >= {"hot", None}


def test_diff_and_ratio(case):
    series, groups = case
    want, ratio = {}, {}
    for rows in groups:
        before = [None, *[r[3] for r in rows]]
        for i, r in enumerate(rows):
            p, x = before[i], r[3]
            want[r[2]] = (x if i == 0 else None if None in (x, p) else x - p,)
            ratio[r[2]] = (x if i == 0 else None if None in (x, p) or p == 0 else x / p,)
    close(by_b(S.diff(series, "x"), "diff"), want)
    close(by_b(S.diff(series, "x", "/"), "diff"), ratio)


def test_scan(case):
    series, groups = case
    sums, products = {}, {}
    for rows in groups:
        total, product = None, None
        for r in rows:
            if r[3] is not None:
                total = (total or 0) + r[3]
                product = (1 if product is None else product) * (1 + r[3] / 1000)
            sums[r[2]], products[r[2]] = (total,), (product,)
    close(by_b(S.scan(series, "x"), "scan"), sums)
    grown = series.with_columns({"g": 1 + F.col("x") / 1000})
    close(by_b(S.scan(grown, "g", "*"), "scan"), products)
    close(by_b(S.cumprod(grown, ["g"]), "g_cumprod"), products)
    assert {"g_cumprod", "x_cumprod"} == {c for c in S.cumprod(grown).columns if c.endswith("_cumprod")}


def test_diff_of_scan_is_the_series(case):
    series, groups = case
    filled = series.with_columns({"y": F.coalesce("x", F.lit(0.0))})
    again = S.Series(S.scan(filled, "y", out="z"), [c for c in series.key if c != S.ONE_SERIES], ["a", "b"])
    close(by_b(S.diff(again, "z"), "diff"), {r[2]: (r[3] or 0.0,) for rows in groups for r in rows})


def test_pnl(case):
    series, groups = case
    want = {}
    for rows in groups:
        held = 0
        for i, (_, _, b, _) in enumerate(rows):
            x, c, g = 10 + b % 7, b % 3, b % 5 - 2
            want[b] = (held, (held + g) * x + (50 if i == 0 else 0), held * c - g * x)
            held += g
    b = F.col("b")
    trades = series.with_columns({"p": 10.0 + b % 7, "c": 0.0 + b % 3, "g": b % 5 - 2.0})
    close(by_b(S.pnl(trades, "p", "c", "g", initial=50), "position", "value", "amount"), want)


def test_pnl_golden(spark):
    rows = spark.createDataFrame([(1, 0, 10.0, 0.0, 2.0), (1, 1, 11.0, 1.0, -1.0), (1, 2, 12.0, 0.0, 3.0)], "k int, b int, x double, c double, g double")
    result = S.pnl(S.Series(rows, "k", "b"), "x", "c", "g")
    assert by_b(result, "position", "value", "amount") == {0: (0, 20, -20), 1: (2, 11, 13), 2: (1, 48, -36)}


@pytest.mark.parametrize("count", [5, -5, 700, -700, 1200, -1200, 0])
def test_take_and_drop(case, count):
    series, groups = case
    taken, dropped = set(), set()
    for rows in groups:
        ids = [r[2] for r in rows]
        inside = ids[:count] if count > 0 else ids[count:] if count < 0 else []
        taken |= set(inside)
        dropped |= set(ids) - set(inside)
    assert sorted(r.b for r in S.take(series, count).collect()) == sorted(taken)
    assert sorted(r.b for r in S.drop(series, count).collect()) == sorted(dropped)


def test_gather(case):
    series, groups = case
    positions = [2, 0, 2, 900]
    want = sorted((i, rows[p][2]) for rows in groups for i, p in enumerate(positions) if p < len(rows))
    found = S.gather(series, positions, ["b"]).collect()
    assert sorted((r.out_pos, r.b) for r in found) == want
    assert S.gather(series, None, ["b"]).count() == sum(map(len, groups))
    named = [c for c in series.rows().columns]
    assert S.gather(series, [0], [named.index("b")]).columns[-1] == "b"


def test_reshape(case):
    series, groups = case
    found = S.reshape(series, "b", rows=30, columns=4)
    cells = sorted((r.grid_row, r.c0, r.c1, r.c2, r.c3) for r in found.collect() if r.c0 is not None)
    want = []
    for rows in groups:
        ids = [r[2] for r in rows][:120]
        for i in range(0, len(ids), 4):
            want.append((i // 4, *[*ids[i : i + 4], None, None, None][:4]))
    assert [c[:2] for c in cells] == sorted(w[:2] for w in want)
    assert {c[1]: c for c in cells} == {w[1]: w for w in want}
    assert found.count() == 30 * len(groups)


def test_reflect(frame, data):
    tops = {}
    for k, _, _, x in data:
        tops[k] = max(tops.get(k, -9), x if x is not None else -9)
    want = {r[2]: (None if r[3] is None else tops[r[0]] - r[3],) for r in data}
    close(by_b(S.reflect(frame, "k", "x"), "reflected"), want)


def test_two_windows_share_one_shuffle(frame):
    series = S.Series(frame, "k", ["a", "b"])
    chained = series.add(s=S.running_sum("x")).add(p=S.previous("x")).rows()
    plan = chained._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_totals_are_aggregated_before_they_are_shuffled(frame):
    series = S.Series(frame, "k", ["a", "b"], segment_rows=100)
    plan = S.scan(series, "x")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1


@pytest.mark.parametrize(
    "start, stop, incr, want",
    [
        (0, 3, None, [0, 1, 2, 3]),
        (3, 0, None, [3, 2, 1, 0]),
        (0, 1, 0.5, [0, 0.5, 1]),
        (1, 0, 0.5, [1, 0.5, 0]),
        (0, 1, -0.25, [0, 0.25, 0.5, 0.75, 1]),
        (0, 1, 3, [0, 0.5, 1]),
        (1, -1, 2.9, [1, -1]),
        (0, 5, 1.5, []),
        (2, 2, None, [2]),
    ],
)
def test_sequence(spark, start, stop, incr, want):
    one = spark.range(1)
    got = S.sequence(one, F.lit(start), F.lit(stop), None if incr is None else F.lit(incr)).orderBy("n").collect()
    assert [r.value for r in got] == want


def test_long_sequence(spark):
    got = S.sequence(spark.range(1), F.lit(0), F.lit(200_000)).agg(F.count("n"), F.sum("value"), F.max("n")).first()
    assert tuple(got) == (200_001, 200_000 * 200_001 / 2, 200_000)


def test_unknown_operator(frame):
    series = S.Series(frame, "k", ["a", "b"])
    with pytest.raises(ValueError):
        S.diff(series, "x", "%")
    with pytest.raises(ValueError):
        S.scan(series, "x", "-")
    with pytest.raises(ValueError):
        S.Series(frame, "k", [])


def test_bounded_by_saves_the_count(frame):
    few = frame.groupBy("k").agg(F.max("b").alias("b"), F.max("x").alias("x"))
    assert not S.Series(few, "k", "b", bounded_by=frame).split
    assert len(list(itertools.islice(S.scan(S.Series(few, "k", "b"), "x").toLocalIterator(), 50))) == 42


def test_first_rows_are_limited_before_the_shuffle(spark):
    frame = spark.range(1000).selectExpr("id % 3 AS k", "id AS t", "id AS v")
    series = S.Series(frame, "k", "t")
    for found in (S.gather(series, [2, 0]), S.reshape(series, "v", 2, 3)):
        assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()


def test_one_long_sequence_uses_several_tasks(spark):
    frame = S.sequence(spark.createDataFrame([(0.0, 3_000_000.0)], "a double, b double"), "a", "b")
    pieces = frame.selectExpr("spark_partition_id() AS p").distinct().count()
    assert pieces > 1 and frame.count() == 3_000_001


def test_chained_values_of_a_cut_series_cost_no_more_each(spark):
    frame = spark.range(400).selectExpr("id % 2 AS k", "id AS t", "CAST(id % 7 AS DOUBLE) AS v")
    series = S.Series(frame, "k", "t", segment_rows=16)
    assert series.split
    for name in ("one", "two", "three"):
        series = series.add(**{name: S.running_sum(F.lit(1.0) if name == "one" else "v")})
    plan = series.rows()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    found = {r.t: r for r in series.rows().collect()}
    for k in (0, 1):
        total = 0.0
        for n, t in enumerate(range(k, 400, 2), 1):
            total += t % 7
            assert (found[t].one, found[t].two, found[t].three) == (n, total, total)


def wild(kind, n=600):
    """Doubles of very different sizes, so that every order of adding them rounds differently."""
    rng = random.Random(kind)
    if kind == "prices":
        return [round(rng.uniform(-100, 100), 2) for _ in range(n)]
    if kind == "sizes":
        return [rng.choice([-1, 1]) * math.ldexp(rng.random(), rng.randint(-1100, 1000)) for _ in range(n)]
    if kind == "cancel":
        held = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-20, 20) for _ in range(n // 2)]
        return rng.sample(held + [-x for x in held], n // 2 * 2)
    edge = [5e-324, -5e-324, 2.0**-1022, 1.5e308, -1.5e308, 0.0, -0.0, 1.0, 1e16, -1.0, None]
    return [rng.choice(edge) for _ in range(n)]


@pytest.mark.parametrize("kind", ["prices", "sizes", "cancel", "edge"])
def test_sums_have_the_same_bits_for_any_cuts(spark, kind):
    from fractions import Fraction

    held = wild(kind)
    rows = [("hot" if i % 3 else None, i, x) for i, x in enumerate(held)]
    frame = spark.createDataFrame(rows, "k string, b int, x double").repartition(5)
    seen = set()
    for size in (10_000, 37):
        for key in ([], ["k"]):
            found = by_b(S.scan(S.Series(frame, key, ["b"], segment_rows=size), "x"), "scan")
            seen.add((len(key), tuple(repr(found[i][0]) for i in range(len(rows)))))
    assert len(seen) == 2
    # The exact sum, rounded: within the last bit of it.
    whole = dict(seen)[0]
    total, any_yet = Fraction(0), False
    for (_, i, x), text in zip(rows, whole):
        if x is not None:
            total, any_yet = total + Fraction(x), True
        if not any_yet:
            assert text == "None"
        elif abs(total) < Fraction(1.7e308):
            want = total.numerator / total.denominator
            assert abs(Fraction(float(text)) - total) <= Fraction(math.ulp(want)), (i, text, want)
    held = S.pnl(S.Series(frame.withColumn("c", F.lit(1.0)), ["k"], ["b"], segment_rows=16), "c", "c", "x")
    plain = S.pnl(S.Series(frame.withColumn("c", F.lit(1.0)), ["k"], ["b"]), "c", "c", "x")
    bits = lambda f: {k: tuple(map(repr, v)) for k, v in by_b(f, "position", "value", "amount").items()}
    assert bits(held) == bits(plain)


def test_sums_of_what_is_not_finite(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, 1.0), (1, inf), (2, None), (3, 5.0), (4, -inf), (5, 2.0)]
    for size in (1000, 2):
        found = by_b(S.scan(S.Series(spark.createDataFrame(rows, "b int, x double"), [], ["b"], segment_rows=size), "x"), "scan")
        assert [found[i][0] for i in range(4)] == [1.0, inf, inf, inf] and all(math.isnan(found[i][0]) for i in (4, 5))
    none = spark.createDataFrame([], "b int, x double")
    assert S.scan(S.Series(none, [], ["b"]), "x").count() == 0
    zeros = spark.createDataFrame([(0, 0.0), (1, None), (2, -0.0)], "b int, x double")
    assert by_b(S.scan(S.Series(zeros, [], ["b"]), "x"), "scan") == {0: (0.0,), 1: (0.0,), 2: (0.0,)}


def test_rows_by_position(spark, frame, data):
    """Positions of a table, from both ends, repeated, beyond the end; only folders that are asked for are read."""
    from tidegrid.operators import positions as P

    for key in (["k"], []):
        groups = {}
        for row in sorted(data, key=lambda r: (r[1], r[2])):
            groups.setdefault(row[0] if key else None, []).append(row)
        held = P.index(S.Series(frame, key, ["a", "b"], segment_rows=100), size=50)
        asked = [(k, p, i) for i, (k, p) in enumerate(itertools.product(list(groups)[:4] + [None, "missing"], [0, 7, 7, -1, -3, 49, 50, 5000, -5000, None]))]
        asked = asked if key else [a for a in asked if a[0] is None]
        kinds = "k string, p long, i int" if key else "k_ string, p long, i int"
        found = P.gather(held, spark.createDataFrame(asked, kinds), "p").select("i", "p", "b").collect()
        inside = lambda k, p: p is not None and k in groups and -len(groups[k]) <= p < len(groups[k])
        assert sorted(map(tuple, found)) == sorted((i, p, groups[k][p][2]) for k, p, i in asked if inside(k, p))
        for n in (0, 1, 60, -1, -60, 5000, -5000):
            first = lambda rows: rows[:n] if n >= 0 else rows[n:]
            kept = {r[2] for rows in groups.values() for r in first(rows)}
            assert {r.b for r in P.take(held, n).collect()} == kept
            assert {r.b for r in P.drop(held, n).collect()} == {r[2] for r in data} - kept
    few = P.gather(held, spark.createDataFrame([("x", 3, 1), ("x", 120, 2)], "k_ string, p long, i int"), "p")
    few.collect()
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "_segment" in plan.split("PartitionFilters: [")[1].split("]")[0]
    none = P.index(S.Series(spark.createDataFrame([], "k string, a int, b int"), "k", ["a", "b"]), size=5)
    assert P.take(none, -3).count() == 0 and P.gather(none, spark.createDataFrame([("a", 1)], "k string, p long"), "p").count() == 0
