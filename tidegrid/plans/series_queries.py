"""Queries on ordered series."""

from pyspark.sql import functions as F

from tidegrid.operators import positions as P
from tidegrid.operators import series as S
from tidegrid.plans.inputs import EVENT_ORDER, TRADE_ORDER, table, trades, user_values
from tidegrid.plans.registry import ORACLES, query

TRADES = """
SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber,
       l_extendedprice / l_quantity AS x, l_discount * 10 AS c,
       CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS g
FROM lineitem"""


# Cuts every sixteenth row, so that small tables take the path of long series.
CUT = {"segment_rows": 16}


def _trades(spark, folder, **options):
    rows = trades(spark, folder)
    return S.Series(rows, "l_partkey", TRADE_ORDER, **options)


def _values(spark, folder, **options):
    return S.Series(user_values(spark, folder), "user_id", EVENT_ORDER, **options)


def _orders(spark, folder, **options):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return S.Series(orders, "o_custkey", ["o_orderdate", "o_orderkey"], **options)


@query(f"""
WITH t AS ({TRADES}), p AS (
  SELECT *, coalesce(sum(g) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS position,
         row_number() OVER w AS n
  FROM t WINDOW w AS (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber))
SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber, position,
       (position + g) * x + CASE WHEN n = 1 THEN 1000.0::DOUBLE ELSE 0 END AS value, position * c - g * x AS amount
FROM p""")
def pnl(spark, folder, **options):
    result = S.pnl(_trades(spark, folder, **options), "x", "c", "g", initial=1000.0)
    return result.select("l_partkey", *TRADE_ORDER, "position", "value", "amount")


@query("""
SELECT user_id, event_id, coalesce(value - lag(value) OVER w, value) AS diff FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def series_diff(spark, folder, **options):
    return S.diff(_values(spark, folder, **options), "value").select("user_id", "event_id", "diff")


@query("""
SELECT user_id, event_id, CASE WHEN row_number() OVER w = 1 THEN value ELSE value / nullif(lag(value) OVER w, 0) END AS ratio
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def series_diff_ratio(spark, folder):
    return S.diff(_values(spark, folder), "value", "/", "ratio").select("user_id", "event_id", "ratio")


@query("""
SELECT user_id, event_id, round(sum(value) OVER w, 4) AS running FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def series_scan(spark, folder):
    result = S.scan(_values(spark, folder), "value", "+", "running")
    return result.select("user_id", "event_id", F.round("running", 4).alias("running"))


@query("""
SELECT user_id, event_id, round(product(1 + value / 10000) OVER w, 8) AS running FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def series_scan_product(spark, folder):
    grown = user_values(spark, folder).withColumn("growth", 1 + F.col("value") / 10000)
    result = S.scan(S.Series(grown, "user_id", EVENT_ORDER), "growth", "*", "running")
    return result.select("user_id", "event_id", F.round("running", 8).alias("running"))


@query("""
SELECT event_id, round(sum(value) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 4) AS running FROM events""")
def series_scan_global(spark, folder):
    whole = S.Series(user_values(spark, folder), [], EVENT_ORDER, segment_rows=4096)
    return S.scan(whole, "value", "+", "running").select("event_id", F.round("running", 4).alias("running"))


@query("""
SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber,
       round(product(1 + l_discount) OVER w, 6) AS discounts, round(product(1 + l_tax) OVER w, 6) AS taxes
FROM lineitem
WINDOW w AS (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber ROWS UNBOUNDED PRECEDING)""")
def series_cumprod(spark, folder, **options):
    rows = table(spark, folder, "lineitem").select(
        "l_partkey", *TRADE_ORDER, (1 + F.col("l_discount")).alias("d"), (1 + F.col("l_tax")).alias("t")
    )
    result = S.cumprod(S.Series(rows, "l_partkey", TRADE_ORDER, **options), ["d", "t"])
    return result.select(
        "l_partkey", *TRADE_ORDER, F.round("d_cumprod", 6).alias("discounts"), F.round("t_cumprod", 6).alias("taxes")
    )


@query("""
WITH n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders)
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM n WHERE r <= 3""")
def take_rows(spark, folder):
    return S.take(_orders(spark, folder), 3)


@query("""
WITH n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM n WHERE r <= 2""")
def take_rows_back(spark, folder):
    return S.take(_orders(spark, folder), -2)


@query("""
WITH n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders)
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM n WHERE r > 3""")
def drop_rows(spark, folder):
    return S.drop(_orders(spark, folder), 3)


@query("""
WITH n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM n WHERE r > 2""")
def drop_rows_back(spark, folder, **options):
    return S.drop(_orders(spark, folder, **options), -2)


@query("""
WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS r FROM events),
     l AS (SELECT * FROM (VALUES (0::BIGINT, 3), (1, 0), (2, 3), (3, 40)) v(out_pos, r))
SELECT user_id, out_pos, event_id, value FROM n JOIN l USING (r)""")
def gather(spark, folder):
    return S.gather(_values(spark, folder), [3, 0, 3, 40], ["event_id", "value"])


# Folders of few positions, so that small tables have several.
FEW = 4


@query("""
WITH n AS (SELECT *, row_number() OVER w - 1 AS r, count(*) OVER (PARTITION BY user_id) AS c FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
l AS (SELECT DISTINCT user_id, unnest([0, user_id % 5, -1, -1, 1000000]) AS position, unnest(['first', 'some', 'last', 'again', 'none']) AS asked FROM events)
SELECT l.user_id, l.position::BIGINT AS position, asked, event_id, value FROM l JOIN n
ON n.user_id = l.user_id AND n.r = CASE WHEN l.position < 0 THEN c + l.position ELSE l.position END""")
def gather_table(spark, folder):
    users = table(spark, folder, "events").select("user_id").distinct()
    wanted = F.array(*[F.struct(F.lit(n).alias("asked"), p.cast("long").alias("position")) for n, p in (
        ("first", F.lit(0)), ("some", F.col("user_id") % 5), ("last", F.lit(-1)), ("again", F.lit(-1)), ("none", F.lit(1000000)))])
    found = P.gather(P.index(_values(spark, folder), size=FEW), users.select("user_id", F.inline(wanted)))
    return found.select("user_id", "position", "asked", "event_id", "value")


@query(ORACLES["take_rows"])
def take_rows_indexed(spark, folder):
    return P.take(P.index(_orders(spark, folder), size=FEW), 3)


@query(ORACLES["drop_rows_back"])
def drop_rows_indexed(spark, folder):
    return P.drop(P.index(_orders(spark, folder), size=FEW), -2)


@query("""
WITH n AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS r FROM events),
     g AS (SELECT DISTINCT user_id, unnest(range(4)) AS grid_row FROM events)
SELECT g.user_id, g.grid_row, max(value) FILTER (r % 7 = 0) AS c0, max(value) FILTER (r % 7 = 1) AS c1,
       max(value) FILTER (r % 7 = 2) AS c2, max(value) FILTER (r % 7 = 3) AS c3, max(value) FILTER (r % 7 = 4) AS c4,
       max(value) FILTER (r % 7 = 5) AS c5, max(value) FILTER (r % 7 = 6) AS c6
FROM g LEFT JOIN n ON g.user_id = n.user_id AND g.grid_row = n.r // 7 GROUP BY ALL""")
def reshape(spark, folder):
    return S.reshape(_values(spark, folder), "value", rows=4, columns=7)


@query("""SELECT user_id, max(value) AS series_max FROM events GROUP BY user_id""")
def series_max(spark, folder):
    return S.series_max(user_values(spark, folder), "user_id", "value")


@query("""SELECT event_id, user_id, max(value) OVER (PARTITION BY user_id) - value AS reflected FROM events""")
def reflect_y(spark, folder):
    rows = user_values(spark, folder).select("event_id", "user_id", "value")
    return S.reflect(rows, "user_id", "value").drop("value")


@query("""
WITH p AS (SELECT p_partkey, p_size::DOUBLE AS a, (p_partkey % 20)::DOUBLE AS b FROM part)
SELECT p_partkey, n, a + n * CASE WHEN a > b THEN -0.5::DOUBLE ELSE 0.5 END AS value
FROM (SELECT *, unnest(range(0, 1 + floor(abs(b - a) / 0.5)::BIGINT)) AS n FROM p)""")
def sequence(spark, folder):
    bounds = table(spark, folder, "part").select("p_partkey", "p_size", (F.col("p_partkey") % 20).alias("stop"))
    return S.sequence(bounds, "p_size", "stop", F.lit(0.5)).select("p_partkey", "n", "value")


@query("""
WITH p AS (SELECT p_partkey, p_size::DOUBLE AS a, p_retailprice AS b, 2 + p_partkey % 5 AS k FROM part)
SELECT p_partkey, n, a + n * ((b - a) / (k - 1)) AS value FROM (SELECT *, unnest(range(0, k)) AS n FROM p)""")
def sequence_points(spark, folder):
    bounds = table(spark, folder, "part").select(
        "p_partkey", "p_size", "p_retailprice", (2 + F.col("p_partkey") % 5).alias("points")
    )
    return S.sequence(bounds, "p_size", "p_retailprice", "points").select("p_partkey", "n", "value")


@query(ORACLES["pnl"])
def pnl_split(spark, folder):
    return pnl(spark, folder, **CUT)


@query(ORACLES["series_diff"])
def series_diff_split(spark, folder):
    return series_diff(spark, folder, **CUT)


@query(ORACLES["series_cumprod"])
def series_cumprod_split(spark, folder):
    return series_cumprod(spark, folder, **CUT)


@query(ORACLES["drop_rows_back"])
def drop_rows_back_split(spark, folder):
    return drop_rows_back(spark, folder, **CUT)
