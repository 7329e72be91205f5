"""Queries on daily prices."""

import datetime

from pyspark.sql import functions as F

from tidegrid.operators import returns as R
from tidegrid.operators.tables import patch_source as patch
from tidegrid.plans.inputs import bars_with_gaps, daily_bars, instruments, table
from tidegrid.plans.registry import ORACLES, query
from tidegrid.session import scratch_path
from tidegrid.sources import prices as P
from tidegrid.sources.requests import eod_request_urls as eod_urls
from tidegrid.sources.requests import yahoo_request_urls as yahoo_urls

FIRST, LAST = datetime.date(2024, 1, 2), datetime.date(2024, 1, 29)

BARS = """
  p AS (SELECT 'S' || user_id AS symbol, ts::DATE AS date, ts, 100 + value / 100 AS p FROM events),
  bars AS (SELECT symbol, date, arg_min(p, ts) AS open, max(p) AS high, min(p) AS low,
                  arg_max(p, ts) AS close, arg_max(p, ts) AS adj_close, count(*) AS volume
           FROM p GROUP BY symbol, date),
  gaps AS (SELECT * REPLACE (CASE WHEN (substr(symbol, 2)::BIGINT + day(date)) % 17 <> 0 THEN adj_close END AS adj_close)
           FROM bars),
  dim AS (SELECT 'S' || n AS symbol, 'Instrument ' || n AS name, CASE WHEN n % 3 <> 0 THEN 'C' || (n % 3) END AS country,
                 CASE WHEN n % 2 = 0 THEN 'I' || n END AS short_name,
                 CASE WHEN n % 4 = 0 THEN DATE '2024-01-05' END AS start_date,
                 CASE WHEN n % 5 = 0 THEN DATE '2024-01-25' END AS end_date,
                 CASE WHEN n % 3 = 0 THEN [DATE '2024-01-10' + (n % 7)::INT, DATE '2024-01-10' + (n % 11)::INT] END AS bad
          FROM (SELECT DISTINCT user_id AS n FROM events)),
  baddays AS (SELECT DISTINCT symbol, unnest(bad) AS date FROM dim),
  kept AS (SELECT g.*, d.start_date, d.end_date FROM gaps g LEFT JOIN dim d USING (symbol)
           WHERE (g.symbol, g.date) NOT IN (SELECT (symbol, date) FROM baddays)
             AND adj_close IS NOT NULL AND NOT (open = high AND high = low AND low = close)),
  clean AS (SELECT *, min(CASE WHEN open <> close THEN date END) OVER (PARTITION BY symbol) AS since FROM kept
            QUALIFY date >= since AND date >= coalesce(start_date, DATE '2024-01-02')
                AND date <= coalesce(end_date, DATE '2024-01-29')),
  rets AS (SELECT symbol, date, close / open - 1 AS intraday,
                  adj_close / lag(adj_close) OVER w - 1 AS close_to_close, row_number() OVER w AS n FROM clean
           WINDOW w AS (PARTITION BY symbol ORDER BY date)),
  parts AS (SELECT *, (1 + close_to_close) / (1 + intraday) - 1 AS overnight FROM rets),
  cums AS (SELECT symbol, date, n, product(1 + intraday) OVER w - 1 AS cum_intraday,
                  product(1 + overnight) OVER w - 1 AS cum_overnight FROM parts
           WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)),
  cum AS (SELECT symbol, date, cum_intraday, cum_overnight FROM cums WHERE n > 1)"""


def _cleaned(spark, folder):
    few = table(spark, folder, "events")
    return R.clean_bars(bars_with_gaps(spark, folder), instruments(spark, folder), FIRST, LAST, bounded_by=few)


def _cumulated(spark, folder):
    few = table(spark, folder, "events")
    bars = bars_with_gaps(spark, folder)
    return R.returns_from_raw_bars(bars, instruments(spark, folder), FIRST, LAST, bounded_by=few)


def _rounded(frame, *columns, digits=8):
    # Adding zero makes a rounded negative zero a plain one.
    return frame.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


@query(f"WITH {BARS} SELECT symbol, date, open, high, low, close, adj_close, volume FROM gaps")
def read_prices(spark, folder):
    path = scratch_path(spark, "prices")
    P.write_prices(bars_with_gaps(spark, folder), path)
    return P.read_prices(spark, path, partitioned=True)


def _awkward_files(spark, folder):
    """Price files of which some have the header on the second line, an unreadable cell, or a short line."""
    path = scratch_path(spark, "awkward")
    n, day = F.expr("substr(symbol, 2)::BIGINT"), F.dayofmonth("date")
    price = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    cells = [F.col("date").cast("string"), *map(price, ["open", "high", "low"])]
    close = F.when((n % 5 == 1) & (day % 7 == 3), F.lit("oops")).otherwise(price("close"))
    short = (n % 5 == 2) & (day % 7 == 4)
    line = F.when(short, F.concat_ws(",", *cells)).otherwise(F.concat_ws(",", *cells, close, price("adj_close"), price("volume")))
    bars = bars_with_gaps(spark, folder).select("symbol", F.col("date").cast("string").alias("at"), line.alias("value"))
    symbols = bars.select("symbol").distinct()
    header = symbols.select("symbol", F.lit("0").alias("at"), F.lit(",".join(P.HEADER)).alias("value"))
    junk = symbols.where(n % 7 == 0).select("symbol", F.lit("").alias("at"), F.lit("junk").alias("value"))
    lines = bars.unionByName(header).unionByName(junk)
    P.write_lines(lines.repartition("symbol").sortWithinPartitions("symbol", "at").select("symbol", "value"), path)
    return path


_NUMBER, _DAY = "substr(symbol, 2)::BIGINT", "day(date)"
_ODD = f"({_NUMBER} % 5 = 1 AND {_DAY} % 7 = 3 OR {_NUMBER} % 5 = 2 AND {_DAY} % 7 = 4)"


@query(f"WITH {BARS} SELECT symbol, date, open, high, low, close, adj_close, volume FROM gaps WHERE {_NUMBER} % 7 <> 0 AND NOT {_ODD}")
def read_prices_checked(spark, folder):
    return P.read_prices(spark, _awkward_files(spark, folder), partitioned=True)


@query(f"""WITH {BARS}, held AS (SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date) + 1 AS line_no FROM gaps)
SELECT symbol, line_no::INT AS line_no, date::VARCHAR AS date FROM held WHERE {_NUMBER} % 7 <> 0 AND {_ODD}""")
def price_quarantine(spark, folder):
    held = P.price_quarantine(spark, _awkward_files(spark, folder), partitioned=True)
    return held.select("symbol", "line_no", F.substr("line", F.lit(1), F.lit(10)).alias("date"))


@query(f"WITH {BARS} SELECT DISTINCT symbol FROM gaps WHERE {_NUMBER} % 7 = 0")
def rejected_price_files(spark, folder):
    return P.rejected_price_files(spark, _awkward_files(spark, folder), partitioned=True).select("symbol")


@query(f"""WITH {BARS} SELECT symbol, date, round(cum_intraday, 8) + 0 AS cum_intraday,
round(cum_overnight, 8) + 0 AS cum_overnight FROM cum""")
def write_series(spark, folder):
    path = scratch_path(spark, "series")
    P.write_series(_cumulated(spark, folder), path)
    return _rounded(P.read_series(spark, path), "cum_intraday", "cum_overnight")


@query("""
SELECT * FROM supplier WHERE s_acctbal >= 0
UNION ALL SELECT s_suppkey, s_name || '*', s_nationkey, 0.0::DOUBLE FROM supplier WHERE s_acctbal < 0""")
def patch_source(spark, folder):
    base = table(spark, folder, "supplier")
    changed = base.where(F.col("s_acctbal") < 0).withColumns(
        {"s_name": F.concat("s_name", F.lit("*")), "s_acctbal": F.lit(0.0)}
    )
    return patch(base, changed, "s_suppkey")


@query(f"WITH {BARS} SELECT g.*, d.name, d.country, d.short_name, d.start_date, d.end_date FROM gaps g LEFT JOIN dim d USING (symbol)")
def join_reference(spark, folder):
    return R.join_reference(bars_with_gaps(spark, folder), instruments(spark, folder).drop("bad_data_dates"))


@query(f"WITH {BARS} SELECT * FROM gaps WHERE (symbol, date) NOT IN (SELECT (symbol, date) FROM baddays)")
def exclude_dates(spark, folder):
    return R.exclude_dates(bars_with_gaps(spark, folder), instruments(spark, folder))


@query(f"WITH {BARS} SELECT * FROM gaps WHERE adj_close IS NOT NULL")
def drop_null_rows(spark, folder):
    return R.drop_null_rows(bars_with_gaps(spark, folder))


@query(f"WITH {BARS} SELECT * FROM bars WHERE NOT (open = high AND high = low AND low = close)")
def drop_flat_rows(spark, folder):
    return R.drop_flat_rows(daily_bars(spark, folder))


@query(f"""WITH {BARS} SELECT symbol, date,
  len(list_distinct([open, high, low, close]))::BIGINT AS distinct_prices FROM bars""")
def distinct_prices(spark, folder):
    return daily_bars(spark, folder).select("symbol", "date", R.distinct_prices().alias("distinct_prices"))


@query(f"WITH {BARS} SELECT symbol, date, open, high, low, close, adj_close, volume FROM clean")
def clip_valid_range(spark, folder):
    return _cleaned(spark, folder).select("symbol", "date", "open", "high", "low", "close", "adj_close", "volume")


@query(f"""WITH {BARS} SELECT symbol, date, round(intraday, 8) + 0 AS intraday,
  round(close_to_close, 8) + 0 AS close_to_close, round(overnight, 8) + 0 AS overnight FROM parts""")
def overnight_intraday_returns(spark, folder):
    result = R.overnight_intraday_returns(_cleaned(spark, folder), bounded_by=table(spark, folder, "events"))
    wanted = ["intraday", "close_to_close", "overnight"]
    return _rounded(result, *wanted).select("symbol", "date", *wanted)


@query(f"""WITH {BARS} SELECT symbol, date, round(cum_intraday, 8) + 0 AS cum_intraday,
round(cum_overnight, 8) + 0 AS cum_overnight FROM cum""")
def cumulative_returns(spark, folder):
    few = table(spark, folder, "events")
    return _rounded(R.cumulative_returns(_cleaned(spark, folder), bounded_by=few), "cum_intraday", "cum_overnight")


@query(ORACLES["cumulative_returns"])
def cumulative_returns_split(spark, folder):
    """From the raw bars, as if series were long: every symbol is cut at each sixteenth bar."""
    bars = bars_with_gaps(spark, folder)
    found = R.returns_from_raw_bars(bars, instruments(spark, folder), FIRST, LAST, segment_rows=16)
    return _rounded(found, "cum_intraday", "cum_overnight")


LABEL = """CASE WHEN {0} >= 2e4 THEN '+' || format('{{:,.0f}}', {0}) || '%' WHEN {0} < -99 THEN printf('%+.2f%%', {0})
  WHEN {0} > -1 AND {0} < 1 THEN printf('%+.1f%%', {0}) ELSE printf('%+.0f%%', {0}) END"""


@query(f"""WITH {BARS}, f AS (SELECT symbol, max(date) AS last_date, arg_max(cum_overnight, date) AS o,
  arg_max(cum_intraday, date) AS i FROM cum GROUP BY symbol)
SELECT symbol, last_date, round(o, 8) + 0 AS overnight, round(i, 8) + 0 AS intraday,
  {LABEL.format('(o * 100)')} AS overnight_label, {LABEL.format('(i * 100)')} AS intraday_label FROM f""")
def final_returns(spark, folder):
    return _rounded(R.final_returns(_cumulated(spark, folder)), "overnight", "intraday")


@query(f"""WITH v AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal * 1000 WHEN c_custkey % 3 = 1
  THEN c_acctbal / 10000 ELSE -99 - c_acctbal / 10000 END AS percent FROM customer)
SELECT c_custkey, {LABEL.format('percent')} AS label FROM v""")
def format_return(spark, folder):
    kind, balance = F.col("c_custkey") % 3, F.col("c_acctbal")
    percent = (
        F.when(kind == 0, balance * 1000).when(kind == 1, balance / 10000).otherwise(-99 - balance / 10000)
    )
    return table(spark, folder, "customer").select("c_custkey", R.format_return(percent).alias("label"))


@query("""
SELECT p_partkey, 'https://query1.finance.yahoo.com/v7/finance/download/P' || p_partkey || '?period1=' ||
  (1609459200 + p_size * 86400) || '&period2=' || (1612137600 + p_size * 86400) || '&interval=1wk' AS request_url FROM part""")
def yahoo_request_urls(spark, folder):
    first, last = (F.lit(d).cast("timestamp_ntz") for d in ("2021-01-01", "2021-02-01"))
    symbols = table(spark, folder, "part").select(
        "p_partkey",
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"),
        F.timestamp_add("DAY", F.col("p_size"), first).alias("start"),
        F.timestamp_add("DAY", F.col("p_size"), last).alias("end"),
    )
    return yahoo_urls(symbols, "symbol", "start", "end", interval="1wk").select("p_partkey", "request_url")


@query("""
SELECT p_partkey, CASE WHEN p_size % 4 <> 3 THEN 'https://eodhistoricaldata.com/api/eod/P' || p_partkey ||
  '.US?api_token=demo&from=' || strftime(DATE '2021-01-01' + p_size, '%Y-%m-%d') || '&to=2021-06-30&period=' ||
  ['d', 'w', 'm'][1 + p_size % 4] || '&order=d' END AS request_url FROM part""")
def eod_request_urls(spark, folder):
    symbols = table(spark, folder, "part").select(
        "p_partkey",
        F.concat(F.lit("P"), F.col("p_partkey").cast("string"), F.lit(".US")).alias("symbol"),
        F.date_add(F.lit("2021-01-01").cast("date"), F.col("p_size")).alias("start"),
        F.element_at(F.array(*[F.lit(p) for p in ("d", "w", "m", "y")]), 1 + F.col("p_size") % 4).alias("period"),
    )
    last = F.lit("2021-06-30").cast("date")
    result = eod_urls(symbols, "symbol", "demo", "start", last, F.col("period"), descending=True)
    return result.select("p_partkey", "request_url")
