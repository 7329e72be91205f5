"""Request addresses of price vendors, for whole symbol tables."""

from pyspark.sql import functions as F

from tidegrid.functions.clock import mktime

# Addresses of the two vendors.
YAHOO_URL = "https://query1.finance.yahoo.com/v7/finance/download/"
EOD_URL = "https://eodhistoricaldata.com/api/eod/"
EOD_PERIODS = ["d", "w", "m"]


def yahoo_request_urls(frame, symbol, start, end=None, interval="1d", zone="UTC", history=False, out="request_url"):
    """Add the download address of each symbol.

    `start` and `end` are local times in `zone`; `end` defaults to now. With
    `history` the symbol is quoted and events are asked for.
    """
    begin = mktime(_column(start), zone)
    now = F.unix_timestamp(F.current_timestamp())
    until = now if end is None else F.coalesce(mktime(_column(end), zone), now)
    name = F.replace(F.url_encode(F.col(symbol)), F.lit("+"), F.lit("%20")) if history else F.col(symbol)
    parts = [F.lit(YAHOO_URL), name, F.lit("?period1="), begin, F.lit("&period2="), until]
    parts += [F.lit("&interval="), F.lit(interval)] + ([F.lit("&events=history")] if history else [])
    return frame.withColumn(out, F.concat(*[p.cast("string") for p in parts]))


def eod_request_urls(frame, symbol, token, start, end=None, period=None, descending=False, out="request_url"):
    """Add the end-of-day address of each symbol; a bad period gives null.

    `period` is a column or one of `d`, `w` and `m`. Rows with a null address
    are the quarantine.
    """
    parts = [F.lit(EOD_URL), F.col(symbol), F.lit("?api_token="), F.lit(token)]
    parts += [F.lit("&from="), F.date_format(_column(start), "yyyy-MM-dd")]
    if end is not None:
        parts.append(F.coalesce(F.concat(F.lit("&to="), F.date_format(_column(end), "yyyy-MM-dd")), F.lit("")))
    if period is not None:
        given = F.lit(period) if isinstance(period, str) else period
        known = F.when(given.isin(EOD_PERIODS), F.concat(F.lit("&period="), given))
        parts.append(F.when(given.isNull() | (given == ""), F.lit("")).otherwise(known))
    parts.append(F.lit("&order=" + ("d" if descending else "a")))
    return frame.withColumn(out, F.concat(*parts))


def _column(value):
    return F.col(value) if isinstance(value, str) else value
