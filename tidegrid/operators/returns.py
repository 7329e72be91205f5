"""Daily prices: cleaning, overnight and intraday returns, cumulated returns.

A bar table has `symbol, date, open, high, low, close, adj_close, volume`.
"""

import datetime

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.operators.series import Series, position, previous, running_product, running_sum

PRICES = ["open", "high", "low", "close"]
FIRST_DATE = datetime.date(2021, 1, 1)
LAST_DATE = datetime.date(2021, 5, 31)


def join_reference(bars, instruments):
    """Attach name, country, start and end date and bad dates of each symbol."""
    return bars.join(instruments, "symbol", "left")


def exclude_dates(bars, instruments):
    """Drop the bars on dates that are listed as bad for their symbol."""
    bad = instruments.select("symbol", F.explode("bad_data_dates").alias("date")).distinct()
    return bars.join(bad, ["symbol", "date"], "left_anti")


def drop_null_rows(bars):
    """Drop bars in which any field is missing."""
    return bars.dropna(subset=[*PRICES, "adj_close", "volume"])


def distinct_prices():
    """How many different values open, high, low and close take."""
    return F.size(F.array_distinct(F.array(*PRICES))).cast("long")


def drop_flat_rows(bars):
    """Drop bars with open = high = low = close."""
    return bars.where(distinct_prices() > 1)


def clip_valid_range(bars, first_date=FIRST_DATE, last_date=LAST_DATE, **series_options):
    """Keep each symbol from its first usable date to its end date.

    A symbol starts at the later of its start date and the first bar whose open
    differs from its close. `start_date` and `end_date` columns, where present,
    override the defaults.
    """
    return _clip(_by_date(bars, series_options), first_date, last_date).rows()


def clean_bars(bars, instruments, first_date=FIRST_DATE, last_date=LAST_DATE, **series_options):
    """All cleaning steps, in order."""
    return _clip(_by_date(_usable(bars, instruments), series_options), first_date, last_date).rows()


def overnight_intraday_returns(bars, **series_options):
    """Intraday, close-to-close and overnight return of every bar.

    The first bar of a symbol has no close-to-close and no overnight return.
    A zero price gives a null return.
    """
    return _returns(_by_date(bars, series_options)).rows()


def cumulative_returns(bars, **series_options):
    """Cumulated intraday and overnight return by date.

    Intraday returns count from the first bar and overnight returns from the
    second; the first bar of each symbol is not part of the result. From a
    missing return on, the cumulated one is missing too.
    """
    return _cumulate(_returns(_by_date(bars, series_options)))


def returns_from_raw_bars(bars, instruments, first_date=FIRST_DATE, last_date=LAST_DATE, **series_options):
    """Cleaning, returns and cumulation in one go, with one shuffle by symbol."""
    series = _by_date(_usable(bars, instruments), series_options)
    return _cumulate(_returns(_clip(series, first_date, last_date)))


def _usable(bars, instruments):
    return drop_flat_rows(drop_null_rows(join_reference(exclude_dates(bars, instruments), instruments)))


def _by_date(bars, options):
    return Series(bars, "symbol", "date", **options)


def _clip(series, first_date, last_date):
    known = series.frame.columns
    start, end = (
        F.coalesce(F.col(own), F.lit(default)) if own in known else F.lit(default)
        for own, default in (("start_date", first_date), ("end_date", last_date))
    )
    # On or after the first such bar: at least one such bar up to here.
    moved = series.add(_moved=running_sum((F.col("open") != F.col("close")).cast("int")))
    usable = (F.col("_moved") > 0) & (F.col("date") >= start) & (F.col("date") <= end)
    return moved.where(usable).drop("_moved")


def _returns(series):
    dated = series.add(_adj_before=previous("adj_close"), bar_no=position())
    intraday = F.try_divide(F.col("close"), F.col("open")) - 1
    step = F.try_divide(F.col("adj_close"), F.col("_adj_before")) - 1
    simple = dated.with_columns({"intraday": intraday, "close_to_close": step})
    overnight = F.try_divide(1 + F.col("close_to_close"), 1 + F.col("intraday")) - 1
    return simple.with_columns({"overnight": overnight}).drop("_adj_before")


def _cumulate(returns):
    later = F.col("bar_no") > 0
    cumulated = returns.add(
        _intraday=running_product(1 + F.col("intraday")),
        _overnight=running_product(1 + F.col("overnight")),
        _no_intraday=running_sum(F.col("intraday").isNull().cast("int")),
        _no_overnight=running_sum((F.col("overnight").isNull() & later).cast("int")),
    )
    return cumulated.rows().where(later).select(
        "symbol",
        "date",
        F.when(F.col("_no_intraday") == 0, F.col("_intraday") - 1).alias("cum_intraday"),
        F.when(F.col("_no_overnight") == 0, F.col("_overnight") - 1).alias("cum_overnight"),
    )


def final_returns(cumulative):
    """The last cumulated returns of each symbol, as numbers and as labels."""
    last = cumulative.groupBy("symbol").agg(
        F.max("date").alias("last_date"),
        F.max_by("cum_overnight", "date").alias("overnight"),
        F.max_by("cum_intraday", "date").alias("intraday"),
    )
    return last.withColumns(
        {
            "overnight_label": format_return(F.col("overnight") * 100),
            "intraday_label": format_return(F.col("intraday") * 100),
        }
    )


@F.pandas_udf(T.StringType())
def format_return(percent: pd.Series) -> pd.Series:
    """A percentage as a label: `-99.88%`, `+0.2%`, `+3333%`, `+333,333%`.

    Spark's own number formats round exact halves away from zero, which gives
    other digits, so labels are made by Python, after aggregation.
    """
    return percent.map(_label, na_action="ignore").astype("object")


def _label(percent):
    if percent != percent:
        return None
    if percent >= 2e4:
        return f"+{percent:,.0f}%"
    digits = 2 if percent < -99 else 1 if -1 < percent < 1 else 0
    return f"{percent:+.{digits}f}%"
