"""Epoch seconds, local times and network time stamps."""

from pyspark.sql import functions as F

# Fixed value: seconds from 1900-01-01 to 1970-01-01.
NTP_OFFSET = 2208988800
EPOCH = "1970-01-01 00:00:00"


def mktime(local, zone):
    """Epoch seconds of a local date and time in a time zone."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col(local) if isinstance(local, str) else local)
    return F.timestamp_diff("SECOND", F.lit(EPOCH).cast("timestamp_ntz"), utc.cast("timestamp_ntz"))


def localtime(seconds, zone):
    """Local date and time, in a time zone, of epoch seconds."""
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    utc = F.timestamp_add("SECOND", seconds, F.lit(EPOCH).cast("timestamp_ntz"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def ntp_to_timestamp(seconds, fraction):
    """Time of a network time stamp: seconds since 1900 and 1/2^32 parts."""
    seconds, fraction = (F.col(c) if isinstance(c, str) else c for c in (seconds, fraction))
    micros = F.round(fraction / F.lit(2.0**32) * 1000000).cast("long")
    return F.timestamp_micros((seconds - NTP_OFFSET) * 1000000 + micros)


def timestamp_to_ntp(at):
    """Network time stamp, as a struct of seconds and fraction, of a time."""
    micros = F.unix_micros(F.col(at) if isinstance(at, str) else at)
    part = F.pmod(micros, F.lit(1000000))
    fraction = F.round(part / F.lit(1e6) * F.lit(2.0**32)).cast("long")
    return F.struct(
        (F.floor((micros - part) / 1000000) + NTP_OFFSET).cast("long").alias("seconds"), fraction.alias("fraction")
    )
