"""Timestamp parsing as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Access-log stamp: day (1-2 digits) / English month abbreviation / year :
# time, then a UTC offset written as -0800, +03:00 or Z.
ACCESS_TS_FORMATS = ("d/MMM/yyyy:HH:mm:ss XX", "d/MMM/yyyy:HH:mm:ss XXX")
# HDFS stamp after the century is put in front: yyyy MM dd HH mm ss.
HDFS_TS_FORMAT = "yyyyMMddHHmmss"
# Two-digit years from 69 on belong to the 1900s, the rest to the 2000s.
CENTURY_PIVOT = "69"
# ---------------------------------------------------------------------------


def access_timestamp(stamp: Column) -> Column:
    """``07/Mar/2004:16:05:49 -0800`` -> instant; NULL when not a valid stamp with an offset."""
    return F.coalesce(*[F.try_to_timestamp(stamp, F.lit(f)) for f in ACCESS_TS_FORMATS])


def hdfs_timestamp(yymmdd: Column, hhmmss: Column) -> Column:
    """Compact ``081109`` + ``203518`` -> timestamp in the session zone.

    Spark's ``yy`` maps every two-digit year into 2000-2099, so the century
    is chosen explicitly before parsing a four-digit year.
    """
    century = F.when(F.substring(yymmdd, 1, 2) >= F.lit(CENTURY_PIVOT), F.lit("19")) \
               .otherwise(F.lit("20"))
    return F.try_to_timestamp(F.concat(century, yymmdd, hhmmss), F.lit(HDFS_TS_FORMAT))


def day_of(ts: Column) -> Column:
    """``ts::date`` in the session zone."""
    return F.to_date(ts)


def as_wall_clock(ts: Column) -> Column:
    """Instant -> wall-clock timestamp (NTZ) in the session zone."""
    return ts.cast("timestamp_ntz")


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text with or without fraction and offset; NULL when not a timestamp.

    Without an offset it is wall-clock time of the session zone."""
    return text.try_cast("timestamp")
