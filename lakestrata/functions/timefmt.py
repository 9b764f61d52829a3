"""Time parsing and the text formats the reports emit (FN4-FN9, PRJ11).

All of these are built-in Column expressions, so they stay inside whole-stage codegen. Buckets are
computed on real timestamps (``date_trunc``) and turned into text last, so sorting and min/max can
work on the timestamp and stay right across years.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed output formats of the reports.
HOUR_FORMAT = "MM/dd/yyyy HH:00:00"
DAY_FORMAT = "MM/dd/yyyy"
SECOND_FORMAT = "MM/dd/yyyy HH:mm:ss"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DAY_KEY_FORMAT = "yyyy-MM-dd"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c: str | Column) -> Column:
    """ISO-8601 text such as ``2017-01-01T00:10:00Z`` → TIMESTAMP (session zone UTC).

    A malformed value becomes null instead of failing the whole job (ANSI ``to_timestamp`` would
    raise on the first bad record of a month).
    """
    return F.try_to_timestamp(_col(c))


def hour_bucket(ts: str | Column) -> Column:
    return F.date_trunc("hour", _col(ts))


def day_bucket(ts: str | Column) -> Column:
    return F.date_trunc("day", _col(ts))


def hour_text(ts: str | Column) -> Column:
    """``MM/dd/yyyy HH:00:00`` for the hour holding ``ts``."""
    return F.date_format(_col(ts), HOUR_FORMAT)


def day_text(ts: str | Column) -> Column:
    return F.date_format(_col(ts), DAY_FORMAT)


def second_text(ts: str | Column) -> Column:
    return F.date_format(_col(ts), SECOND_FORMAT)


def iso_text(ts: str | Column) -> Column:
    return F.date_format(_col(ts), ISO_FORMAT)


def us_week_of_year(d: str | Column) -> Column:
    """US calendar week number of a date, as text (no year).

    Weeks start on Sunday and the week holding 1 January is week 1, so the last days of December
    can already belong to week 1 of the next year. This is what the legacy ``'w'`` pattern printed;
    it is computed here from built-ins so no legacy parser mode is needed.
    """
    d = F.to_date(_col(d))
    jan1 = F.trunc(d, "year")
    next_jan1 = F.add_months(jan1, 12)
    # dayofweek: 1 = Sunday … 7 = Saturday.
    in_next_years_first_week = F.datediff(next_jan1, d) <= F.dayofweek(next_jan1) - 1
    week = F.floor((F.dayofyear(d) + F.dayofweek(jan1) - 2) / 7) + 1
    return F.when(d.isNull(), F.lit(None)).when(in_next_years_first_week, F.lit(1)).otherwise(week).cast("string")


def add_day(df: DataFrame, date_col: str, name: str = "day") -> DataFrame:
    """Add the partition key ``day`` (``yyyy-MM-dd`` text) from an ISO string or a timestamp/date."""
    dtype = df.schema[date_col].dataType
    if isinstance(dtype, T.StringType):
        day = F.col(date_col).substr(1, 10)
    else:
        day = F.date_format(F.col(date_col), DAY_KEY_FORMAT)
    return df.withColumn(name, day)
