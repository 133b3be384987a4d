"""Date parts of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


PARTS = {"year": F.year, "quarter": F.quarter, "month": F.month, "week": F.weekofyear, "day": F.dayofmonth, "hour": F.hour}


def add_date_parts(df: DataFrame, ts: Column, stamp: str, day: str, parts: dict[str, str]) -> DataFrame:
    """Add the timestamp as ``stamp``, its date as text as ``day``, and parts by name of the new column.

    Later columns are made from earlier ones: parts of the time from the stamp, those of the
    date from its text.
    """
    result = df.withColumn(stamp, ts).withColumn(day, F.date_format(stamp, "yyyy-MM-dd"))
    for name, part in parts.items():
        result = result.withColumn(name, PARTS[part](F.col(stamp) if part == "hour" else F.to_date(day)))
    return result


def as_date(ts: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """The date of a timestamp, as a date (not text)."""
    return F.to_date(ts, pattern)


def weekday_from_monday(ts: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(ts) + 1


def in_month(ts: Column, month: int, years: range | None = None) -> Column:
    """Rows of one month.

    A test on a function of the column cannot be pushed into the scan. Where the years
    are known, give them: the result is the same and parquet row groups are skipped.
    """
    if years is None:
        return F.month(ts) == month
    test = F.lit(False)
    for year in years:
        after = f"{year + month // 12}-{month % 12 + 1:02d}-01"
        start, end = F.lit(f"{year}-{month:02d}-01"), F.lit(after)
        test = test | ((ts >= start.cast("timestamp_ntz")) & (ts < end.cast("timestamp_ntz")))
    return test
