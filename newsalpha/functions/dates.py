"""Date and time expressions on zone-free UTC timestamps."""

from pyspark.sql import Column
from pyspark.sql import functions as F

EASTERN = "America/New_York"


def utc_to_eastern(ts: Column) -> Column:
    """Local New York time with daylight saving, without a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(EASTERN), ts.cast("timestamp_ntz"))


def in_opening_window(local: Column) -> Column:
    """09:00:00 up to but not including 09:30:00 local time."""
    return (F.hour(local) == 9) & (F.minute(local) < 30)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def add_business_days(day: Column, n: int) -> Column:
    """Move by ``n`` weekdays (Monday to Friday).

    A weekend start counts from the following Monday when going back and from
    the preceding Friday when going forward, so that one step always lands on the
    nearest weekday in that direction.
    """
    if n == 0:
        return day
    weekday = F.weekday(day)  # Monday is 0
    if n > 0:
        start = F.date_sub(day, F.greatest(weekday - 4, F.lit(0)))
        position = F.least(weekday, F.lit(4))
        weekends = F.floor((position + n) / 5).cast("int")
        return F.date_add(start, F.lit(n) + 2 * weekends)
    start = F.date_add(day, F.when(weekday > 4, 7 - weekday).otherwise(0))
    position = F.when(weekday > 4, 0).otherwise(weekday)
    weekends = F.floor((F.lit(4) - position - n) / 5).cast("int")
    return F.date_sub(start, F.lit(-n) + 2 * weekends)


def months_before(day: Column, n: int = 1) -> Column:
    return F.add_months(day, -n)
