"""Calendar arithmetic with boundary-count rules.

Differences count crossed boundaries (a year difference is the difference of
the calendar years), not elapsed units; hour differences compare timestamps
cut to the hour.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def diff_days(end, start) -> Column:
    return F.datediff(col(end).cast("date"), col(start).cast("date"))


def diff_years(end, start) -> Column:
    return F.year(col(end)) - F.year(col(start))


def diff_months(end, start) -> Column:
    return (diff_years(end, start)) * 12 + F.month(col(end)) - F.month(col(start))


def epoch_day(c) -> Column:
    return F.unix_date(col(c).cast("date"))


def epoch_hour(c) -> Column:
    return epoch_day(c) * 24 + F.hour(col(c))


def epoch_minute(c) -> Column:
    return epoch_hour(c) * 60 + F.minute(col(c))


def diff_hours(end, start) -> Column:
    return epoch_hour(end) - epoch_hour(start)


def diff_minutes(end, start) -> Column:
    return epoch_minute(end) - epoch_minute(start)


def end_of_day(c) -> Column:
    """23:59 of the calendar day of ``c``."""
    return col(c).cast("date").cast("timestamp_ntz") + F.expr("interval '23:59' hour to minute")


def band(value: Column, edges, labels, default=None) -> Column:
    """First label whose exclusive upper edge lies above ``value``."""
    out = None
    for edge, label in zip(edges, labels):
        hit = value < edge
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default)) if default is not None else out
