"""Calendar helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_label(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def trailing(date: Column, as_of: dt.date, days: int) -> Column:
    """Within ``[as_of - days, as_of]``, both ends included."""
    return date.between(F.lit(as_of - dt.timedelta(days=days)), F.lit(as_of))
