"""Dates known before the query runs.

Window limits are plain literals, so the scan can prune partitions by them.
"""

from __future__ import annotations

import calendar
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

#: months from a window's start that one long holds as bits
MASK_MONTHS = 63


def months_before(day: date, months: int) -> date:
    """The same day ``months`` earlier, or the last day of that month when it is shorter."""
    year, month0 = divmod(day.year * 12 + day.month - 1 - months, 12)
    last = calendar.monthrange(year, month0 + 1)[1]
    return date(year, month0 + 1, min(day.day, last))


def month_number(day: Column, start: date) -> Column:
    """Calendar months from the month of ``start`` to that of ``day``."""
    return (F.year(day) - start.year) * 12 + F.month(day) - start.month


def month_bit(number: Column) -> Column:
    """A long with the month's bit set; none for a month that doesn't fit. Groups merge it by ``bit_or``."""
    # the shift is by the low six bits only
    return F.when(number < MASK_MONTHS, F.call_function("shiftleft", F.lit(1).cast("bigint"), number)).otherwise(
        F.lit(0).cast("bigint"))
