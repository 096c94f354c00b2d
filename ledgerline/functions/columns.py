"""Column expressions shared by the reports. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(day: Column) -> Column:
    """First day of the month."""
    return F.trunc(day, "MM")


def years_apart(later: Column, earlier: Column) -> Column:
    """Calendar-year boundaries crossed: 2023-12-31 to 2024-01-01 is one year."""
    return (F.year(later) - F.year(earlier)).cast("bigint")


def safe_ratio(num: Column, den: Column) -> Column:
    """Division in double, NULL when the divisor is zero or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def round_ratio(num: Column, den: Column, digits: int) -> Column:
    """``num / den`` rounded half away from zero, computed on integers.

    Both inputs are whole numbers (money goes in as pence). Nothing passes through a
    double, so a result that ends exactly in a half rounds the same way everywhere.
    NULL when the divisor is zero or NULL.
    """
    n = num.cast("decimal(38,0)") * F.lit(10**digits).cast("decimal(10,0)")
    d = F.nullif(den.cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    two = F.lit(2).cast("decimal(1,0)")
    magnitude = F.call_function("div", two * F.abs(n) + F.abs(d), two * F.abs(d))
    signed = magnitude * (F.signum(n) * F.signum(d)).cast("bigint")
    return (signed.cast("decimal(28,0)") * F.lit(f"1e-{digits}").cast(f"decimal({digits + 1},{digits})")
            ).cast(f"decimal(38,{digits})")


def mean_of(value: Column) -> Column:
    """Average of a decimal as ``exact sum / count``.

    The sum is exact, so the answer does not depend on how rows were partitioned.
    """
    return safe_ratio(F.sum(value), F.count(value))


def first_match(rules: Iterable[tuple[Column, object]], otherwise: object) -> Column:
    """Ordered rules; the first true condition gives the value."""
    out: Column | None = None
    for condition, value in rules:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def hash_bucket(key: Column, buckets: int) -> Column:
    """Reproducible bucket in ``[0, buckets)`` from the first 60 bits of an MD5.

    MD5 rather than the engine's own hash, so any other system gets the same bucket.
    """
    head = F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10)
    return F.pmod(head.cast("bigint"), F.lit(buckets).cast("bigint"))


def distinct_months(day: Column) -> Column:
    """Number of different calendar months of ``day``.

    Gathers the months themselves: a group has at most as many as the calendar, however
    many rows it has. ``count_distinct`` would make Spark copy every row once more when the
    same aggregation counts another column too.
    """
    return F.size(F.collect_set(month_of(day))).cast("bigint")


def square_sums(money: Column) -> list[Column]:
    """What :func:`deviation_of_sums` needs of each group of a first grouping, besides its sum and count."""
    return [
        F.try_sum(money * money).alias("squares"), F.sum(money.cast("double") * money.cast("double")).alias("rough_squares"),
        F.min(money).alias("least"), F.max(money).alias("greatest"),
    ]


def deviation_of_sums(n: Column, total: Column) -> Column:
    """Sample deviation of a ``decimal(18,2)`` from the sums of a first grouping; NULL for fewer than two values.

    The squares are summed exactly, so nothing cancels. Only where they may not fit 38 digits
    (the greatest value times the count reaches 1e17) are they summed in double.
    """
    least, greatest = F.min("least"), F.max("greatest")
    count = n.cast("double")
    fits = F.greatest(F.abs(least), F.abs(greatest)).cast("double") * count < 1e17
    exact = (n.cast("decimal(20,0)") * F.try_sum("squares") - total * total).cast("double") / (count * (count - 1))
    rough = F.greatest(F.sum("rough_squares") - total.cast("double") * total.cast("double") / count, F.lit(0.0)) / (count - 1)
    return F.when(n < 2, None).when(least == greatest, 0.0).when(fits, F.sqrt(exact)).otherwise(F.sqrt(rough))
