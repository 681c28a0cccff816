"""Ages counted in calendar years (SC-15) and the date ranges that say the same.

`year(as_of) - year(birth)` hides the column inside a function, so a scan cannot skip by it.
The conditions below compare the bare column with a constant date instead: they reach the
Parquet reader as pushed filters and drop row groups by their min/max.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

AsOf = datetime.date | None


def reference_day(as_of: AsOf) -> Column:
    """SC-16: today unless a day is given."""
    return F.current_date() if as_of is None else F.lit(as_of)


def fixed_day(spark: SparkSession, as_of: AsOf = None) -> datetime.date:
    """The reference day as a value, so that one run counts all ages from the same day."""
    return spark.range(1).select(reference_day(as_of)).first()[0]


def calendar_age(birth: Column, as_of: AsOf = None) -> Column:
    """New-year boundaries between birth and the reference day."""
    return F.year(reference_day(as_of)) - F.year(birth)


def _new_year(as_of: AsOf, years_back: int) -> Column:
    return F.make_date(F.year(reference_day(as_of)) - F.lit(years_back), F.lit(1), F.lit(1))


def younger_than(birth: Column, years: int, as_of: AsOf = None) -> Column:
    """`calendar_age(birth) < years` as a range; births after the reference day pass as well."""
    return birth >= _new_year(as_of, years - 1)


def older_than(birth: Column, years: int, as_of: AsOf = None) -> Column:
    """`calendar_age(birth) > years` as a range."""
    return birth < _new_year(as_of, years)


def within_past_year(day: Column, as_of: AsOf = None) -> Column:
    """The twelve months that end on the reference day, both ends included."""
    today = reference_day(as_of)
    return (day >= F.add_months(today, -12)) & (day <= today)
