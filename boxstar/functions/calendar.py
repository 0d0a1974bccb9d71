"""Date and season expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxstar import config


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def season_end_year(ts, start_month: int = config.SEASON_START_MONTH) -> Column:
    """Games from ``start_month`` on belong to the season ending next year."""
    ts = _col(ts)
    return F.when(F.month(ts) >= start_month, F.year(ts) + 1).otherwise(F.year(ts))


def season_label(end_year) -> Column:
    """``YYYY-YY`` label of the season ending in ``end_year``."""
    y = _col(end_year).cast("int")
    return F.concat((y - 1).cast("string"), F.lit("-"), F.right(y.cast("string"), F.lit(2)))


def day_of_week_sunday0(ts) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(_col(ts)) - 1

