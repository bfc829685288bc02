"""Month calendar of a history: run dates, landing folders, event windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import event_window, shift_months
from ..functions.text import pad_even


def month_spine(dates: DataFrame, col: str) -> DataFrame:
    """One row per month from the first to the last month present in ``col``."""
    bounds = dates.agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    return bounds.select(F.explode(F.sequence(F.trunc("__lo", "MM"), F.trunc("__hi", "MM"),
                                              F.expr("interval 1 month"))).alias("month_start"))


def run_calendar(dates: DataFrame, col: str) -> DataFrame:
    """Per month of the history: the monthly run dated the first of the month,
    its landing folder, the event window it generates (the previous month up to
    the day before) and the year before it."""
    spine = month_spine(dates, col)
    d = F.col("month_start")
    lo, hi = event_window(d)
    return spine.select(
        d.alias("run_date"),
        F.concat(F.lit("year="), pad_even(F.year(d)), F.lit("/month="), pad_even(F.month(d))).alias("folder"),
        lo.alias("events_from"), hi.alias("events_to"),
        F.year(shift_months(d, -12)).cast("string").alias("last_year"),
        shift_months(d, -1).alias("previous_month"))
