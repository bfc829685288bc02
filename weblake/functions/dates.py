"""Date and timestamp expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: log date and time tokens joined by one space
LOG_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d[:10])
    return F.lit(d)


# fixed value: the token shapes of LOG_TIMESTAMP_FORMAT
LOG_TIMESTAMP_PATTERN = r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$"


def parse_log_timestamp(date_text, time_text) -> Column:
    """``date`` + ``time`` tokens (``yyyy-MM-dd HH:mm:ss``) -> timestamp_ntz.

    Built from its fields, so no session time zone is involved (a wall-clock
    time inside a daylight-saving gap stays as written); null when malformed or
    not a real date/time.
    """
    text = F.concat(_c(date_text), F.lit(" "), _c(time_text))
    # once the shape is checked every field sits at a fixed position
    part = [F.substring(text, pos, n).try_cast("int") for pos, n in ((1, 4), (6, 2), (9, 2), (12, 2), (15, 2), (18, 2))]
    return F.when(text.rlike(LOG_TIMESTAMP_PATTERN), F.try_make_timestamp_ntz(*part))


def year_text(c) -> Column:
    """Four-digit year of a timestamp/date (or of a date string); null when unparsable."""
    return F.date_format(_as_date(c), "yyyy")


def month_text(c) -> Column:
    """Two-digit month of a timestamp/date (or of a date string)."""
    return F.date_format(_as_date(c), "MM")


def _as_date(c) -> Column:
    return _c(c).try_cast("date")


def month_start(as_of) -> Column:
    """First day of ``as_of``'s month, as a date."""
    return F.trunc(_lit_date(as_of), "MM")


def event_window(execution_date) -> tuple[Column, Column]:
    """Events generated for an execution date span [first of month of d-1, d-1]."""
    prev = F.date_sub(_lit_date(execution_date), 1)
    return F.trunc(prev, "MM"), prev


def shift_months(d, months: int) -> Column:
    return F.add_months(_lit_date(d), months)


def minus_minutes_seconds(ts, minutes, seconds) -> Column:
    """``ts`` moved back by ``minutes`` and ``seconds``."""
    return _c(ts) - F.make_dt_interval(F.lit(0), F.lit(0), _c(minutes), _c(seconds).cast("decimal(18,6)"))


def last_year_text(as_of) -> str:
    """Year before ``as_of`` as text (the last-year partition value)."""
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of[:10])
    return str(as_of.year - 1)


def year_month_of(date_text) -> tuple[Column, Column]:
    """Year and month tokens of a ``YYYY-MM-DD`` string, by position."""
    t = _c(date_text)
    return F.substring(t, 1, 4), F.substring(t, 6, 2)
