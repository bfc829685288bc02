"""String expressions for log fields and rendered names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: referer path segment -> page type
PAGE_TYPES = {"products": "product", "orders": "order"}
# fixed value: the parenthesised platform part of a user agent
DEVICE_PATTERN = r"\((.*?)\)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_get(c, pattern: str, index: int) -> Column:
    """Element ``index`` (0-based) of ``split(c, pattern)``; null when out of range."""
    return F.get(F.split(_c(c), pattern), index)


def page_type(referer) -> Column:
    """``product`` / ``order`` from path segment 3 of the referer URL, else null."""
    seg = split_get(referer, "/", 3)
    expr = None
    for raw, label in PAGE_TYPES.items():
        expr = (F.when(seg == raw, F.lit(label)) if expr is None
                else expr.when(seg == raw, F.lit(label)))
    return expr


def entity_id(referer) -> Column:
    """Path segment 4 of the referer URL (the product or order id, as text)."""
    return split_get(referer, "/", 4)


def device_text(useragent) -> Column:
    """First parenthesised group of a user agent, shown as a bracketed list.

    Equal to casting ``split(group, ';')`` to string -- parts keep their leading
    space, so parts are separated by a comma and two spaces, and a user agent
    without parentheses gives ``[]`` -- but computed without building an array.
    """
    group = F.regexp_extract(_c(useragent), DEVICE_PATTERN, 1)
    return F.concat(F.lit("["), F.replace(group, F.lit(";"), F.lit(", ")), F.lit("]"))


def device_text_as_array_cast(useragent) -> Column:
    """The literal array-cast form of :func:`device_text` (kept for equivalence tests)."""
    return F.split(F.regexp_extract(_c(useragent), DEVICE_PATTERN, 1), ";").cast("string")


def user_slug(name) -> Column:
    """Customer name as a log user name: spaces to dots, lower case."""
    return F.lower(F.replace(_c(name), F.lit(" "), F.lit(".")))


def pad_even(value) -> Column:
    """Decimal text padded with one leading zero when its length is odd (month 7 -> 07)."""
    s = _c(value).cast("string")
    return F.when(F.length(s) % 2 == 1, F.concat(F.lit("0"), s)).otherwise(s)


def quoted(c) -> Column:
    """``"value"`` (the log format's quoting of tokens that may hold spaces)."""
    return F.concat(F.lit('"'), _c(c), F.lit('"'))


def log_line(host, ident, username, date, time, request, status, size, referer, useragent,
             quote_username: bool = False) -> Column:
    """One access-log line: ten space-separated tokens; status, referer and user
    agent are quoted (product-view lines also quote the user name)."""
    user = quoted(username) if quote_username else _c(username)
    return F.concat_ws(" ", _c(host), _c(ident), user, _c(date), _c(time), _c(request), quoted(status),
                       _c(size), quoted(referer), quoted(useragent))
