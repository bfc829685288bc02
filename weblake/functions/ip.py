"""IPv4 text <-> 64-bit integer, and range text parsing.

All native expressions: no Python worker is involved, so these stay inside
whole-stage codegen and can be pushed into joins and filters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: one dotted-quad octet, 0-255 without leading zeros
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_PATTERN = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_ipv4(host) -> Column:
    """True for a dotted-quad IPv4 address (octets 0-255, no leading zeros)."""
    return _c(host).rlike(IPV4_PATTERN)


def _quad_value(h: Column) -> Column:
    parts = F.split(h, r"\.")
    return (F.get(parts, 0).try_cast("bigint") * 16777216
            + F.get(parts, 1).try_cast("bigint") * 65536
            + F.get(parts, 2).try_cast("bigint") * 256
            + F.get(parts, 3).try_cast("bigint"))


def ip_to_long(host) -> Column:
    """IPv4 dotted quad -> bigint in [0, 2^32); null for IPv6, junk or bad octets."""
    h = _c(host)
    return F.when(is_ipv4(h), _quad_value(h))


def valid_ip_to_long(host) -> Column:
    """:func:`ip_to_long` for rows already filtered with :func:`is_ipv4`.

    Declared non-null (the ``-1`` fallback is unreachable after the filter), so
    the optimizer derives no extra null filters from joins on it and does not
    copy the parsing expression into them.
    """
    return F.coalesce(_quad_value(_c(host)), F.lit(-1).cast("bigint"))


def long_to_ip(n) -> Column:
    """bigint in [0, 2^32) -> dotted quad; null outside that interval."""
    v = _c(n).cast("bigint")
    text = F.concat_ws(".", *[F.shiftright(v, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)])
    return F.when((v >= 0) & (v < 4294967296), text)


def range_start_text(iprange) -> Column:
    """Text of the first address of ``start-end``."""
    return F.trim(F.get(F.split(_c(iprange), "-"), 0))


def range_end_text(iprange) -> Column:
    """Text of the last address of ``start-end``; a range without ``-`` is one address."""
    r = _c(iprange)
    return F.trim(F.coalesce(F.get(F.split(r, "-"), 1), F.get(F.split(r, "-"), 0)))


def two_octet_key(address_text) -> Column:
    """First two octets concatenated without separator (the coarse legacy blocking key)."""
    parts = F.split(_c(address_text), r"\.")
    return F.concat(F.get(parts, 0), F.get(parts, 1))
