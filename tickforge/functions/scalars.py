"""Scalar expressions: safe ratios, labels, intervals, time conversions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days", "w": "weeks", "M": "months"}
_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800, "M": 2592000}


def parse_interval(text: str) -> tuple[int, str]:
    """'15m' to (15, 'm'); s, m, h, d, w and M are known, anything else is an error."""
    m = re.fullmatch(r"(\d+)([smhdwM])", text)
    if not m or int(m[1]) < 1:
        raise ValueError(f"unknown interval {text!r}")
    return int(m[1]), m[2]


def interval_seconds(text: str) -> int:
    n, unit = parse_interval(text)
    return n * _SECONDS[unit]


def bucket_start(ts: Column | str, interval: str) -> Column:
    """Start of the time bucket: weeks from Monday, months from the first; everything else from the epoch in UTC."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    n, unit = parse_interval(interval)
    if unit == "M":
        months = (F.year(ts) * 12 + F.month(ts) - 1).cast("int")
        first = months - months % n
        return F.make_timestamp(F.floor(first / 12).cast("int"), (first % 12 + 1).cast("int"), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    if unit == "w":
        return F.window(ts, f"{n} weeks", startTime="4 days").start
    return F.window(ts, f"{n} {_UNITS[unit]}").start


def ratio(a: Column, b: Column, otherwise: float | None = None) -> Column:
    """a / b as a double; null, or ``otherwise``, where b is 0 or null."""
    x = F.try_divide(a.cast("double"), b.cast("double"))
    return x if otherwise is None else F.coalesce(x, F.lit(float(otherwise)))


def dbl(c: Column | str, digits: int = 6) -> Column:
    """A rounded double, so that results agree to the digits that matter."""
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), digits)


def side(is_buyer_maker: Column | str = "is_buyer_maker") -> Column:
    return F.when(F.col(is_buyer_maker) if isinstance(is_buyer_maker, str) else is_buyer_maker, "sell").otherwise("buy")


def severity_by_change(pct: Column) -> Column:
    """Fixed limits: 20, 15 and 10 percent."""
    p = F.abs(pct)
    return F.when(p > 20, "critical").when(p > 15, "high").when(p > 10, "medium").otherwise("low")


def severity_by_z(z: Column) -> Column:
    """Fixed limits: 5, 4 and 3 standard deviations."""
    a = F.abs(z)
    return F.when(a > 5, "critical").when(a > 4, "high").when(a > 3, "medium").otherwise("low")


def trend(change: Column, limit: float = 0.01) -> Column:
    return F.when(change > limit, "up").when(change < -limit, "down").otherwise("flat")


def pressure(buy_sell_ratio: Column) -> Column:
    """Fixed limits: above 1.2 buying, below 0.8 selling."""
    return F.when(buy_sell_ratio > 1.2, "buying").when(buy_sell_ratio < 0.8, "selling").otherwise("neutral")


def clamped_bin(x: Column, low: Column, width: Column, n: int) -> Column:
    """Index of an equal-width bin, the maximum falling in the last one; 0 where the width is 0."""
    return F.least(F.coalesce(F.floor(F.try_divide(x - low, width)), F.lit(0)), F.lit(n - 1)).cast("int")


def upper_symbol(c: Column) -> Column:
    return F.upper(F.trim(c))


def bps(spread: Column, mid: Column) -> Column:
    return F.try_divide(spread, mid) * 10000
