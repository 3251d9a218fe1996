"""Column helpers: exact money sums, safe ratios, buckets, boundary date differences."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlake.constants import EARTH_RADIUS_KM

MONEY = "decimal(18,4)"
UNITS = 10_000  # money is counted in ten-thousandths
_LOW_BITS = 20


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _units(c: Column | str) -> Column:
    """Ten-thousandths; NULL for NaN, infinities and single values beyond 9e14."""
    return F.rint(as_col(c) * UNITS).try_cast("bigint")


def money(c: Column | str) -> Column:
    """Fixed-point value of a single amount: sums of it do not depend on partition order.

    For columns that hold totals use ``wide_money``.
    """
    return (_units(c).try_cast("decimal(18,0)") * F.lit(Decimal("0.0001"))).cast(MONEY)


def rows() -> Column:
    """Row count."""
    return F.count(F.lit(1))


def msum(c: Column | str) -> Column:
    """Order-independent sum as a decimal.

    Two long sums, of the high and the low bits, stay in generated code and cannot
    overflow below 2**43 rows; only the result is put together as a decimal.
    """
    u = _units(c)
    high = F.sum(F.shiftright(u, _LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(u.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast("decimal(20,0)")
    whole = high * F.lit(Decimal(1 << _LOW_BITS)) + low
    return (whole * F.lit(Decimal("0.0001"))).cast("decimal(32,4)")


def wide_money(c: Column | str) -> Column:
    """Fixed-point value with room for totals of totals (up to 1e26); NULL for NaN and infinities."""
    return (F.rint(as_col(c).cast("double") * UNITS).try_cast("decimal(30,0)") * F.lit(Decimal("0.0001"))).cast("decimal(34,4)")


def wide_sum(c: Column | str) -> Column:
    """Order-independent sum of a column that already holds totals, as a double."""
    return F.sum(wide_money(c)).cast("double")


def dsum(c: Column | str) -> Column:
    """Order-independent sum of a double column, as a double."""
    return msum(c).cast("double")


def davg(c: Column | str) -> Column:
    """Order-independent mean of a double column, as a double (NULL for no rows)."""
    return F.try_divide(dsum(c), F.count(as_col(c)).cast("double"))


def ratio(a: Column | str, b: Column | str) -> Column:
    """``a / NULLIF(b, 0)`` in doubles."""
    return F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))


def pct(a: Column | str, b: Column | str) -> Column:
    """``a * 100 / NULLIF(b, 0)`` in doubles."""
    return F.try_divide(as_col(a).cast("double") * F.lit(100.0), as_col(b).cast("double"))


def count_if(pred: Column) -> Column:
    """Number of rows where ``pred`` holds."""
    return F.count(F.when(pred, F.lit(1)))


def sum_if(pred: Column, value: Column | str) -> Column:
    """Exact sum of ``value`` over rows where ``pred`` holds; 0 when there are none."""
    return F.coalesce(dsum(F.when(pred, as_col(value))), F.lit(0.0))


def zero(c: Column | str) -> Column:
    return F.coalesce(as_col(c), F.lit(0.0))


def zero_int(c: Column | str) -> Column:
    return F.coalesce(as_col(c), F.lit(0).cast("bigint"))


def case_bucket(c: Column | str, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Ordered right-closed thresholds: the first ``c <= bound`` names the bucket.

    ``labels`` has one entry more than ``bounds``; NULL stays NULL.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("need one label more than bounds")
    c = as_col(c)
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for bound, label in zip(bounds, labels):
        out = out.when(c <= F.lit(bound), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def cut(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(e0, e1], (e1, e2] ...``; values outside all bins give NULL."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    c = as_col(c)
    out = F.when(c.isNull() | (c <= F.lit(edges[0])), F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        out = out.when(c <= F.lit(upper), F.lit(label))
    return out


def below(c: Column | str, bounds: Sequence[tuple[float, str]], beyond: str) -> Column:
    """Label of the first bound that the value is below, else ``beyond``."""
    c, out = as_col(c), F.when(F.lit(False), F.lit(beyond))
    for upper, label in bounds:
        out = out.when(c < F.lit(upper), F.lit(label))
    return out.otherwise(F.lit(beyond))


def clip(c: Column | str, lo: float, hi: float) -> Column:
    c = as_col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Hour boundaries crossed from ``start`` to ``end``."""
    return F.timestamp_diff("HOUR", F.date_trunc("hour", as_col(start)), F.date_trunc("hour", as_col(end)))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Day boundaries crossed from ``start`` to ``end``."""
    return F.datediff(as_col(end), as_col(start)).cast("bigint")


def months_between(start: Column | str, end: Column | str) -> Column:
    """Month boundaries crossed from ``start`` to ``end``."""
    s, e = as_col(start), as_col(end)
    return ((F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)).cast("bigint")


def month_start(c: Column | str) -> Column:
    return F.trunc(as_col(c), "month")


def day(c: Column | str) -> Column:
    return F.to_date(as_col(c))


def is_weekend(c: Column | str) -> Column:
    """Saturday or Sunday (Monday is weekday 0)."""
    return F.weekday(as_col(c)) >= 5


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(EARTH_RADIUS_KM) * F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def make_id(prefix: str, c: Column | str, width: int) -> Column:
    """Prefix plus zero-padded number; numbers wider than ``width`` keep all digits."""
    digits = as_col(c).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def money_label(c: Column | str, prefix: str = "PKR ") -> Column:
    """Short money label with a K, M or B suffix."""
    c = as_col(c)
    return F.concat(
        F.lit(prefix),
        F.when(c >= 1e9, F.concat(F.format_string("%.2f", c / 1e9), F.lit("B")))
        .when(c >= 1e6, F.concat(F.format_string("%.1f", c / 1e6), F.lit("M")))
        .when(c >= 1e3, F.concat(F.format_string("%.0f", c / 1e3), F.lit("K")))
        .otherwise(F.format_string("%,.0f", c)),
    )
