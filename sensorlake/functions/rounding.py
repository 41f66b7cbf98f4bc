"""Rounding and ratio helpers that give the same doubles in every engine.

``round(double, n)`` disagrees between engines on values that print as an
exact half (Spark rounds the printed decimal, others the binary value).
``round_half_up`` rounds half away from zero and takes a value within 16 units
of the double's last place below a half as the half, which covers what a
different order of summation changes (at most 1e-6 of the last digit). A value that has no decimals left at
that size (|x| * 10^n >= 2^52), NaN and the infinities are returned as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LAST_PLACES = 2.0**-48
_MOST = 1e-6
_WHOLE = 2.0**52


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_up(x, n: int) -> Column:
    """Round a double to ``n`` decimals, half away from zero."""
    x = _c(x)
    s = float(10**n)
    y = F.abs(x) * F.lit(s)
    rounded = F.signum(x) * F.floor(y + F.least(y * F.lit(_LAST_PLACES), F.lit(_MOST)) + F.lit(0.5)) / F.lit(s)
    # NaN compares as larger than any number, so it is kept here too
    return F.when(y >= F.lit(_WHOLE), x).otherwise(rounded)


def safe_ratio(num, den) -> Column:
    """``num / den`` as double; NULL (not an error) when ``den`` is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def pct(num, den, n: int | None = 2) -> Column:
    """``num / den * 100`` rounded half-up to ``n`` decimals; NULL on 0 rows."""
    v = safe_ratio(num, den) * F.lit(100.0)
    return v if n is None else round_half_up(v, n)


def halfup_int_ratio(num, den, scale: int) -> Column:
    """Exact ``round_half_up(num / den * scale)`` for non-negative integers.

    Integer arithmetic only, so it matches a DECIMAL average rounded to
    ``log10(scale)`` places in any engine.
    """
    num, den = _c(num).cast("long"), _c(den).cast("long")
    return int_div(num * F.lit(2 * scale) + den, den * F.lit(2))


def int_div(a, b) -> Column:
    """Floor division of non-negative longs, exact (NULL when ``b`` is 0)."""
    a, b = _c(a), _c(b)
    return F.when(b > 0, ((a - a % b) / b).cast("long"))
