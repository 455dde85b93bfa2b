"""Exact rounding helpers.

``round()`` on doubles is engine dependent at ties, and averages over decimals
change type between engines.  Money and prices are therefore kept as exact
integers (milli / cents) or decimals while aggregating, and rounded with
integer arithmetic: ``round_half_up(num / den, k)`` for ``num >= 0, den > 0``
is ``(2 * num * 10^k + den) div (2 * den)``.  Wide decimals avoid overflow on
very large sums.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def int_div(a, b) -> Column:
    """Integral division (``a div b``), a long; floor for non-negative operands."""
    return F.call_function("div", _c(a), _c(b))


def ratio_half_up_units(num, den, digits: int = 0, num_scale: int = 0) -> Column:
    """Long ``k`` with ``k / 10^digits == round_half_up(num / 10^num_scale / den, digits)``.

    ``num`` and ``den`` are non-negative integers with ``den > 0``.  Where every
    step fits into a long it is done in longs.
    """
    n = _c(num).cast(_WIDE)
    d = _c(den).cast(_WIDE)
    up, down = 2 * 10 ** digits, 10 ** num_scale
    wide = int_div(n * F.lit(up).cast(_WIDE) + d * F.lit(down).cast(_WIDE), d * F.lit(2 * down).cast(_WIDE))
    n, d = _c(num).try_cast("long"), _c(den).try_cast("long")
    fits = n.between(0, 2 ** 62 // up) & d.between(1, 2 ** 61 // down)
    return F.when(fits, int_div(n * up + d * down, d * (2 * down))).otherwise(wide)


def ratio_half_up(num, den, digits: int = 0, num_scale: int = 0) -> Column:
    """``round_half_up(num / 10^num_scale / den, digits)`` as a double (exact)."""
    return ratio_half_up_units(num, den, digits, num_scale) / F.lit(float(10 ** digits))


def units_to_decimal(k, digits: int, precision: int = 18) -> Column:
    """Long ``k`` in units of ``10^-digits`` -> ``decimal(precision, digits)`` exactly."""
    step = F.lit(10 ** -digits).cast(f"decimal({digits + 1},{digits})") if digits else F.lit(1)
    return (_c(k).cast(_WIDE) * step).cast(f"decimal({precision},{digits})")


def round_half_up(x, digits: int) -> Column:
    """Half-away-from-zero rounding of a double, identical in every engine:
    ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``."""
    c = _c(x)
    f = float(10 ** digits)
    r = F.signum(c) * F.floor(F.abs(c) * F.lit(f) + F.lit(0.5)) / F.lit(f)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)  # no negative zero


def _to_units(x, scale: int) -> Column:
    """Exact long of a decimal(?, log10(scale)).  Up to 2^46 units the product
    of doubles is off by less than a hundredth, and the nearest whole number is
    exact; a product of decimals for each row would cost more."""
    c, near = _c(x), _c(x).cast("double") * F.lit(float(scale))
    return F.when(F.abs(near) < 2.0 ** 46, F.rint(near).cast("long")).otherwise((c * F.lit(scale)).cast("long"))


def to_milli(price) -> Column:
    """Exact thousandths of a decimal(?,3) price as a long."""
    return _to_units(price, 1000)


def to_cents(amount) -> Column:
    """Exact hundredths of a decimal(?,2) amount as a long."""
    return _to_units(amount, 100)
