"""Exact money arithmetic.

Money columns are stored as doubles holding two decimals.  A double sum
depends on the order of its terms, so two engines (or two runs with a
different partitioning) can disagree in the last bit.  These helpers turn each
term into exact integer units, sum exactly, round to cents and only then go
back to double -- the result is the same whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# --------------------------------------------------------------------------
# integer units: exact sums that stay in long arithmetic
# --------------------------------------------------------------------------
#
# A decimal product widens past 18 digits (decimal(18,2) * decimal(6,2) ...),
# and above 18 digits every row is a BigDecimal operation.  Money held as
# integer units (cents, or 1e-4 / 1e-6 after multiplying by hundredths) is
# exact in a long.  Its sum is taken in two long halves, the value's high
# bits and its low ``_SPLIT_BITS`` bits.  For per-row values below 2^40 (a
# price of 1e5 in units of 1e-6 is ~2^37) each half is below 2^20, so each
# half's sum stays below 2^63 for up to 2^43 (about 8.8e12) rows per group;
# the halves are put back together once per group in decimal(38,0).  The sum
# is exact and independent of order.

_SPLIT_BITS = 20


def units(col: str | Column, scale: int = 2) -> Column:
    """A column of doubles holding at most ``scale`` decimals, as an exact
    long count of 10^-scale units (round half up, as a decimal cast)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c * F.lit(10**scale)).cast("long")


def sum_units(u: Column) -> Column:
    """Exact sum of a long column, as decimal(38,0)."""
    hi = F.sum(F.shiftright(u, _SPLIT_BITS))
    lo = F.sum(u.bitwiseAND(F.lit((1 << _SPLIT_BITS) - 1)))
    return hi.cast("decimal(38,0)") * F.lit(1 << _SPLIT_BITS).cast("decimal(38,0)") + lo.cast("decimal(38,0)")


def sum_units_cents(u: Column, scale: int) -> Column:
    """Exact sum of 10^-scale units, rounded half up to cents, as double."""
    total = sum_units(u)
    return F.round(total / F.lit(10**scale).cast("decimal(20,0)"), 2).cast("double")


def sum_units_double(u: Column, scale: int) -> Column:
    """Exact sum of 10^-scale units as double, no rounding."""
    return (sum_units(u) / F.lit(10**scale).cast("decimal(20,0)")).cast("double")
