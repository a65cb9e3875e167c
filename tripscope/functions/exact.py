"""Aggregates that give the same bits whatever the order and the engine.

Sums of floating-point values depend on the order in which tasks finish, and a
sum of squares in one DECIMAL overflows.  Here a value is cut into integers
("limbs"), the limbs are summed exactly, and the sums become one double by a fixed
sequence of exact steps and few roundings.  Limb sums are mergeable states: add
them up per day, per file, per cluster (``merged``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripscope.functions.columns import col_of

# Squares: a scaled value is split at this base; below its square no product of
# two limbs leaves 64 bits.
SQUARE_BASE = 10**8
# Ratios: binary digits of the limbs of a double, from the unit down (2**-80).
RATIO_BITS = (20, 30, 30)
# A whole number becomes a double in two parts.
DOUBLE_BASE = 10**15

SQUARE_STATE = ("n", "s", "hh", "hl", "ll")
RATIO_STATE = ("n", "l0", "l1", "l2")


def _div(a: Column, b: Column | int) -> Column:
    """Whole quotient, towards zero; the quotient must fit 64 bits."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def _wide(c: Column | int) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast("decimal(38,0)")


def _whole_sum(c: Column) -> Column:
    """Exact sum of 64-bit integers, over 1e10 rows of the largest of them."""
    return _wide(F.sum(c.cast("decimal(20,0)")))


def scaled(c: str | Column, digits: int) -> Column:
    """A value with at most ``digits`` decimals as a whole number."""
    return (col_of(c) * F.lit(10**digits)).cast("long")


def square_state(c: str | Column, digits: int) -> dict[str, Column]:
    """Aggregates of the scaled value x = high * SQUARE_BASE + low: count and sum
    of x, sums of high * high, high * low and low * low.  NULLs are ignored."""
    x = scaled(c, digits)
    high = _div(x, SQUARE_BASE)
    low = x - high * SQUARE_BASE
    return {
        "n": F.count(x), "s": _whole_sum(x),
        "hh": _whole_sum(high * high), "hl": _whole_sum(high * low), "ll": _whole_sum(low * low),
    }


def ratio_state(num: str | Column, den: str | Column) -> dict[str, Column]:
    """Aggregates of num / den as a double: count, and the sums of its limbs.  Rows
    with a NULL or a zero denominator are ignored; what is smaller than 2**-80 is
    cut off in every row alike."""
    rest = F.try_divide(col_of(num).cast("double"), col_of(den).cast("double"))
    out = {"n": F.count(rest)}
    for i, bits in enumerate(RATIO_BITS):
        rest = rest * F.lit(float(2**bits))
        out[f"l{i}"] = _whole_sum(F.floor(rest))
        rest = rest - F.floor(rest)
    return out


def merged(names: Iterable[str]) -> dict[str, Column]:
    """The same state from rows of partial states."""
    return {c: F.sum(c).cast("long") if c == "n" else _wide(F.sum(c)) for c in names}


def _double(whole: Column) -> Column:
    """A whole number of up to 33 digits as a double, by the same two steps on
    every engine."""
    return _div(whole, DOUBLE_BASE).cast("double") * F.lit(float(DOUBLE_BASE)) + (whole % _wide(DOUBLE_BASE)).cast("double")


def variance_of(state: dict[str, Column], digits: int) -> Column:
    """Sample variance from a ``square_state``; NULL below two values.

    With s = q * n + r, the sum of squared deviations is sum(x * x) - q * q * n -
    2 * q * r - r * r / n: whole numbers but for the last term, so nothing cancels
    in floating point."""
    n, s, hh, hl, ll = (_wide(state[c]) for c in SQUARE_STATE)
    some = F.nullif(n, _wide(0))
    q, r = _wide(_div(s, some)), s % some
    base = _wide(SQUARE_BASE)
    squares = hh * base * base + _wide(2) * hl * base + ll
    whole = squares - q * q * n - _wide(2) * q * r
    deviations = _double(whole) - r.cast("double") * r.cast("double") / some.cast("double")
    return F.try_divide(deviations, (n - 1).cast("double")) / F.lit(float(10 ** (2 * digits)))


def ratio_mean_of(state: dict[str, Column]) -> Column:
    """Mean of the ratios from a ``ratio_state``: long division of the limb sums
    by the count, to 2**-80; NULL without rows."""
    n = F.nullif(_wide(state["n"]), _wide(0))
    sums = [_wide(state[f"l{i}"]) for i in range(len(RATIO_BITS))]
    for i in range(len(sums) - 1, 0, -1):  # carry
        unit = 2 ** RATIO_BITS[i]
        sums[i - 1] = sums[i - 1] + _wide(_div(sums[i], unit))
        sums[i] = sums[i] % _wide(unit)
    total, rest, place = None, _wide(0), 0
    parts = []
    for bits, limb in zip(RATIO_BITS, sums, strict=True):
        place += bits
        carried = rest * _wide(2**bits) + limb
        parts.append(_div(carried, n).cast("double") * F.lit(2.0**-place))
        rest = carried % n
    total = parts[-1]
    for p in reversed(parts[:-1]):
        total = p + total
    return total
