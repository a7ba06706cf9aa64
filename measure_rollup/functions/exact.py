"""Exact sums of 32-bit floats, as integers by scale.

A 32-bit float is an integer times a power of two. Its *scale* is a range of 16 binary orders
of magnitude (four bits); in units of its scale it is an integer below 2^30. Sums of integers
do not depend on the order of addition, so the units of each scale are summed, in two halves
that leave room for 2^48 values, and the few sums of a name are combined once, exactly, and
rounded once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 4  # binary orders of magnitude of a scale
HALF = 15  # bits of the lower half of the units
INFINITE = 100  # the scale of infinite values

# A value of scale c is at least 2^(4c), but for the rounding of its logarithm; its last bit is
# 23 places lower, and one more leaves room for that rounding.
_BELOW = 24
_LEAST, _MOST = -38, 31  # scales of the smallest and the largest 32-bit float
_LIMB = 40  # bits, ten scales
_PER_LIMB = _LIMB // BITS
_LIMBS = -(-(_MOST - _LEAST + 1) // _PER_LIMB)
_LOWEST = BITS * _LEAST - _BELOW  # binary order of the lowest limb's unit
_EXTRA = 2  # limbs for what sums carry
_WIDE = "decimal(38,0)"


def scale_of(value: Column) -> Column:
    """The scale of a 32-bit float; 0 for zero, ``INFINITE`` for infinite ones."""
    size = F.abs(value.cast("double"))
    finite = size < F.lit(float("inf"))
    order = F.floor(F.log2(F.when(finite & (size > 0), size)) / BITS)
    return F.when(finite, F.coalesce(order, F.lit(0))).otherwise(F.lit(INFINITE)).cast("int")


def units_of(value: Column, scale: Column) -> Column:
    """The value as an integer in units of its scale; 0 for infinite ones."""
    factors = F.array(*(F.lit(2.0 ** (_BELOW - BITS * c)) for c in range(_LEAST, _MOST + 1)))
    units = (value.cast("double") * F.get(factors, scale - F.lit(_LEAST))).cast("bigint")
    return F.when(scale < INFINITE, units).when(scale.isNotNull(), F.lit(0).cast("bigint"))


def halves(units: Column) -> tuple[Column, Column]:
    """The upper and lower half; units = upper * 2^15 + lower, with lower not negative."""
    return F.shiftright(units, HALF), units.bitwiseAND((1 << HALF) - 1)


def limb_sums(scale: Column, high: Column, low: Column) -> Column:
    """Aggregate: the halves of a group's scales as sums by range of ten scales, lowest first."""
    units = high.cast("decimal(19,0)") * F.lit(1 << HALF).cast("decimal(6,0)") + low.cast("decimal(19,0)")
    place = scale - F.lit(_LEAST)
    shift = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % _PER_LIMB) * BITS)
    shifted = (units.cast("decimal(26,0)") * shift.cast("decimal(12,0)")).cast(_WIDE)
    parts = (F.sum(F.when(F.floor(place / _PER_LIMB) == k, shifted)) for k in range(_LIMBS))
    return F.array(*(F.coalesce(part, F.lit(0)).cast(_WIDE) for part in parts))


def exact_double(limbs: Column) -> Column:
    """The number that limbs stand for, rounded once to the nearest double, ties to even."""
    limbs = F.concat(limbs, F.array(*[F.lit(0).cast(_WIDE)] * _EXTRA))
    negative = _carried(limbs)["carry"] < 0
    digits = _carried(F.transform(limbs, lambda d: F.when(negative, -d).otherwise(d).cast(_WIDE)))["digits"]
    start = F.struct(
        F.lit(0).cast(_WIDE).alias("lead"),
        F.lit(0).alias("read"),
        F.lit(False).alias("rest"),
        F.lit(_LIMBS + _EXTRA).alias("limb"),
    )

    def read(seen: Column, digit: Column) -> Column:
        more = (seen["lead"] == 0) | (seen["read"] < 3)
        return F.struct(
            F.when(more, seen["lead"] * _base() + digit).otherwise(seen["lead"]).cast(_WIDE).alias("lead"),
            F.when((seen["lead"] == 0) & (digit == 0), 0).when(more, seen["read"] + 1).otherwise(3).alias("read"),
            (seen["rest"] | (~more & (digit != 0))).alias("rest"),
            F.when(more, seen["limb"] - 1).otherwise(seen["limb"]).alias("limb"),
        )

    # three limbs from the first that is not zero have all the bits of a double; of the
    # others only matters whether one is not zero, which decides what would be a tie
    places = F.array(*(F.lit(2.0 ** (_LOWEST - 1 + _LIMB * k)) for k in range(_LIMBS + _EXTRA)))

    def rounded(seen: Column) -> Column:
        odd = F.when(seen["rest"], F.lit(1)).otherwise(F.lit(0)).cast("decimal(1,0)")
        twice = (seen["lead"] * F.lit(2).cast("decimal(1,0)") + odd).cast(_WIDE)
        size = twice.cast("double") * F.get(places, seen["limb"])
        return F.when(negative, -size).otherwise(size)

    return F.aggregate(F.reverse(digits), start, read, rounded)


def _base() -> Column:
    return F.lit(1 << _LIMB).cast("decimal(13,0)")


def _carried(limbs: Column) -> Column:
    """Limbs as digits from 0 to 2^40 - 1, lowest first, and what is carried out of the last."""
    start = F.struct(F.lit(0).cast(_WIDE).alias("carry"), F.array().cast(f"array<{_WIDE}>").alias("digits"))

    def step(done: Column, limb: Column) -> Column:
        total = (limb + done["carry"]).cast(_WIDE)
        digit = F.pmod(total, _base().cast(_WIDE)).cast(_WIDE)
        carry = ((total - digit).cast(_WIDE) / _base()).cast(_WIDE)
        return F.struct(carry.alias("carry"), F.concat(done["digits"], F.array(digit)).alias("digits"))

    return F.aggregate(limbs, start, step)
