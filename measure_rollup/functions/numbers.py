"""Number parsing, fixed-point arithmetic and one-digit number text.

Values are held as integer *tenths* (``12.3`` is 123), so that sums are exact and do
not depend on the order in which partitions arrive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Up to this many bytes a value is below 2**53 tenths, and parsing it as a double,
# times ten, is off by far less than one half.
_EXACT_DOUBLE_BYTES = 15

# From 2**24 on a 32-bit float has no fractional part.
_F32_INTEGRAL = 16777216.0


def to_tenths(text: Column) -> Column:
    """Text with exactly one fractional digit to bigint tenths, else null.

    Accepts ``-?[0-9]+\\.[0-9]`` that fits a bigint and nothing else: no plus sign, no
    blanks, no exponent, no other number of decimals. The first byte, the place of the
    point and the last byte are checked by byte comparisons, the digits between by the
    cast. That stays in generated code and costs less than a regular expression.
    """
    size = F.octet_length(text)
    last = F.substring(text.cast("binary"), -1, 1).cast("string")
    shape = (
        (size >= 3)
        & (F.instr(text, ".") == size - 1)
        & (text >= "-0")
        & (text < ":")
        & last.between("0", "9")
    )
    short = F.rint(text.try_cast("double") * 10).cast("bigint")
    long = F.replace(text, F.lit(".")).try_cast("bigint")
    return F.when(shape, F.when(size <= _EXACT_DOUBLE_BYTES, short).otherwise(long))


def to_float(text: Column) -> Column:
    """Text to 32-bit float by Spark's ``try_cast`` rules; NaN counts as unparsable."""
    return F.nullif(text.try_cast("float"), F.lit(float("nan")).cast("float"))


def units(tenths: Column) -> Column:
    """Tenths as a double in units."""
    return tenths / F.lit(10.0)


def mean_units(total: Column, count: Column) -> Column:
    """Mean of a summary as a double in units."""
    return total.cast("double") / count.cast("double") / F.lit(10.0)


def mean_tenths(total: Column, count: Column) -> Column:
    """Mean rounded to whole tenths, exactly, halves away from zero."""
    size = F.abs(total.cast("decimal(20,0)"))
    double_count = count.cast("decimal(20,0)") * 2
    shifted = size * 2 + count.cast("decimal(20,0)")
    rounded = ((shifted - shifted % double_count) / double_count).cast("decimal(20,0)")
    return F.when(total < 0, -rounded).otherwise(rounded)


def tenths_text(tenths: Column) -> Column:
    """Tenths as text with one fractional digit; zero has no sign."""
    return (tenths.cast("decimal(20,0)") / F.lit(10).cast("decimal(2,0)")).cast("decimal(21,1)").cast("string")


def f32_units(tenths: Column) -> Column:
    """Tenths as a 32-bit float in units, computed in 32-bit arithmetic."""
    return tenths.cast("float") * F.lit(0.1).cast("float")


def f32_mean(total: Column, count: Column) -> Column:
    """Mean in units, every step rounded to a 32-bit float."""
    # Division takes doubles. The factor one keeps the optimizer from merging the casts
    # bigint to float to double into one that does not round.
    one = F.lit(1.0).cast("float")
    quotient = (total.cast("float") * one) / (count.cast("float") * one)
    return quotient.cast("float") * F.lit(0.1).cast("float")


def f32_text(value: Column) -> Column:
    """A 32-bit float as text with one fractional digit.

    Rounds the binary value, so ties exist only where the float is one, and they go to
    the even digit. A negative value that rounds to zero keeps its sign.
    """
    tenth = F.bround(value.cast("double").try_cast("decimal(38,25)"), 1)
    infinite = F.abs(value) == F.lit(float("inf")).cast("float")
    return (
        F.when(infinite, F.when(value > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(
            F.abs(value) >= F.lit(_F32_INTEGRAL),
            F.concat(value.cast("double").try_cast("decimal(38,0)").cast("string"), F.lit(".0")),
        )
        .when((tenth == 0) & (value < 0), F.lit("-0.0"))
        .otherwise(tenth.cast("decimal(20,1)").cast("string"))
    )
