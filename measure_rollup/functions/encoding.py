"""Text encoding policy.

``spark.read.text`` keeps the bytes of a line as they are, so the policy can be
chosen after the scan:

* ``lossy``  - invalid sequences of a name become U+FFFD before grouping,
* ``strict`` - a line with invalid UTF-8 stops the query,
* ``bytes``  - names are grouped by their raw bytes; only rendering checks them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POLICIES = ("lossy", "strict", "bytes")


def valid_lines(lines: DataFrame, policy: str) -> DataFrame:
    """The lines to be split; under ``strict`` one with invalid UTF-8 in ``value`` raises.

    The check is a generator, so it is made whatever columns are used later.
    """
    _check(policy)
    if policy != "strict":
        return lines
    checked = F.struct(*(F.validate_utf8(c).alias(c) if c == "value" else F.col(c) for c in lines.columns))
    stop = F.when(F.is_valid_utf8("value") | F.col("value").isNull(), F.array(F.struct("*")))
    return lines.select(F.inline(stop.otherwise(F.array(checked))))


def decode_name(name: Column, policy: str) -> Column:
    """The name to group by; under ``lossy`` invalid sequences are replaced.

    Splitting works on bytes and comes first. A truncated character in front of the
    delimiter therefore never swallows the delimiter.
    """
    _check(policy)
    return F.make_valid_utf8(name) if policy == "lossy" else name


def _check(policy: str) -> None:
    if policy not in POLICIES:
        raise ValueError(f"encoding must be one of {POLICIES}, not {policy!r}")
