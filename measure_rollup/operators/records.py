"""Lines to records: split at the delimiter, then parse the value.

Each step is its own projection that reads the columns of the step before, so a shared
expression is evaluated once per line and all steps fuse into one generated loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from measure_rollup.functions import decode_name, to_float, to_tenths, valid_lines

_ENDS = ("_head", "_tail")


def split_line(lines: DataFrame, how: str = "first", delimiter: str = ";") -> DataFrame:
    """Add ``name`` and ``rest``: the text before and after one delimiter.

    ``how`` names the delimiter to split at, the ``first`` or the ``last`` of the line.
    Both columns are null for a line without a delimiter. The split works on bytes, so
    damaged UTF-8 next to a delimiter does not hide it.
    """
    cut = _Cut(delimiter, how)
    return cut.ends(lines).select("*", cut.name.alias("name"), cut.rest.alias("rest")).drop(*_ENDS)


def parse_records(
    lines: DataFrame,
    split: str = "first",
    delimiter: str = ";",
    number: str = "tenths",
    encoding: str = "lossy",
) -> DataFrame:
    """Add ``name`` and the value ``t``; both are null for a malformed line.

    ``number='tenths'`` gives bigint tenths, ``number='float'`` a 32-bit float.
    """
    if number not in ("tenths", "float"):
        raise ValueError(f"number must be 'tenths' or 'float', not {number!r}")
    parse = to_tenths if number == "tenths" else to_float
    cut = _Cut(delimiter, split)
    fields = cut.ends(valid_lines(lines, encoding))
    parsed = fields.select("*", F.when(cut.has_value, parse(cut.tail)).alias("t"))
    # A name only with a value: all malformed lines then share one group, which map-side
    # aggregation folds to a row per task, and no filter has to parse the line again.
    name = F.when(F.col("t").isNotNull(), decode_name(cut.name, encoding))
    return parsed.select("*", name.alias("name")).drop(*_ENDS)


class _Cut:
    """The expressions of one split, over the line and the text at its two ends."""

    def __init__(self, delimiter: str, how: str):
        if how not in ("first", "last"):
            raise ValueError(f"the split must be at the 'first' or 'last' delimiter, not {how!r}")
        if len(delimiter) != 1:
            raise ValueError("the delimiter must be one character")
        self.delimiter = delimiter
        self.line, self.head, self.tail = F.col("value"), F.col("_head"), F.col("_tail")
        width = len(delimiter.encode())
        size, head_size, tail_size = (F.octet_length(c) for c in (self.line, self.head, self.tail))
        found = head_size < size
        single = head_size + tail_size + width == size
        if how == "first":
            self.has_value = single
            self.name = F.when(found, self.head)
            self.rest = F.when(single, self.tail).when(found, self._bytes(head_size + width + 1, size))
        else:
            self.has_value = tail_size < size
            self.name = F.when(single, self.head).when(found, self._bytes(F.lit(1), size - tail_size - width))
            self.rest = F.when(found, self.tail)

    def ends(self, lines: DataFrame) -> DataFrame:
        """Add the text before the first and after the last delimiter."""
        return lines.select(
            "*",
            F.substring_index(self.line, self.delimiter, 1).alias("_head"),
            F.substring_index(self.line, self.delimiter, -1).alias("_tail"),
        )

    def _bytes(self, start: Column, size: Column) -> Column:
        return F.substring(self.line.cast("binary"), start, size).cast("string")
