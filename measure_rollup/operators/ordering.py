"""Name order, which is the order of the UTF-8 bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measure_rollup.sources.shared import settle

# monotonically_increasing_id() keeps the row number within a partition in 33 bits.
_ROW_BITS = 33


def by_name(df: DataFrame) -> DataFrame:
    """Rows in name order; a distributed range sort."""
    return df.orderBy("name")


def numbered(df: DataFrame) -> DataFrame:
    """Rows in name order with their position ``pos`` (from 1) and the row count ``total``.

    The rows are sorted in ranges and stored. A position is the row's place in its range
    plus the number of rows in the ranges before it, so only one count per range goes
    through a single task, never the rows.
    """
    placed = settle(by_name(df).withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftright("_row", _ROW_BITS).alias("_part")
    counts = placed.groupBy(part).agg(F.count("*").alias("_n"))
    offsets = counts.select(
        "_part",
        F.expr("sum(_n) over (order by _part) - _n").alias("_before"),
        F.expr("sum(_n) over ()").alias("total"),
    )
    return (
        placed.withColumn("_part", F.shiftright("_row", _ROW_BITS))
        .join(F.broadcast(offsets), "_part")
        .withColumn("pos", F.col("_before") + F.col("_row").bitwiseAND((1 << _ROW_BITS) - 1) + 1)
        .drop("_part", "_row", "_before")
    )
