"""Summaries per name: compute, store, merge and finalise.

A summary row is ``(name, min_t, max_t, sum_t, cnt)`` in tenths. Minimum, maximum, sum
and count all merge, so summaries of any parts of the data combine to the summary of the
whole, in any order and without rereading the data. Spark aggregates on the map side
first: a name that holds a third of all rows costs one row per task in the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from measure_rollup.functions import mean_units, units

STATE = ("min_t", "max_t", "sum_t", "cnt")

#: Columns of a stored summary, in tenths or of exact floats.
SCHEMAS = {
    "tenths": "name string, min_t bigint, max_t bigint, sum_t bigint, cnt bigint",
    "exact": "name string, scale int, min_f float, max_f float, high bigint, low bigint, cnt bigint",
}


def summarize(records: DataFrame, key: str = "name", value: str = "t") -> DataFrame:
    """Records to one summary row per name. Null values do not count."""
    return _aggregate(records.select(F.col(key).alias("name"), F.col(value).alias("t")), ["name"])


def partial_summary(records: DataFrame, by: Column, part: str = "part") -> DataFrame:
    """One summary row per part and name; ``by`` gives the part of a record."""
    return _aggregate(records.select(by.alias(part), "name", "t"), [part, "name"])


def merge_summaries(*summaries: DataFrame) -> DataFrame:
    """Summaries, each with any number of rows per name, to one row per name."""
    columns = ["name", *STATE]
    together = reduce(DataFrame.unionByName, [s.select(*columns) for s in summaries])
    return together.groupBy("name").agg(
        F.min("min_t").alias("min_t"),
        F.max("max_t").alias("max_t"),
        exact_sum("sum_t").alias("sum_t"),
        F.sum("cnt").alias("cnt"),
    )


def finalize(summary: DataFrame) -> DataFrame:
    """Summary rows to ``(name, min, mean, max, cnt)`` with doubles in units."""
    return summary.select(
        "name",
        units(F.col("min_t")).alias("min"),
        mean_units(F.col("sum_t"), F.col("cnt")).alias("mean"),
        units(F.col("max_t")).alias("max"),
        "cnt",
    )


def summarize_float(records: DataFrame, key: str = "name", value: str = "t") -> DataFrame:
    """Records with 32-bit floats to ``(name, min, mean, max, cnt)``.

    The mean is accumulated in double. Its last bits depend on the order of addition;
    where that matters use tenths, or ``float_state``, whose sums are exact.
    """
    t = F.col("t")
    return (
        records.select(F.col(key).alias("name"), F.col(value).alias("t"))
        .groupBy("name")
        .agg(
            F.min(t).cast("double").alias("min"),
            F.avg(t).alias("mean"),
            F.max(t).cast("double").alias("max"),
            F.count(t).alias("cnt"),
        )
        .where(F.col("cnt") > 0)
    )


def write_summary(summary: DataFrame, path: str, part: str = "part") -> None:
    """Add or replace the parts in ``summary`` in a stored summary table.

    Parts that ``summary`` does not hold are left alone, so writing a part again has
    the same result as writing it once.
    """
    (
        summary.hint("rebalance", F.col(part))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(part)
        .parquet(path)
    )


def read_summaries(
    spark: SparkSession, path: str, part: str = "part", part_type: str = "string", number: str = "tenths"
) -> DataFrame:
    """All parts of a stored summary table, which may have no rows.

    ``number`` is ``tenths``, or ``exact`` for float states. The part comes back as
    ``part_type``: as text it is what was written, ``007`` included.
    """
    return spark.read.schema(f"{SCHEMAS[number]}, `{part}` {part_type}").parquet(path)


def _aggregate(records: DataFrame, keys: list[str]) -> DataFrame:
    return (
        records.groupBy(*keys)
        .agg(
            F.min("t").alias("min_t"),
            F.max("t").alias("max_t"),
            exact_sum("t").alias("sum_t"),
            F.count("t").alias("cnt"),
        )
        .where(F.col("cnt") > 0)
    )


def exact_sum(column: str) -> Column:
    # A sum beyond bigint stops the query, with and without ANSI mode; it never wraps.
    total = F.try_sum(column)
    stop = F.raise_error(F.lit("sum exceeds bigint")).cast("bigint")
    return F.when(total.isNull() & (F.count(column) > 0), stop).otherwise(total)
