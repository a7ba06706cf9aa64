"""Summaries of 32-bit floats whose sums are exact, so that they store and merge.

A state row is ``(name, scale, min_f, max_f, high, low, cnt)``: the values of a name that have
one scale (see ``functions.exact``), with the sum of their units in two halves. States of any
parts of the data merge by adding up, in any order, to the bits of the whole. A name has a
row per scale that occurs, which is a few; a name that holds a third of all rows costs these
few rows per task in the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from measure_rollup.functions.exact import INFINITE, exact_double, halves, limb_sums, scale_of, units_of
from measure_rollup.operators.summary import exact_sum

FLOAT_STATE = ("scale", "min_f", "max_f", "high", "low", "cnt")


def float_state(records: DataFrame, key: str = "name", value: str = "t") -> DataFrame:
    """Records with 32-bit floats to the state of each name. Null values do not count."""
    return _state(records.select(F.col(key).alias("name"), F.col(value).alias("t")), ["name"])


def partial_float_state(records: DataFrame, by: Column, part: str = "part") -> DataFrame:
    """The states of each part and name; ``by`` gives the part of a record."""
    return _state(records.select(by.alias(part), "name", "t"), [part, "name"])


def merge_float_states(*states: DataFrame) -> DataFrame:
    """States, each with any number of rows per name and scale, to one row per name and scale."""
    together = reduce(DataFrame.unionByName, [s.select("name", *FLOAT_STATE) for s in states])
    return together.groupBy("name", "scale").agg(
        F.min("min_f").alias("min_f"),
        F.max("max_f").alias("max_f"),
        exact_sum("high").alias("high"),
        exact_sum("low").alias("low"),
        F.sum("cnt").alias("cnt"),
    )


def finalize_float(state: DataFrame) -> DataFrame:
    """Merged states to ``(name, min, mean, max, cnt)``.

    The mean is the exact sum, rounded once to a double, divided by the count. The mean of
    values with one infinity is that infinity, with both it is NaN.
    """
    merged = state.groupBy("name").agg(
        F.min("min_f").cast("double").alias("min"),
        F.max("max_f").cast("double").alias("max"),
        F.sum("cnt").alias("cnt"),
        (F.max("scale") == INFINITE).alias("infinite"),
        limb_sums(F.col("scale"), F.col("high"), F.col("low")).alias("limbs"),
    )
    infinity = F.lit(float("inf"))
    both = (F.col("min") == -infinity) & (F.col("max") == infinity)
    mean = (
        F.when(~F.col("infinite"), exact_double(F.col("limbs")) / F.col("cnt"))
        .when(both, F.lit(float("nan")))
        .otherwise(F.when(F.col("max") == infinity, infinity).otherwise(-infinity))
    )
    return merged.select("name", "min", mean.alias("mean"), "max", "cnt")


def _state(records: DataFrame, keys: list[str]) -> DataFrame:
    # zero without its sign: which of two equal values a minimum gives depends on their order
    values = records.withColumn("t", F.col("t") + F.lit(0.0).cast("float"))
    scaled = values.withColumn("scale", F.when(F.col("t").isNotNull(), scale_of(F.col("t"))))
    units = scaled.withColumn("units", units_of(F.col("t"), F.col("scale")))
    high, low = halves(F.col("units"))
    return (
        units.select(*keys, "scale", "t", high.alias("high"), low.alias("low"))
        .groupBy(*keys, "scale")
        .agg(
            F.min("t").alias("min_f"),
            F.max("t").alias("max_f"),
            exact_sum("high").alias("high"),
            exact_sum("low").alias("low"),
            F.count("t").alias("cnt"),
        )
        .where(F.col("cnt") > 0)
    )
