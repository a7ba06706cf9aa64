"""Exact float sums against fractions, whatever the partitions; states store and merge."""

import math
import random
import struct
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from measure_rollup import rollup, summary_of
from measure_rollup.functions.exact import INFINITE, exact_double, scale_of, units_of
from measure_rollup.operators import (
    finalize_float,
    float_state,
    merge_float_states,
    partial_float_state,
    read_summaries,
    write_summary,
)


def _floats(seed: int, size: int, kind: int) -> list[float]:
    rng = np.random.default_rng(seed)
    if kind == 0:
        values = rng.normal(size=size).astype(np.float32)
    elif kind == 1:  # any bits
        values = rng.integers(0, 2**32, size=size, dtype=np.uint32).view(np.float32)
    elif kind == 2:  # powers of two, the borders of scales
        values = (2.0 ** rng.integers(-149, 127, size=size)).astype(np.float32)
    else:  # what cancels but for the smallest
        half = rng.integers(0, 2**32, size=size, dtype=np.uint32).view(np.float32)
        half = half[np.isfinite(half)]
        values = np.concatenate((half, -half, np.float32([2**-149])))
    return [float(x) for x in values if math.isfinite(x)] or [0.0]


@pytest.fixture(scope="module")
def groups():
    return {f"g{seed}": _floats(seed, 1 + seed % 13, seed % 4) for seed in range(200)}


def _records(spark, groups, partitions):
    rows = [(name, x) for name, values in groups.items() for x in values]
    random.Random(partitions).shuffle(rows)
    frame = spark.createDataFrame(rows, "name string, t double").repartition(partitions)
    return frame.withColumn("t", F.col("t").cast("float"))


def _bits(df):
    return {r.name: tuple(struct.pack("<d", x) for x in (r.min, r.mean, r.max)) + (r.cnt,) for r in df.collect()}


def _expected(values):
    mean = float(sum(map(Fraction, values))) / len(values)
    return tuple(struct.pack("<d", x + 0.0) for x in (min(values), mean, max(values))) + (len(values),)


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_sum_is_the_exact_one_rounded_once(spark, groups, partitions):
    found = _bits(finalize_float(float_state(_records(spark, groups, partitions))))
    assert found == {name: _expected(values) for name, values in groups.items()}


def test_units_give_the_value_back(spark):
    values = sorted({x for seed in range(40) for x in _floats(seed, 30, seed % 3)})
    values += [math.nextafter(2.0**k, 0) for k in range(-148, 128)]
    frame = spark.createDataFrame([(x,) for x in values], "x double").select(F.col("x").cast("float").alias("x"))
    frame = frame.where(F.abs("x") < float("inf")).withColumn("scale", scale_of(F.col("x")))
    for r in frame.withColumn("units", units_of(F.col("x"), F.col("scale"))).collect():
        assert Fraction(r.units) * Fraction(2) ** (4 * r.scale - 24) == Fraction(r.x)
        assert abs(r.units) < 2**30


def test_ties_and_carries(spark):
    cases = [[0] * 7, [1] + [0] * 6, [-1] + [0] * 6, [2**38] * 7, [-(2**100)] * 7, [2**53 + 1] + [0] * 6]
    cases += [[2**117, -1, 0, 0, 0, 0, 5], [1, 0, 0, 0, 0, 0, 2**53 + 1], [0, 0, 0, 0, 0, 0, 2**53 + 1]]
    cases += [[-1, 0, 0, 0, 0, 0, 2**53 + 1], [2**117 - 1] * 7]
    frame = spark.createDataFrame([(n, [str(x) for x in c]) for n, c in enumerate(cases)], "n int, limbs array<string>")
    limbs = F.transform("limbs", lambda x: x.cast("decimal(38,0)"))
    for r in frame.select("n", exact_double(limbs).alias("sum")).collect():
        assert r["sum"] == float(sum(Fraction(x) * Fraction(2) ** (40 * k - 176) for k, x in enumerate(cases[r.n])))


def test_states_merge_to_the_whole(spark, groups, tmp_path):
    records = _records(spark, groups, 3).withColumn("shard", F.pmod(F.hash("t"), F.lit(5)))
    whole = _bits(finalize_float(float_state(records)))
    path = str(tmp_path / "states")
    write_summary(partial_float_state(records, F.col("shard")), path)
    write_summary(partial_float_state(records.where("shard = 2"), F.col("shard")), path)  # a part again
    stored = read_summaries(spark, path, number="exact")
    assert _bits(finalize_float(merge_float_states(stored))) == whole
    one, other = stored.where("part < '2'"), stored.where("part >= '2'")
    assert _bits(finalize_float(merge_float_states(one, merge_float_states(other)))) == whole
    assert _bits(finalize_float(merge_float_states(other, one))) == whole


def test_infinities_nulls_and_signed_zero(spark):
    rows = [("up", "inf"), ("up", "1"), ("down", "-inf"), ("both", "inf"), ("both", "-inf"), ("zero", "-0.0")]
    lines = spark.createDataFrame([(f"{n};{v}",) for n, v in rows] + [("bad",), ("zero;",), ("zero;NaN",)], "value string")
    found = {r.name: r for r in summary_of(lines, number="exact").collect()}
    assert (found["up"].mean, found["down"].mean) == (math.inf, -math.inf) and math.isnan(found["both"].mean)
    assert math.copysign(1, found["zero"].min) == 1 and found["zero"].cnt == 1
    assert found["up"].min == 1 and found.keys() == {"up", "down", "both", "zero"}
    assert summary_of(lines.limit(0), number="exact").collect() == []
    assert INFINITE > 31


def test_rollup_takes_exact_floats(spark, write):
    path = write(b"b;1e8\nb;1\nb;-1e8\na;0.1\n")
    found = rollup(spark, path, number="exact").collect()
    assert [(r.name, r.mean) for r in found] == [("a", float(np.float32(0.1))), ("b", 1 / 3)]
