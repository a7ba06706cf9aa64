"""Order, number text and the report in one or many parts."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from measure_rollup import summary_of
from measure_rollup.functions import f32_mean, f32_text, f32_units
from measure_rollup.operators import (
    by_name,
    entries,
    numbered,
    report_line,
    report_parts,
    write_entries,
    write_report,
)
from measure_rollup.sources import new_folder, read_lines


def _summary(spark, names):
    rows = [(n, -5, 995, 990 * (i + 1), 2 * (i + 1)) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "name string, min_t bigint, max_t bigint, sum_t bigint, cnt bigint")


@pytest.fixture(scope="module")
def names():
    rng = random.Random(6)
    letters = "aZz é～😀-, =/{}"
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(0, 5))) for _ in range(3000)}, key=str.encode)


def _shuffled(items):
    items = list(items)
    random.Random(7).shuffle(items)
    return items


def test_name_order_is_byte_order(spark, names):
    summary = _summary(spark, _shuffled(names)).repartition(7)
    assert [r.name for r in by_name(summary).collect()] == names


def test_positions(spark, names):
    rows = numbered(_summary(spark, _shuffled(names)).repartition(7)).collect()
    assert {r.total for r in rows} == {len(names)}
    assert {r.pos: r.name for r in rows} == dict(enumerate(names, start=1))


def test_parts_make_up_the_line(spark, names):
    summary = _summary(spark, _shuffled(names)).repartition(7)
    (whole,) = report_line(summary).collect()
    assert whole.report == "{" + ", ".join(f"{n}=-0.5/49.5/99.5" for n in names) + "}"
    rows = report_parts(summary).orderBy("part").collect()
    assert [r.part for r in rows] == list(range(len(names)))
    assert "".join(r.report for r in rows) == whole.report


@pytest.mark.parametrize("size", [1, 2, 100_000, 100_001])
def test_written_report_has_one_layout(spark, tmp_path, size):
    names = [f"{i:06}" for i in range(size)]
    summary = spark.range(size).selectExpr(
        "lpad(id, 6, '0') as name", "15L as min_t", "15L as max_t", "15L as sum_t", "1L as cnt"
    )
    write_report(summary.repartition(5), str(tmp_path / "out"))
    assert (tmp_path / "out").read_text() == "{" + ", ".join(f"{n}=1.5/1.5/1.5" for n in names) + "}"


def test_line_starts_no_job(spark):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    report_line(_summary(spark, ["a", "b"]))
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_written_entries_are_in_order(spark, names, tmp_path):
    write_entries(_summary(spark, _shuffled(names)).repartition(7), str(tmp_path / "entries"))
    text = "".join(f.read_text() for f in sorted((tmp_path / "entries").glob("part-*")))
    assert text.splitlines() == [f"{n}=-0.5/49.5/99.5" for n in names]


def test_empty_report(spark, tmp_path):
    summary = _summary(spark, ["a"]).where("false")
    assert [tuple(r) for r in report_line(summary).collect()] == [(0, "{}")]
    assert [tuple(r) for r in report_parts(summary).collect()] == [(0, "{}")]
    write_report(summary, str(tmp_path / "empty"))
    assert [r.value for r in read_lines(spark, str(tmp_path / "empty")).collect()] == ["{}"]


def test_extreme_values(spark):
    low, high = -(2**63), 2**63 - 1
    frame = spark.createDataFrame([("a", low, high, low, 1), ("b", low, high, high, 2)], _summary(spark, ["x"]).schema)
    assert [r.entry for r in entries(frame).collect()] == [
        "a=-922337203685477580.8/-922337203685477580.8/922337203685477580.7",
        "b=-922337203685477580.8/461168601842738790.4/922337203685477580.7",
    ]


def test_null_name_is_rendered_empty(spark):
    schema = "name string, min double, mean double, max double, cnt bigint"
    frame = spark.createDataFrame([(None, 1.0, 1.0, 1.0, 1)], schema)
    assert report_line(frame, render="float").first().report == "{=1.0/1.0/1.0}"


def test_unknown_rendering(spark):
    with pytest.raises(ValueError):
        entries(_summary(spark, ["a"]), render="plain")


def test_f32_arithmetic_and_text(spark):
    rng = random.Random(8)
    sizes = [(k, m) for k in range(1, 13) for m in range(1, 7) for _ in range(80)]
    pairs = [(rng.randint(-(10**k), 10**k), rng.randint(1, 10**m)) for k, m in sizes]
    pairs += [(s, c) for s in range(-30, 31) for c in (1, 2, 4, 5, 8, 10, 100)] + [(0, 5)]
    frame = spark.createDataFrame(pairs, "s bigint, c bigint")
    s, c = F.col("s"), F.col("c")
    rows = frame.select(s, c, f32_text(f32_mean(s, c)).alias("mean"), f32_text(f32_units(s)).alias("units")).collect()
    for row in rows:
        mean = np.float32(row.s) / np.float32(row.c) * np.float32(0.1)
        assert row["mean"] == f"{float(mean):.1f}", row
        assert row.units == f"{float(np.float32(row.s) * np.float32(0.1)):.1f}", row


def test_float_text(spark):
    values = [0.25, 0.35, -0.04, -0.05, 0.05, 1e7, 16777216.0, -16777218.0, 3e9, 123456.75, 0.0, math.inf, -math.inf]
    frame = spark.createDataFrame([(v,) for v in values], "v double").select(F.col("v").cast("float").alias("v"))
    for row in frame.select("v", f32_text(F.col("v")).alias("text")).collect():
        assert row.text == f"{row.v:.1f}"


def test_report_of_written_lines(spark, names):
    usable = [n for n in names if n.strip()]
    frame = spark.createDataFrame([(f"{n};1.5",) for n in _shuffled(usable)], "value string")
    path = new_folder(spark, "names")
    frame.write.text(path)
    assert report_line(summary_of(read_lines(spark, path))).first().report == (
        "{" + ", ".join(f"{n}=1.5/1.5/1.5" for n in usable) + "}"
    )


def test_input_is_not_read_again(spark, write):
    """Rendering works on stored rows: it does not miss the input."""
    path = write(b"A;1.0\nB;2.0\nA;3.0\n")
    parts = report_parts(summary_of(read_lines(spark, path)))
    positions = numbered(summary_of(read_lines(spark, path)))
    os.unlink(path)
    text = "".join(r.report for r in parts.orderBy("part").collect())
    assert text == "{A=1.0/2.0/3.0, B=2.0/2.0/2.0}"
    assert sorted((r.pos, r.name) for r in positions.collect()) == [(1, "A"), (2, "B")]
