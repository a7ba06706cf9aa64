"""Laws of summaries: parts merge to the whole, and sums are exact or an error."""

import random

import pytest
from pyspark.sql import functions as F

from measure_rollup import summary_of
from measure_rollup.operators import (
    finalize,
    merge_summaries,
    parse_records,
    partial_summary,
    read_summaries,
    report_line,
    summarize,
    write_summary,
)
from measure_rollup.sources import new_folder, read_lines


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def records(spark):
    rng = random.Random(5)
    names = [f"n{min(rng.randint(0, 30), rng.randint(0, 30))}" for _ in range(5000)]
    rows = [(name, rng.randint(-999, 999), rng.randint(0, 9)) for name in names]
    return spark.createDataFrame(rows, "name string, t bigint, p int")


def test_parts_merge_to_the_whole(records):
    whole = _rows(summarize(records))
    for by in (F.col("p"), F.col("p") % 2, F.lit(0), F.hash("t", "p")):
        assert _rows(merge_summaries(partial_summary(records, by))) == whole


def test_merge_in_any_order(records):
    parts = [summarize(records.where(F.col("p") % 3 == k)) for k in range(3)]
    whole = _rows(summarize(records))
    assert _rows(merge_summaries(*parts)) == whole
    assert _rows(merge_summaries(parts[2], merge_summaries(parts[1], parts[0]))) == whole


def test_brute_force(records):
    expected = {}
    for name, t, _ in records.collect():
        expected.setdefault(name, []).append(t)
    state = sorted((n, min(v), max(v), sum(v), len(v)) for n, v in expected.items())
    assert _rows(summarize(records)) == state
    result = sorted((n, min(v) / 10, sum(v) / len(v) / 10, max(v) / 10, len(v)) for n, v in expected.items())
    assert _rows(finalize(summarize(records))) == result


def test_part_can_be_the_file(spark, write):
    paths = [write(b"A;1.0\nB;2.0\n"), write(b"A;3.0\n")]
    lines = read_lines(spark, paths).withColumn("file", F.col("_metadata.file_name"))
    parts = partial_summary(parse_records(lines), F.col("file"), part="file")
    assert parts.count() == 3
    assert _rows(merge_summaries(parts)) == [("A", 10, 30, 40, 2), ("B", 20, 20, 20, 1)]


def test_stored_parts_are_replaced_one_by_one(spark, records):
    path = new_folder(spark, "summaries")
    parts = partial_summary(records, F.col("p"))
    write_summary(parts, path)
    write_summary(parts.where("part = 3"), path)
    assert _rows(merge_summaries(read_summaries(spark, path))) == _rows(summarize(records))


def test_null_values_make_no_group(spark):
    frame = spark.createDataFrame([("A", 1), ("A", None), ("B", None)], "name string, t bigint")
    assert _rows(summarize(frame)) == [("A", 1, 1, 1, 1)]


def test_sum_beyond_32_bits(spark):
    lines = spark.range(2_200_000).select(F.lit("A;99.9").alias("value"))
    summary = summary_of(lines)
    assert _rows(summary) == [("A", 999, 999, 2_197_800_000, 2_200_000)]
    assert report_line(summary).first().report == "{A=99.9/99.9/99.9}"


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sum_beyond_64_bits_is_an_error(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        lines = spark.range(20).select(F.lit("A;99999999999999999.9").alias("value"))
        with pytest.raises(Exception, match="sum exceeds bigint"):
            summary_of(lines).collect()
        summary = summarize(spark.createDataFrame([("A", 9 * 10**18)], "name string, t bigint"))
        with pytest.raises(Exception, match="sum exceeds bigint"):
            merge_summaries(summary, summary).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_same_result_without_ansi(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        lines = spark.createDataFrame([("A;1.0",), ("A;x",), ("x",), ("A;2.5",)], "value string")
        assert report_line(summary_of(lines)).first().report == "{A=1.0/1.8/2.5}"
        assert report_line(summary_of(lines), render="f32").first().report == "{A=1.0/1.8/2.5}"
        assert report_line(summary_of(lines, number="float"), render="float").first().report == "{A=1.0/1.8/2.5}"
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_hot_name(spark):
    """One name holds a third of the rows; it reaches the shuffle as one row per task."""
    lines = spark.range(0, 300_000, 1, 8).selectExpr(
        "concat(if(id % 3 = 0, 'hot', concat('n', id % 1000)), ';', id % 100, '.', id % 10) as value"
    )
    rows = {r.name: r for r in summary_of(lines).collect()}
    assert rows["hot"].cnt == 100_000 and sum(r.cnt for r in rows.values()) == 300_000
    assert rows["hot"].sum_t == sum((i % 100) * 10 + i % 10 for i in range(0, 300_000, 3))


def test_stored_parts_come_back_as_written(spark, tmp_path):
    records = spark.createDataFrame(
        [("007", "A", 1), ("7", "A", 2), (None, "B", 3)], "shard string, name string, t bigint"
    )
    summary = partial_summary(records, F.col("shard"))
    write_summary(summary, str(tmp_path / "s"))
    back = read_summaries(spark, str(tmp_path / "s"))
    assert sorted(map(tuple, back.select(summary.columns).collect()), key=repr) == sorted(
        map(tuple, summary.collect()), key=repr
    )
    write_summary(summary.where("false"), str(tmp_path / "none"))
    assert read_summaries(spark, str(tmp_path / "none")).collect() == []
