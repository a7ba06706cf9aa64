"""The shape of the plans, which is what has to hold at scale."""

import re

import pytest

from measure_rollup import rollup, summary_of
from measure_rollup.operators import apply_mode, parse_records, quarantine
from measure_rollup.plans import catalog
from measure_rollup.sources import read_lines


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    file = tmp_path_factory.mktemp("plan") / "lines.txt"
    file.write_text("A;1.0\nB;2.0\n")
    return str(file)


@pytest.mark.parametrize("encoding", ["lossy", "strict", "bytes"])
def test_summary_is_one_scan_and_one_exchange(spark, path, encoding):
    plan = _plan(summary_of(read_lines(spark, path), encoding=encoding))
    assert plan.count("FileScan text") == 1
    assert len(re.findall(r"Exchange ", plan)) == 1
    assert plan.count("HashAggregate") == 2 and "partial_min" in plan
    assert not re.search(r"SortAggregate|ObjectHashAggregate|Python|CartesianProduct|BroadcastNestedLoop", plan)


@pytest.mark.parametrize("encoding", ["lossy", "strict", "bytes"])
@pytest.mark.parametrize("split", ["first", "last"])
def test_no_filter_below_the_aggregate(spark, path, encoding, split):
    """A filter there would be moved below the parse and evaluate it again."""
    plan = _plan(summary_of(read_lines(spark, path), encoding=encoding, split=split))
    assert plan.count("Filter (") == 1
    assert plan.index("Filter (") < plan.index("HashAggregate")


def test_rows_are_left_out_without_a_second_parse(spark, path):
    lines = read_lines(spark, path)
    for df in (quarantine(lines), apply_mode(parse_records(lines)), quarantine(lines, number="float")):
        plan = _plan(df)
        assert plan.count("substring_index") <= 3 and "Exchange" not in plan
        for condition in re.findall(r"Filter (.*)", plan):
            assert "substring_index" not in condition and "as double" not in condition


def test_sorted_result_adds_one_range_exchange(spark, path):
    plan = _plan(rollup(spark, path))
    assert len(re.findall(r"Exchange ", plan)) == 2 and "rangepartitioning(name" in plan


def test_merge_aggregates_before_the_exchange(spark, path):
    from measure_rollup.operators import merge_summaries

    summary = summary_of(read_lines(spark, path))
    plan = _plan(merge_summaries(summary, summary))
    assert "partial_try_sum" in plan and "SortAggregate" not in plan


def test_tables_are_read_narrow(spark):
    folder = "/root/testdata/sf0.001"
    plan = _plan(catalog.QUERIES["lineitem_summary"].run(spark, folder))
    assert re.search(r"ReadSchema: struct<l_extendedprice:double,l_returnflag:string,l_linestatus:string>", plan)
    plan = _plan(catalog.QUERIES["tenths_summary"].run(spark, folder))
    assert re.search(r"ReadSchema: struct<c_acctbal:double,c_mktsegment:string>", plan)


@pytest.mark.parametrize("encoding", ["lossy", "strict", "bytes"])
@pytest.mark.parametrize("split", ["first", "last"])
def test_generated_code_is_small_enough_to_compile(spark, path, encoding, split):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = summary_of(read_lines(spark, path), encoding=encoding, split=split)._jdf.queryExecution()
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        text = execution.explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    # The JVM does not compile methods above 8000 bytes.
    assert sizes and max(sizes) < 8000, sizes
