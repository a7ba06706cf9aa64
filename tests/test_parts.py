"""Streams in parts: summary and malformed lines; places and counts of malformed lines."""

import shutil
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from measure_rollup import summary_of
from measure_rollup.operators import apply_mode, counted, finalize_float, line_counts, parse_records, quarantine, summarize
from measure_rollup.sources import read_lines
from measure_rollup.streaming import compact_parts, latest_parts, latest_summary, malformed_lines, run_parts, run_summary


@pytest.fixture
def folders(spark, tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path / "in", str(tmp_path / "out")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _check(spark, source, output):
    """Every line is in one of the two outputs, as often as in the files."""
    lines = read_lines(spark, str(source))
    assert _rows(latest_parts(spark, output)) == _rows(summary_of(lines))
    assert _rows(malformed_lines(spark, output).select("value", "status")) == _rows(quarantine(lines))
    kept = latest_parts(spark, output).agg(F.sum("cnt")).first()[0] or 0
    assert kept + malformed_lines(spark, output).count() == lines.count()


def test_restarts_and_snapshots(spark, folders):
    source, output = folders
    assert _rows(latest_parts(spark, output)) == [] == _rows(malformed_lines(spark, output))
    for step in range(4):
        (source / f"{step}.txt").write_text(f"A;{step}.0\nn{step};-1.5\nbad {step}\nA;\nA;x\n")
        spark.conf.set("spark.sql.shuffle.partitions", str(2 + step))  # no state depends on it
        try:
            run_parts(spark, str(source), output, mode="quarantine", max_files=1)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        _check(spark, source, output)
        if step % 2:
            compact_parts(spark, output)
            _check(spark, source, output)
    assert not (Path(output) / "summary" / "batch=0").exists()  # an earlier snapshot has it
    places = {r.file.rsplit("/", 1)[1]: r.value for r in malformed_lines(spark, output).where("status = 'no_delimiter'").collect()}
    assert places == {f"{n}.txt": f"bad {n}" for n in range(4)}


@pytest.mark.parametrize("lost", ["commit", "mark", "summary"])
def test_batch_run_again_replaces_both_outputs(spark, folders, lost):
    source, output = folders
    for n in range(3):
        (source / f"{n}.txt").write_text(f"A;{n}.5\nbad {n}\n")
    run_parts(spark, str(source), output, mode="quarantine", max_files=1)
    commits = Path(output) / "_progress" / "commits"
    (commits / "2").unlink()
    (commits / ".2.crc").unlink(missing_ok=True)
    if lost != "commit":  # stopped before the batch was marked, or before it was whole
        (Path(output) / "_finished" / "batch" / "2").unlink()
    if lost == "summary":
        shutil.rmtree(Path(output) / "malformed" / "batch=2")
        assert malformed_lines(spark, output).count() == 2
    run_parts(spark, str(source), output, mode="quarantine", max_files=1)
    _check(spark, source, output)


def test_floats_do_not_depend_on_batches(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for n in range(5):
        (source / f"{n}.txt").write_text("".join(f"A;{1e-7 * 3**k}\nA;{-7.1 * 5**n}\n" for k in range(30)))
    found = []
    for bound in (1, 2, 5):
        output = str(tmp_path / f"out{bound}")
        run_parts(spark, str(source), output, number="exact", max_files=bound)
        compact_parts(spark, output, "exact")
        found.append(_rows(finalize_float(latest_parts(spark, output, "exact"))))
    assert found[0] == found[1] == found[2] == _rows(summary_of(read_lines(spark, str(source)), number="exact"))


def test_modes_and_kinds(spark, folders):
    source, output = folders
    (source / "1.txt").write_text("A;1.0\nbad\n")
    with pytest.raises(Exception, match="malformed record: bad in .*1.txt, block at byte 0"):
        run_parts(spark, str(source), output, mode="fail")
    assert _rows(latest_parts(spark, output)) == []
    run_parts(spark, str(source), output)
    assert _rows(latest_parts(spark, output)) == [("A", 10, 10, 10, 1)] and malformed_lines(spark, output).count() == 0
    for wrong in ({"number": "exact"}, {"number": "float"}, {"mode": "skip"}):
        with pytest.raises(ValueError):
            run_parts(spark, str(source), output, **wrong)
    with pytest.raises(ValueError, match="holds tenths"):
        latest_parts(spark, output, "exact")
    with pytest.raises(ValueError, match="run_parts"):
        run_summary(spark, str(source), f"{output}2", mode="quarantine")


def test_missing_marks_are_an_error(spark, folders):
    source, output = folders
    (source / "1.txt").write_text("A;1.0\n")
    run_summary(spark, str(source), output)
    (Path(output) / "batch=0" / "_SUCCESS").unlink()
    with pytest.raises(RuntimeError, match="marksuccessfuljobs"):
        latest_summary(spark, output)


# places and counts


def test_place_of_a_malformed_line(spark, tmp_path):
    (tmp_path / "long.txt").write_text("".join(f"name {n};1.0\n" for n in range(400)) + "late\n")
    (tmp_path / "short.txt").write_text("early\nA;1.0\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        lines = read_lines(spark, str(tmp_path), place=True)
        found = {r.value: r for r in quarantine(lines).collect()}
        with pytest.raises(PySparkException, match="malformed record: (late|early) in file:.*(long|short).txt, block"):
            apply_mode(parse_records(lines), "fail").count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found.keys() == {"late", "early"} and found["early"].block == 0
    size = (tmp_path / "long.txt").stat().st_size
    assert found["late"].file.endswith("long.txt") and 0 < found["late"].block < size
    assert found["late"].block % 1024 == 0


def test_lines_are_counted_in_the_same_pass(spark, write):
    path = write(b"A;1.0\nB;2.0\nbad\nA;\nA;x\nA;;\n")
    seen = Observation("seen")
    summary = summarize(counted(parse_records(read_lines(spark, path)), seen))
    assert summary._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    assert _rows(summary) == [("A", 10, 10, 10, 1), ("B", 20, 20, 20, 1)]
    assert line_counts(seen) == {"ok": 2, "no_delimiter": 1, "empty_value": 1, "bad_value": 2}


def test_counts_of_nothing(spark, write):
    seen = Observation("none")
    assert summarize(counted(parse_records(read_lines(spark, write(b""))), seen)).collect() == []
    assert set(line_counts(seen).values()) == {0}
