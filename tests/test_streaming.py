"""A running summary equals the batch result over all files so far."""

from pathlib import Path

import pytest

from measure_rollup import summary_of
from measure_rollup.sources import read_lines
from measure_rollup.streaming import compact_summary, latest_summary, run_summary, running


@pytest.fixture
def folders(spark, tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path / "in", str(tmp_path / "out")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _both(spark, source, output):
    return _rows(latest_summary(spark, output)), _rows(summary_of(read_lines(spark, str(source))))


def test_restart_with_new_files(spark, folders):
    source, output = folders
    (source / "1.txt").write_text("A;1.0\nB;-2.5\nbad\n")
    (source / "2.txt").write_text("A;3.0\nC;0.1")
    run_summary(spark, str(source), output)
    running, batch = _both(spark, source, output)
    assert running == batch == [("A", 10, 30, 40, 2), ("B", -25, -25, -25, 1), ("C", 1, 1, 1, 1)]

    (source / "3.txt").write_text("A;-7.0\nD;9.9\n")
    run_summary(spark, str(source), output)
    running, batch = _both(spark, source, output)
    assert running == batch and ("A", -70, 30, -30, 3) in running

    run_summary(spark, str(source), output)
    assert _both(spark, source, output)[0] == batch


@pytest.mark.parametrize("bound", [{"max_files": 1}, {"max_bytes": "1"}])
def test_several_batches(spark, folders, bound):
    source, output = folders
    for i in range(3):
        (source / f"{i}.txt").write_text(f"A;{i}.5\nn{i};-{i}.0\n")
    run_summary(spark, str(source), output, **bound)
    running, batch = _both(spark, source, output)
    assert running == batch and len(running) == 4
    batches = spark.read.parquet(output).select("batch").distinct().count()
    assert batches == 3


def test_batch_run_again_replaces_its_folder(spark, folders):
    """A batch whose commit was lost is repeated; the output stays right."""
    source, output = folders
    for i in range(3):
        (source / f"{i}.txt").write_text(f"A;{i}.5\nn{i};-{i}.0\n")
    run_summary(spark, str(source), output, max_files=1)
    before, batch = _both(spark, source, output)
    (Path(output) / "_progress" / "commits" / "2").unlink()
    (Path(output) / "_progress" / "commits" / ".2.crc").unlink(missing_ok=True)
    run_summary(spark, str(source), output, max_files=1)
    assert _both(spark, source, output)[0] == before == batch


def test_failing_line_stops_the_stream(spark, folders):
    source, output = folders
    (source / "1.txt").write_text("A;1.0\nbad\n")
    with pytest.raises(Exception, match="malformed record"):
        run_summary(spark, str(source), output, mode="fail")


def test_options_are_passed_on(spark, folders):
    source, output = folders
    (source / "1.txt").write_text("A;B;1.0\n")
    run_summary(spark, str(source), output, split="last")
    assert _rows(latest_summary(spark, output)) == [("A;B", 10, 10, 10, 1)]
    with pytest.raises(ValueError):
        run_summary(spark, str(source), output, number="float")


def test_no_files_yet(spark, folders):
    source, output = folders
    run_summary(spark, str(source), output)
    assert latest_summary(spark, output).collect() == []
    (source / "1.txt").write_text("A;1.0\n")
    run_summary(spark, str(source), output)
    assert _rows(latest_summary(spark, output)) == [("A", 10, 10, 10, 1)]


def test_key_value_folders(spark, folders):
    source, output = folders
    (source / "value=x").mkdir()
    (source / "value=x" / "1.txt").write_text("A;1.0\n")
    run_summary(spark, str(source), output)
    assert _rows(latest_summary(spark, output)) == [("A", 10, 10, 10, 1)]


def _read_rows(spark, output):
    """How many stored rows a reader of the summary reads."""
    files = running._Files(spark, output)
    kept = [f"batch={n}" for n in files.batches() if n > files.snapshot()]
    kept += [f"_snapshots/snapshot={files.snapshot()}"] if files.snapshot() >= 0 else []
    return sum(spark.read.parquet(f"{output}/{k}").count() for k in kept)


def test_snapshots_bound_what_is_read(spark, folders):
    source, output = folders
    for round_ in range(5):
        for i in range(4):
            (source / f"{round_}-{i}.txt").write_text("".join(f"n{k};{round_}.{i}\n" for k in range(20)))
        run_summary(spark, str(source), output, max_files=1)
        held = latest_summary(spark, output)
        before = _rows(held)
        compact_summary(spark, output)
        assert _rows(held) == before  # a reader that listed the older files
        running_, batch = _both(spark, source, output)
        assert running_ == batch == before
        assert _read_rows(spark, output) == 20
    assert len(list(Path(output).glob("batch=*"))) <= 4
    compact_summary(spark, output)
    assert _both(spark, source, output)[0] == before


def test_failed_compaction_changes_nothing(spark, folders, monkeypatch):
    source, output = folders
    for i in range(3):
        (source / f"{i}.txt").write_text(f"A;{i}.5\nn{i};-{i}.0\n")
        run_summary(spark, str(source), output)
        if i == 1:
            compact_summary(spark, output)
    before, batch = _both(spark, source, output)

    def crash(self, folder):
        raise OSError(folder)

    monkeypatch.setattr(running._Files, "remove", crash)
    with pytest.raises(OSError):
        compact_summary(spark, output)
    assert _both(spark, source, output)[0] == before == batch
    (Path(output) / "_snapshots" / "snapshot=2" / "_SUCCESS").unlink()  # as if it had ended earlier
    assert _both(spark, source, output)[0] == before
    monkeypatch.undo()
    compact_summary(spark, output)
    assert _both(spark, source, output)[0] == before
