"""The one-line report, and summaries of files that are replaced or deleted."""

import os
import random

import pytest

from measure_rollup import summary_of
from measure_rollup.operators import finalize_float, report_line, write_report
from measure_rollup.plans import drop_old_parts, file_totals, update_files
from measure_rollup.sources import read_lines
from measure_rollup.sources.joined import join_files, part_files

STATE = "name string, min_t bigint, max_t bigint, sum_t bigint, cnt bigint"


def _named(spark, count):
    return spark.range(count).selectExpr(
        "concat('n', lpad(id, 7, '0')) as name", "id as min_t", "id as max_t", "id as sum_t", "1L as cnt"
    )


@pytest.mark.parametrize("count", [0, 1, 2, 3, 1_000])
def test_file_has_the_bytes_of_the_line(spark, tmp_path, count):
    summary = _named(spark, count).repartition(5)
    path = tmp_path / "report"
    write_report(summary, str(path))
    assert path.read_bytes() == report_line(summary).first().report.encode()
    assert [f for f in os.listdir(tmp_path) if f.startswith("report")] == ["report"]  # no parts are left
    write_report(summary, str(path))  # again
    assert path.read_bytes() == report_line(summary).first().report.encode()


def test_a_million_names(spark, tmp_path):
    path = tmp_path / "report"
    write_report(_named(spark, 1_000_000).repartition(7), str(path))
    text = ", ".join(f"n{i:07}=" + "/".join([f"{i // 10}.{i % 10}"] * 3) for i in range(1_000_000))
    assert path.read_bytes() == b"{" + text.encode() + b"}"


def test_parts_stay_apart(spark, tmp_path):
    path = str(tmp_path / "report")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_report(_named(spark, 500).repartition(3), path, join=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [f for part in ("0-entries", "1-last") for f in part_files(spark, f"{path}/{part}")]
    assert len(files) > 2
    whole = b"".join(open(f.removeprefix("file:"), "rb").read() for f in files)
    assert whole == report_line(_named(spark, 500)).first().report.encode()


def test_part_files_are_in_the_order_of_their_numbers(spark, tmp_path):
    for n in (100_000, 99_999, 3):
        (tmp_path / f"part-{n:05}-x-c000.txt").write_text(f"{n} ")
    (tmp_path / "part-00007-x-c000.txt").write_text("")
    (tmp_path / "_SUCCESS").write_text("")
    files = part_files(spark, str(tmp_path))
    join_files(spark, files, str(tmp_path / "all"))
    assert (tmp_path / "all").read_text() == "3 99999 100000 "


# files that are replaced


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "in put+%é"
    folder.mkdir()
    return folder


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _same(spark, source, table):
    assert _rows(file_totals(spark, table)) == _rows(summary_of(read_lines(spark, str(source))))


def test_updates_equal_a_full_run(spark, source, tmp_path):
    table = str(tmp_path / "table")
    rng = random.Random(3)
    for step in range(5):
        for name in rng.sample(["a b", "c[1]", "d%20", "é+", "empty", "f{x}"], 3):
            file = source / name
            if step and rng.random() < 0.3:
                file.unlink(missing_ok=True)
            else:
                lines = [f"{rng.choice('ABCD')};{rng.randint(-99, 99)}.{rng.randint(0, 9)}" for _ in range(step * 3)]
                file.write_text("\n".join([*lines, "malformed"]))
        (source / "always").write_text("A;1.0\n")
        update_files(spark, str(source), table)
        _same(spark, source, table)


def test_only_changed_files_are_read(spark, source, tmp_path):
    table = str(tmp_path / "table")
    kept, other = source / "kept", source / "other"
    kept.write_text("A;1.0\nB;1.0\n")
    other.write_text("A;2.0\n")
    assert update_files(spark, str(source), table)[:2] == (2, 0)
    before = kept.stat()
    kept.write_text("A;9.0\nB;9.0\n")  # the same size and time: not looked into again
    os.utime(kept, ns=(before.st_atime_ns, before.st_mtime_ns))
    other.write_text("A;30.0\nC;5.0\n")
    assert update_files(spark, str(source), table)[:2] == (1, 1)
    assert _rows(file_totals(spark, table)) == [("A", 10, 300, 310, 2), ("B", 10, 10, 10, 1), ("C", 50, 50, 50, 1)]
    assert update_files(spark, str(source), table)[:2] == (0, 0)
    other.unlink()
    assert update_files(spark, str(source), table)[:2] == (0, 1)
    assert _rows(file_totals(spark, table)) == [("A", 10, 10, 10, 1), ("B", 10, 10, 10, 1)]
    assert drop_old_parts(spark, table) == 2
    assert _rows(file_totals(spark, table)) == [("A", 10, 10, 10, 1), ("B", 10, 10, 10, 1)]


def test_a_failed_update_changes_nothing(spark, source, tmp_path, monkeypatch):
    from measure_rollup.plans import files

    table = str(tmp_path / "table")
    (source / "a").write_text("A;1.0\n")
    update_files(spark, str(source), table)
    (source / "b").write_text("A;2.0\n")

    def lost(self, version):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(files._Versions, "finish", lost)
        with pytest.raises(OSError):
            update_files(spark, str(source), table)
    assert _rows(file_totals(spark, table)) == [("A", 10, 10, 10, 1)]
    update_files(spark, str(source), table)
    _same(spark, source, table)


def test_no_records_and_floats(spark, source, tmp_path):
    (source / "bad").write_text("malformed\n")
    update_files(spark, str(source), str(tmp_path / "tenths"))
    assert _rows(file_totals(spark, str(tmp_path / "tenths"))) == []
    (source / "a").write_text("A;0.5\n;2.5\n;1\n")
    for text in ("A;0.25\n", "A;0.75\n;8\n"):
        update_files(spark, str(source), str(tmp_path / "floats"), number="exact")
        (source / "b").write_text(text)
    update_files(spark, str(source), str(tmp_path / "floats"), number="exact")
    found = finalize_float(file_totals(spark, str(tmp_path / "floats"), "exact"))
    assert _rows(found) == _rows(summary_of(read_lines(spark, str(source)), number="exact"))
