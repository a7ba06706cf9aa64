"""The command line."""

import pytest

from measure_rollup.__main__ import main


def test_report_is_printed(spark, write, capsys):
    main([write(b"B;1.0\nA;-2.5\n"), write(b"A;3.0\nbad\n")])
    assert capsys.readouterr().out == "{A=-2.5/0.3/3.0, B=1.0/1.0/1.0}\n"


def test_options(spark, write, capsys):
    main([write(b"A|B|1.0\n"), "--split", "last", "--delimiter", "|"])
    assert capsys.readouterr().out == "{A|B=1.0/1.0/1.0}\n"
    main([write(b"A;1.25\nA;2\n"), "--reader", "csv"])
    assert capsys.readouterr().out == "{A=1.2/1.6/2.0}\n"
    with pytest.raises(SystemExit):
        main([write(b"A;1.25\n"), "--reader", "csv", "--quarantine", "x"])
    with pytest.raises(Exception, match="malformed record"):
        main([write(b"bad\n"), "--mode", "fail"])


def test_report_and_malformed_lines_are_written(spark, write, tmp_path, capsys):
    out, malformed = tmp_path / "out", tmp_path / "malformed"
    main([write(b"A;1.0\nbad\nA;\n"), "--out", str(out), "--quarantine", str(malformed)])
    assert capsys.readouterr().out == ""
    assert out.read_text() == "{A=1.0/1.0/1.0}"
    rows = spark.read.text(str(malformed)).collect()
    assert sorted(map(tuple, rows)) == [("A;", "empty_value"), ("bad", "no_delimiter")]
