"""Small inputs with the report they must give, one per decision about the input."""

import pytest

from measure_rollup import rollup, run
from measure_rollup.operators import quarantine
from measure_rollup.sources import read_lines

CASES = {
    "three_lines": (b"A;1.0\nB;-2.5\nA;3.0\n", {}, "{A=1.0/2.0/3.0, B=-2.5/-2.5/-2.5}"),
    "no_delimiter": (b"A;1.0\nnosemi\n", {}, "{A=1.0/1.0/1.0}"),
    "two_delimiters_first": (b"A;B;3.0\nC;1.0\n", {}, "{C=1.0/1.0/1.0}"),
    "two_delimiters_last": (b"A;B;3.0\nC;1.0\n", {"split": "last"}, "{A;B=3.0/3.0/3.0, C=1.0/1.0/1.0}"),
    "bad_number": (b"A;abc\nA;1.0\n", {}, "{A=1.0/1.0/1.0}"),
    "empty_value": (b"A;\nB;1.0\n", {}, "{B=1.0/1.0/1.0}"),
    "decimals": (b"A;12\nA;12.34\nA;1.2\n", {}, "{A=1.2/1.2/1.2}"),
    "decimals_float": (b"A;12\nA;12.34\nA;1.2\n", {"number": "float"}, "{A=1.2/8.5/12.3}"),
    "signs_and_blanks": (b"A;+5.0\nA;1-2.3\nA; 5.0\nB;0.1\n", {}, "{B=0.1/0.1/0.1}"),
    "crlf": (b"A;1.0\r\nB;2.0\r\n", {}, "{A=1.0/1.0/1.0, B=2.0/2.0/2.0}"),
    "no_final_newline": (b"A;1.0\nB;2.0", {}, "{A=1.0/1.0/1.0, B=2.0/2.0/2.0}"),
    "blank_line": (b"A;1.0\n\nA;2.0\n", {}, "{A=1.0/1.5/2.0}"),
    "empty_name": (b";5.0\nA;1.0\n", {}, "{=5.0/5.0/5.0, A=1.0/1.0/1.0}"),
    "quotes": (b'"Q";1.0\n', {}, '{"Q"=1.0/1.0/1.0}'),
    "lossy": (b"L\xff;1.0\nL\xfe;2.0\n", {}, "{L�=1.0/1.5/2.0}"),
    "tie_up": (b"A;0.1\nA;0.2\n", {}, "{A=0.1/0.2/0.2}"),
    "tie_down": (b"A;-0.1\nA;-0.2\n", {}, "{A=-0.2/-0.2/-0.1}"),
    "zero_from_below": (b"A;-0.1\n" + b"A;0.0\n" * 99, {}, "{A=-0.1/0.0/0.0}"),
    "zero_from_below_f32": (b"A;-0.1\n" + b"A;0.0\n" * 99, {"render": "f32"}, "{A=-0.1/-0.0/0.0}"),
    "empty_file": (b"", {}, "{}"),
    "byte_order": (
        "a;1.0\nZ;1.0\né;1.0\nz;1.0\n😀;1.0\n～;1.0\n".encode(),
        {},
        "{" + ", ".join(f"{n}=1.0/1.0/1.0" for n in "Zazé～😀") + "}",
    ),
    "nan": (b"A;NaN\nA;1.0\n", {}, "{A=1.0/1.0/1.0}"),
    "nan_float": (b"A;NaN\nA;1.0\n", {"number": "float"}, "{A=1.0/1.0/1.0}"),
    "infinite_float": (b"A;inf\nB;-inf\n", {"number": "float"}, "{A=inf/inf/inf, B=-inf/-inf/-inf}"),
    "only_malformed": (b"nosemi\nA;abc\n", {}, "{}"),
    "no_digit_before_point": (b"A;.5\nA;-.5\nA;-\nA;.\nA;0.5\n", {}, "{A=0.5/0.5/0.5}"),
    "lone_cr_in_name": (b"A\rB;1.0\n", {}, "{A\rB=1.0/1.0/1.0}"),
    "other_delimiter": (b"A|1.0\nA;2|3.0\n", {"delimiter": "|"}, "{A=1.0/1.0/1.0, A;2=3.0/3.0/3.0}"),
    "csv": (b"A;1.0\nB;-2.55\nA;\nA;3.0\nbad\n", {"reader": "csv"}, "{A=1.0/2.0/3.0, B=-2.5/-2.5/-2.5}"),
    "csv_nan": (b"A;NaN\nA;1.0\nB;NaN\n", {"reader": "csv"}, "{A=1.0/1.0/1.0}"),
    "csv_quarantine": (b"A;1.0\nA;9.0;x\nA;x\nB\n", {"reader": "csv", "mode": "quarantine"}, "{A=1.0/1.0/1.0}"),
    "csv_empty_name": (b";5.0\nA;1.0\n", {"reader": "csv"}, "{=5.0/5.0/5.0, A=1.0/1.0/1.0}"),
    "csv_quotes": (b'"Q";1.0\n', {"reader": "csv"}, '{"Q"=1.0/1.0/1.0}'),
    "csv_empty_file": (b"", {"reader": "csv"}, "{}"),
    # A lead byte in front of the delimiter must not take the delimiter with it.
    "cut_character": (b"Caf\xe9;1.0\nCaf\xf0;3.0\n", {}, "{Caf�=1.0/2.0/3.0}"),
    "cut_character_last": (b"x;Caf\xe9;1.0\n", {"split": "last"}, "{x;Caf�=1.0/1.0/1.0}"),
}


@pytest.mark.parametrize("case", CASES)
def test_report(spark, write, case):
    text, options, expected = CASES[case]
    rows = run(spark, write(text), **options).orderBy("part").collect()
    assert [r.part for r in rows] == list(range(len(rows)))
    assert "".join(r.report for r in rows) == expected


@pytest.mark.parametrize(
    "text",
    [b"A;1.0\nnosemi\n", b"A;abc\n", b"A;\n", b"A;1.25\n", b"A;B;3.0\n", b"A;1.0\n\n"],
)
@pytest.mark.parametrize("number", ["tenths", "float"])
def test_fail_mode(spark, write, text, number):
    if number == "float" and text == b"A;1.25\n":
        pytest.skip("any number of decimals is a float")
    with pytest.raises(Exception, match="malformed record"):
        run(spark, write(text), mode="fail", number=number).collect()


def test_fail_mode_keeps_good_input(spark, write):
    assert run(spark, write(b"A;1.0\n"), mode="fail").first().report == "{A=1.0/1.0/1.0}"


def test_quarantine(spark, write):
    lines = read_lines(spark, write(b"A;1.0\nnosemi\nA;\nA;x\n\nA;B;1.0\nA;;\n"))
    expected = [
        ("", "no_delimiter"),
        ("A;", "empty_value"),
        ("A;;", "bad_value"),
        ("A;B;1.0", "bad_value"),
        ("A;x", "bad_value"),
        ("nosemi", "no_delimiter"),
    ]
    assert sorted(tuple(r) for r in quarantine(lines).collect()) == expected
    at_last = [tuple(r) for r in quarantine(lines, split="last").collect()]
    assert ("A;;", "empty_value") in at_last and ("A;B;1.0", "bad_value") not in at_last
    assert sorted(tuple(r) for r in quarantine(lines, number="float").collect()) == expected


def test_strict_encoding(spark, write):
    with pytest.raises(Exception, match="INVALID_UTF8_STRING"):
        run(spark, write(b"L\xff;1.0\n"), encoding="strict").collect()
    assert run(spark, write("é;1.0\n".encode()), encoding="strict").first().report == "{é=1.0/1.0/1.0}"


def test_bytes_encoding_is_checked_when_rendered(spark, write):
    path = write(b"L\xff;1.0\nL\xfe;2.0\n")
    assert rollup(spark, path, encoding="bytes").count() == 2
    with pytest.raises(Exception, match="INVALID_UTF8_STRING"):
        run(spark, path, encoding="bytes").collect()


def test_sorted_result(spark, write):
    rows = rollup(spark, write(b"B;1.0\nA;1.0\nA;3.0\n")).collect()
    assert [tuple(r) for r in rows] == [("A", 1.0, 2.0, 3.0, 2), ("B", 1.0, 1.0, 1.0, 1)]
    rows = rollup(spark, write(b"B;1.5\nA;1\n"), number="float").toLocalIterator()
    assert [tuple(r) for r in rows] == [("A", 1.0, 1.0, 1.0, 1), ("B", 1.5, 1.5, 1.5, 1)]


@pytest.mark.parametrize(
    "option",
    [
        {"mode": "skip"},
        {"split": "middle"},
        {"encoding": "utf-16"},
        {"number": "int"},
        {"delimiter": ";;"},
        {"reader": "json"},
    ],
)
def test_unknown_options(spark, write, option):
    with pytest.raises(ValueError):
        run(spark, write(b"A;1.0\n"), **option)
