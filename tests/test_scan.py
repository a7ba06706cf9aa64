"""Every record exactly once, whatever the split of the file."""

import pytest
from pyspark.sql import functions as F

from measure_rollup import rollup, run, summary_of
from measure_rollup.operators import apply_mode, parse_records, summarize_float
from measure_rollup.sources import CORRUPT, read_lines, read_measurements, well_formed_rows, write_lines

SPLITS = ["64k", "1m", "128m"]


@pytest.fixture(scope="module")
def big(tmp_path_factory):
    """One file of 200,000 lines, with marked first and last records."""
    folder = tmp_path_factory.mktemp("big")
    body = "".join(f"n{i % 413};{'-' if i % 2 else ''}{i % 100}.{i % 10}\n" for i in range(200_000))
    paths = {}
    for ending in ("\n", ""):
        path = folder / f"lines{len(ending)}.txt"
        path.write_text("first;1.1\n" + body + "last;2.2" + ending)
        paths[ending] = str(path)
    return paths


@pytest.fixture
def split_size(spark, request):
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, request.param)
    yield request.param
    spark.conf.set(setting, before)


@pytest.mark.parametrize("split_size", SPLITS, indirect=True)
@pytest.mark.parametrize("ending", ["\n", ""], ids=["newline", "no_newline"])
def test_text_splits(spark, big, split_size, ending):
    lines = read_lines(spark, big[ending])
    if split_size == "64k":
        assert lines.rdd.getNumPartitions() > 20
    rows = {r.name: r for r in summary_of(lines, mode="fail").collect()}
    assert (rows["first"].sum_t, rows["first"].cnt) == (11, 1)
    assert (rows["last"].sum_t, rows["last"].cnt) == (22, 1)
    assert sum(r.cnt for r in rows.values()) == 200_002
    assert sum(r.sum_t for r in rows.values()) == 33 + sum(
        (-1 if i % 2 else 1) * (i % 100 * 10 + i % 10) for i in range(200_000)
    )


@pytest.mark.parametrize("split_size", SPLITS, indirect=True)
@pytest.mark.parametrize("ending", ["\n", ""], ids=["newline", "no_newline"])
def test_csv_splits(spark, big, split_size, ending):
    scan = read_measurements(spark, big[ending], mode="fail", value_type="decimal(18,1)")
    total, names, count = scan.agg(F.sum("value"), F.count_distinct("name"), F.count("*")).first()
    assert (names, count) == (415, 200_002)
    assert int(total * 10) == 33 + sum((-1 if i % 2 else 1) * (i % 100 * 10 + i % 10) for i in range(200_000))


def test_paths(spark, write, tmp_path):
    one, two = write(b"A;1.0\n"), write(b"A;3.0\n")
    assert rollup(spark, one).first().cnt == 1
    for path in ([one, two], str(tmp_path), str(tmp_path / "*.txt"), one.rsplit("/", 1)[0] + "/*"):
        assert rollup(spark, path).first().asDict() == {"name": "A", "min": 1.0, "mean": 2.0, "max": 3.0, "cnt": 2}


def test_bytes_survive_writing_and_reading(spark, tmp_path):
    raw = [b"L\xff;1.0", b"\xe9;2.0", b"a\rb;3.0", b"", "é".encode(), b"\x00;"]
    frame = spark.createDataFrame([(bytearray(r),) for r in raw], "raw binary")
    write_lines(frame.select(F.col("raw").cast("string").alias("value")), str(tmp_path / "raw"))
    back = read_lines(spark, str(tmp_path / "raw")).select(F.col("value").cast("binary").alias("raw")).collect()
    assert sorted(bytes(r.raw) for r in back) == sorted(raw)


def test_csv_modes(spark, write):
    path = write(b'A;1.0\nnosemi\nA;x\nA;\n"Q";2.5\nA;1.0;2\n\n;4.0\nB\\;5.0\n')
    dropped = [tuple(r) for r in read_measurements(spark, path, "drop").collect()]
    assert dropped == [("A", 1.0), ("A", None), ('"Q"', 2.5), (None, 4.0), ("B\\", 5.0)]
    assert read_measurements(spark, path).count() == 5
    assert len(read_measurements(spark, path).select("name").collect()) == 5
    assert len(read_measurements(spark, path).select("value").collect()) == 5
    scan = read_measurements(spark, path, "quarantine")
    assert [tuple(r) for r in well_formed_rows(scan).collect()] == dropped
    malformed = scan.where(F.col(CORRUPT).isNotNull())
    assert [r[0] for r in malformed.select(CORRUPT).collect()] == ["nosemi", "A;x", "A;1.0;2", ""]
    assert malformed.count() == 4
    for bad in (b"nosemi\n", b"A;x\n", b"A;1.0;2\n"):
        scan = read_measurements(spark, write(b"A;1.0\n" + bad), "fail")
        for use in (scan.collect, scan.count, scan.select("name").collect, scan.select("value").collect):
            with pytest.raises(Exception, match="malformed record"):
                use()
    with pytest.raises(ValueError):
        read_measurements(spark, path, "skip")


def test_csv_damaged_text_is_replaced(spark, write):
    rows = read_measurements(spark, write(b"L\xff;1.0\nL\xfe;2.0\n")).collect()
    assert {r.name for r in rows} == {"L�"}


def test_csv_summary(spark, write):
    scan = read_measurements(spark, write(b"A;1.5\nA;\nB;\nA;2.5\n"))
    assert [tuple(r) for r in summarize_float(scan, value="value").collect()] == [("A", 1.5, 2.0, 2.5, 2)]


def test_csv_lines_that_a_csv_reader_takes_otherwise(spark, write):
    path = write(b"A" + b";" * 30_000 + b"\nA\rB;1.0\n\x00Q;2.0\nA;NaN\nA; 3.0\n")
    assert [tuple(r) for r in read_measurements(spark, path).collect()] == [
        ("A\rB", 1.0),
        ("\x00Q", 2.0),
        ("A", None),
        ("A", 3.0),
    ]
    malformed = read_measurements(spark, path, "quarantine").where(F.col(CORRUPT).isNotNull())
    assert [r[0] for r in malformed.select(CORRUPT).collect()] == ["A" + ";" * 30_000]
    with pytest.raises(Exception, match="malformed record"):
        read_measurements(spark, path, "fail").count()


@pytest.mark.parametrize("delimiter", ["|", ".", "\\", "$"])
def test_csv_delimiter_is_no_pattern(spark, write, delimiter):
    path = write(f"A{delimiter}1\nB;2\n".encode())
    assert [tuple(r) for r in read_measurements(spark, path, delimiter=delimiter).collect()] == [("A", 1.0)]


def test_key_value_folders(spark, tmp_path):
    for name in ("value=x", "name=x", "t=1"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "lines.txt").write_text("A;1.0\n")
    assert rollup(spark, str(tmp_path)).first().asDict() == {"name": "A", "min": 1.0, "mean": 1.0, "max": 1.0, "cnt": 3}


def test_fail_and_strict_stop_whatever_is_used(spark):
    lines = spark.createDataFrame([(bytearray(b),) for b in (b"A;1.0", b"nosemi", b"L\xff;1.0")], "raw binary")
    lines = lines.select(F.col("raw").cast("string").alias("value"))
    good = lines.where("value = 'A;1.0'")
    for make, message in (
        (lambda d: apply_mode(parse_records(d), "fail"), "malformed record"),
        (lambda d: parse_records(d, encoding="strict"), "INVALID_UTF8_STRING"),
    ):
        for use in (lambda d: d.count(), lambda d: d.select("name").collect(), lambda d: d.select("t").collect()):
            use(make(good))
            with pytest.raises(Exception, match=message):
                use(make(lines))


def test_options_that_do_not_go_together(spark, write):
    path = write(b"A;1.0\n")
    for options in (
        {"reader": "csv", "split": "last"},
        {"reader": "csv", "encoding": "strict"},
        {"reader": "csv", "number": "float"},
        {"reader": "csv", "render": "exact"},
        {"number": "float", "render": "exact"},
        {"render": "float"},
        {"reader": "json"},
    ):
        with pytest.raises(ValueError):
            run(spark, path, **options)
