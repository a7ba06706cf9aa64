"""Splitting and parsing against brute force in Python, on arbitrary bytes."""

import random
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from measure_rollup.functions import mean_tenths, tenths_text, to_tenths
from measure_rollup.operators import apply_mode, classify, parse_records, quarantine, split_line

BYTES = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("raw", T.BinaryType())])


def _lines(spark, raw):
    frame = spark.createDataFrame([(i, bytearray(r)) for i, r in enumerate(raw)], BYTES)
    return frame.select("id", F.col("raw").cast("string").alias("value"))


def _random_lines(seed, count=20_000):
    rng = random.Random(seed)
    pieces = [b";", b".", b"-", b"+", b" ", b"\t", b"\r", b"\x00", b"\x7f", b"\x85", b"e", b"d", b"f", b"_", b"0x"]
    pieces += [b"1", b"23", b"0", b"99", b"5.0", b"-7.3", b"12345678901", b";1.0", b"NaN", b"inf", b"A", b"na me"]
    pieces += [c.encode() for c in ("é", "٣", "😀", "\u00a0", "\u2028")]
    pieces += [b"\xe9", b"\xf0", b"\xff", b"\xc3", b"\x80"]
    return [b"".join(rng.choice(pieces) for _ in range(rng.randint(0, 7))) for _ in range(count)]


def _tenths(text):
    if not re.fullmatch(rb"-?[0-9]+\.[0-9]", text):
        return None
    tenths = int(text.replace(b".", b""))
    return tenths if -(2**63) <= tenths < 2**63 else None


def _expected(line, how):
    head, found, rest = line.partition(b";") if how == "first" else line.rpartition(b";")
    return (head, rest) if found else (None, None)


def test_split_and_tenths(spark):
    raw = _random_lines(1)
    for how in ("first", "last"):
        fields = split_line(_lines(spark, raw), how)
        parsed = parse_records(_lines(spark, raw), how, encoding="bytes").select(
            "id", F.col("name").cast("binary").alias("kept"), "t"
        )
        rows = (
            fields.select("id", F.col("name").cast("binary").alias("name"), F.col("rest").cast("binary").alias("rest"))
            .join(parsed, "id")
            .collect()
        )
        good = 0
        for row in rows:
            name, rest = _expected(raw[row.id], how)
            assert (row.name, row.rest) == (name, rest)
            t = None if rest is None else _tenths(rest)
            assert (row.kept, row.t) == ((name, t) if t is not None else (None, None)), raw[row.id]
            good += t is not None
        assert good > 300


def test_kept_and_quarantined_make_up_the_input(spark):
    raw = _random_lines(2)
    lines = _lines(spark, raw)
    for how in ("first", "last"):
        for number in ("tenths", "float"):
            kept = apply_mode(parse_records(lines, how, number=number)).select(F.col("value").cast("binary").alias("v"))
            out = quarantine(lines, how, number=number).select(F.col("value").cast("binary").alias("v"), "status")
            rows = out.collect()
            assert all(r.status != "ok" for r in rows)
            both = [bytes(r.v) for r in kept.collect()] + [bytes(r.v) for r in rows]
            assert sorted(both) == sorted(raw)


def test_status(spark):
    raw = _random_lines(3)
    for how in ("first", "last"):
        for row in classify(_lines(spark, raw), how).select("id", "status").collect():
            _, rest = _expected(raw[row.id], how)
            if rest is None:
                expected = "no_delimiter"
            elif rest == b"":
                expected = "empty_value"
            else:
                expected = "bad_value" if _tenths(rest) is None else "ok"
            assert row.status == expected, raw[row.id]


def test_tenths_limits(spark):
    cases = {
        "0.0": 0, "-0.0": 0, "00.1": 1, "-99.9": -999, "99999999999999999.9": 999999999999999999,
        "123456789012.3": 1234567890123, "1234567890123.4": 12345678901234,
        "12345678901234.5": 123456789012345, "90071992547409.9": 900719925474099,
        "922337203685477580.7": 2**63 - 1, "922337203685477580.8": None, "-922337203685477580.8": -(2**63),
        "-922337203685477580.9": None, "0000000000000000000000007.5": 75, "-000000000000000000000.1": -1,
        "5.0\n": None, "5.0\r": None, "5.0\u0085": None, "5.": None, "": None, "-": None, ".": None, "5.f": None,
        "5. ": None, "1e1.0": None, "0x1.8": None, "\x7f5.0": None, "1,000.0": None,
    }
    frame = spark.createDataFrame(list(cases.items()), "text string, expected bigint")
    for row in frame.select("text", "expected", to_tenths(F.col("text")).alias("t")).collect():
        assert row.t == row.expected, row.text


def test_every_short_value(spark):
    t = F.col("id").cast("bigint")
    values = spark.range(-100_000, 100_000).select(t.alias("t"), tenths_text(t).alias("text"))
    assert values.where(~to_tenths(F.col("text")).eqNullSafe(F.col("t"))).count() == 0


def test_mean_rounds_half_away_from_zero(spark):
    rng = random.Random(4)
    sizes = [k for k in range(1, 19) for _ in range(300)]
    pairs = [(rng.randint(-(10**k), 10**k), rng.randint(1, 10 ** rng.randint(1, 9))) for k in sizes]
    pairs += [(s * c // 2, c) for s in (-5, -3, -1, 1, 3, 5) for c in (2, 4, 10)] + [(2**63 - 1, 1), (-(2**63) + 1, 1)]
    frame = spark.createDataFrame(pairs, "s bigint, c bigint")
    for row in frame.select("s", "c", mean_tenths(F.col("s"), F.col("c")).cast("bigint").alias("m")).collect():
        size = (2 * abs(row.s) + row.c) // (2 * row.c)
        assert row.m == (-size if row.s < 0 else size)
