"""Path to summary, to sorted result, to report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from measure_rollup.operators import (
    by_name,
    fail_on_malformed,
    finalize,
    finalize_float,
    float_state,
    parse_records,
    report_parts,
    summarize,
    summarize_float,
    write_report,
)
from measure_rollup.operators.quality import MODES
from measure_rollup.sources import read_lines, read_measurements, well_formed_rows


def summary_of(
    lines: DataFrame,
    split: str = "first",
    mode: str = "drop",
    encoding: str = "lossy",
    number: str = "tenths",
    delimiter: str = ";",
) -> DataFrame:
    """Lines, batch or streaming, to a summary: one pass, one shuffle of partial states.

    With ``mode='quarantine'`` the summary is that of ``drop``; the malformed lines are
    ``quarantine(lines, ...)``. ``number='exact'`` reads the values of ``float``, and its sums do
    not depend on the order of addition. Under ``fail`` lines that were read with their place
    name it in the error.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    records = parse_records(lines, split, delimiter, "float" if number == "exact" else number, encoding)
    if mode == "fail":
        records = fail_on_malformed(records)
    if number == "exact":
        return finalize_float(float_state(records))
    return summarize(records) if number == "tenths" else summarize_float(records)


def rollup(spark: SparkSession, path: str | list[str], reader: str = "text", **options) -> DataFrame:
    """Path to ``(name, min, mean, max, cnt)`` in name order.

    ``reader='text'`` takes the options of :func:`summary_of`; ``reader='csv'``, the
    delimited scan with 32-bit floats, takes ``mode`` and ``delimiter``; its malformed
    records are those of ``read_measurements(spark, path, "quarantine")``.
    """
    summary, is_float = _summary(spark, path, reader, options)
    return by_name(summary if is_float else finalize(summary))


def run(
    spark: SparkSession, path: str | list[str], reader: str = "text", render: str | None = None, **options
) -> DataFrame:
    """Path to report, a row ``(part, report)`` per name, with the options of :func:`rollup`."""
    check_options(reader, render, options)
    summary, is_float = _summary(spark, path, reader, options)
    return report_parts(summary, render or ("float" if is_float else "exact"))


def write_run(
    spark: SparkSession, path: str | list[str], out: str, reader: str = "text", render: str | None = None, **options
) -> None:
    """Path to the file ``out`` with the report as one line, with the options of :func:`run`."""
    check_options(reader, render, options)
    summary, is_float = _summary(spark, path, reader, options)
    write_report(summary, out, render or ("float" if is_float else "exact"))


def check_options(reader: str = "text", render: str | None = None, options: dict | None = None) -> None:
    """Raise ``ValueError`` for options that do not go together."""
    given = options or {}
    if reader not in ("text", "csv"):
        raise ValueError(f"reader must be 'text' or 'csv', not {reader!r}")
    text_only = sorted({"split", "encoding", "number"} & given.keys())
    if reader == "csv" and text_only:
        raise ValueError(f"the csv reader does not take {', '.join(text_only)}")
    is_float = reader == "csv" or given.get("number") in ("float", "exact")
    if render is not None and is_float != (render == "float"):
        kept = "32-bit floats" if is_float else "tenths"
        raise ValueError(f"a summary in {kept} cannot be rendered as {render!r}")


def _summary(spark: SparkSession, path: str | list[str], reader: str, options: dict) -> tuple[DataFrame, bool]:
    check_options(reader, None, options)
    if reader == "csv":
        scan = read_measurements(spark, path, **options)
        kept = well_formed_rows(scan) if options.get("mode") == "quarantine" else scan
        return summarize_float(kept, value="value"), True
    return summary_of(read_lines(spark, path, place=options.get("mode") == "fail"), **options), options.get("number") in ("float", "exact")
