"""Rendering: one entry per name, and the report ``{a=min/mean/max, b=min/mean/max}``.

The report has two forms, chosen by the caller and never by size: ``report_parts``, a row per
name, for any number of names, and ``report_line``, a single string.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measure_rollup.functions import f32_mean, f32_text, f32_units, mean_tenths, tenths_text
from measure_rollup.operators.ordering import by_name, numbered
from measure_rollup.sources.joined import join_files, part_files
from measure_rollup.sources.shared import files_of


def entries(summary: DataFrame, render: str = "exact") -> DataFrame:
    """``(name, entry)`` with ``entry`` = ``name=min/mean/max``, one digit each.

    ``exact``: tenths summary, mean rounded exactly, halves away from zero, no ``-0.0``.
    ``f32``: tenths summary, every step in 32-bit floats.
    ``float``: summary of the float path. Raises for a name that is not valid UTF-8.
    """
    if render == "exact":
        low, high = tenths_text(F.col("min_t")), tenths_text(F.col("max_t"))
        mean = tenths_text(mean_tenths(F.col("sum_t"), F.col("cnt")))
    elif render == "f32":
        low, high = f32_text(f32_units(F.col("min_t"))), f32_text(f32_units(F.col("max_t")))
        mean = f32_text(f32_mean(F.col("sum_t"), F.col("cnt")))
    elif render == "float":
        low, mean, high = (f32_text(F.col(c).cast("float")) for c in ("min", "mean", "max"))
    else:
        raise ValueError(f"render must be 'exact', 'f32' or 'float', not {render!r}")
    name = F.coalesce(F.validate_utf8("name"), F.lit(""))
    slash = F.lit("/")
    return summary.select(name.alias("name"), F.concat(name, F.lit("="), low, slash, mean, slash, high).alias("entry"))


def report_line(summary: DataFrame, render: str = "exact") -> DataFrame:
    """The report as one row ``(part, report)`` with ``part`` 0.

    A single string value, which one task joins: for reports that fit one. Nothing is
    computed until the caller asks for it.
    """
    line = F.coalesce(F.expr("listagg(entry, ', ') within group (order by name)"), F.lit(""))
    whole = entries(summary, render).agg(F.concat(F.lit("{"), line, F.lit("}")).alias("report"))
    return whole.select(F.lit(0).cast("bigint").alias("part"), "report")


def report_parts(summary: DataFrame, render: str = "exact") -> DataFrame:
    """The report as ``(part, report)``, one row per name for any number of names.

    The texts in the order of ``part`` make up the report. Without names it is one row,
    ``{}``. The entries are computed, sorted and stored here, once.
    """
    rows = numbered(entries(summary, render))
    position = F.col("pos")
    opening = F.when(position == 1, F.lit("{")).otherwise(F.lit(", "))
    closing = F.when(position == F.col("total"), F.lit("}")).otherwise(F.lit(""))
    parts = rows.select(
        (position - 1).alias("part"), F.concat(opening, F.col("entry"), closing).alias("report")
    )
    empty = rows.agg(F.count("*").alias("n")).where(F.col("n") == 0)
    return parts.unionByName(empty.select(F.lit(0).cast("bigint").alias("part"), F.lit("{}").alias("report")))


def write_report(summary: DataFrame, path: str, render: str = "exact", join: bool = True) -> None:
    """Write the report as one line, in one file whose bytes are those of :func:`report_line`.

    The entries are sorted in ranges and written by as many tasks, each with ``, `` behind it;
    the last one, with the closing brace behind it, is a file of its own. The files are then
    joined in order: by the file system where it can link files to one (HDFS), else by copying
    their bytes through a buffer, as such a store takes a file from one writer. No task and
    no memory holds the line. With ``join=False`` the files stay apart, in the folder ``path``; their
    bytes, in the order of their names, are the report.
    """
    spark = summary.sparkSession
    folder = path if not join else f"{path}.{uuid.uuid4().hex}.parts"
    rows = numbered(entries(summary, render))
    opening = F.when(F.col("pos") == 1, F.lit("{")).otherwise(F.lit(""))
    line = F.concat(opening, F.col("entry")).alias("value")
    # rows are in the order of their positions, within and across the partitions
    rows.where(F.col("pos") < F.col("total")).select(line).write.option("lineSep", ", ").text(f"{folder}/0-entries")
    last = rows.where(F.col("pos") == F.col("total")).select(line)
    empty = rows.agg(F.count("*").alias("n")).where(F.col("n") == 0).select(F.lit("{").alias("value"))
    last.unionByName(empty).coalesce(1).write.option("lineSep", "}").text(f"{folder}/1-last")
    if join:
        parts = [file for part in ("0-entries", "1-last") for file in part_files(spark, f"{folder}/{part}")]
        join_files(spark, parts, path)
        of, system = files_of(spark, folder)
        system.delete(of(folder), True)


def write_entries(summary: DataFrame, path: str, render: str = "exact") -> None:
    """Write one entry per line, in name order over the files, for any number of names."""
    by_name(entries(summary, render)).select("entry").write.option("lineSep", "\n").text(path)
