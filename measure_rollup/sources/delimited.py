"""Delimited scan with a fixed schema: headerless ``name;value``, nothing inferred."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measure_rollup.sources.lines import read_lines

CORRUPT = "malformed"

MODES = ("drop", "fail", "quarantine")


def read_measurements(
    spark: SparkSession,
    path: str | list[str],
    mode: str = "drop",
    delimiter: str = ";",
    value_type: str = "float",
) -> DataFrame:
    """Scan to ``(name string, value <value_type>)``.

    Records are the lines of :func:`read_lines`: only ``\\n`` ends one. A record is well
    formed with exactly two fields and a value that is empty or castable; so a blank line is
    malformed. Quotes and all other characters are ordinary, invalid UTF-8 in a name is
    replaced. An empty name or value is null, and so is NaN. With ``mode='quarantine'`` a
    third column, ``malformed``, holds the text of each malformed record and is null
    otherwise; ``drop`` leaves these records out, ``fail`` stops at the first one read,
    whatever columns are used.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if len(delimiter) != 1:
        raise ValueError("the delimiter must be one character")
    # A third field is looked for, but a line of any number of delimiters makes no more.
    fields = read_lines(spark, path).select("value", F.split("value", re.escape(delimiter), 3).alias("fields"))
    text = F.when(F.size("fields") == 2, F.col("fields")[1])
    parsed = fields.select(
        "value",
        F.nullif(F.make_valid_utf8(F.col("fields")[0]), F.lit("")).alias("name"),
        text.alias("text"),
        text.try_cast(value_type).alias("number"),
    )
    good = F.col("text").isNotNull() & ((F.col("text") == "") | F.col("number").isNotNull())
    number = F.col("number")
    if value_type in ("float", "double"):
        number = F.nullif(number, F.lit(float("nan")).cast(value_type))
    malformed = F.when(~good | F.col("text").isNull(), F.col("value"))
    scan = parsed.select(
        F.when(malformed.isNull(), F.col("name")).alias("name"),
        F.when(malformed.isNull(), number).alias("value"),
        malformed.alias(CORRUPT),
    )
    if mode == "quarantine":
        return scan
    return well_formed_rows(scan, stop=mode == "fail")


def well_formed_rows(scan: DataFrame, stop: bool = False) -> DataFrame:
    """The kept records of a ``mode='quarantine'`` scan; with ``stop``, a malformed one raises."""
    # A generator stays where it is, so that the line is split once and no check is pruned.
    row = F.array(F.struct(*(c for c in scan.columns if c != CORRUPT)))
    kept = F.when(F.col(CORRUPT).isNull(), row)
    if stop:
        message = F.concat(F.lit("malformed record: "), F.make_valid_utf8(CORRUPT))
        kept = kept.otherwise(F.raise_error(message).cast(scan.select(row).schema[0].dataType))
    return scan.select(F.inline(kept))
