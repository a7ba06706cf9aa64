"""What happens to malformed lines: ``drop``, ``fail`` or ``quarantine``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from measure_rollup.operators.records import parse_records

MODES = ("drop", "fail", "quarantine")

STATUSES = ("ok", "no_delimiter", "empty_value", "bad_value")

_PLACE = ("file", "block")


def classify(lines: DataFrame, split: str = "first", delimiter: str = ";", number: str = "tenths") -> DataFrame:
    """Add ``status``: ``ok``, ``no_delimiter``, ``empty_value`` or ``bad_value``.

    Beside it are ``name`` and ``t`` of the lines that are ``ok``.
    """
    records = parse_records(lines, split, delimiter, number)
    return records.withColumn("status", _status(split, delimiter))


def _status(split: str, delimiter: str) -> Column:
    line, end = F.col("value"), F.lit(delimiter)
    nothing_after = F.endswith(line, end)
    if split == "first":
        before_end = F.octet_length(line) - len(delimiter.encode())
        nothing_after &= F.octet_length(F.substring_index(line, delimiter, 1)) == before_end
    return (
        F.when(F.col("t").isNotNull(), F.lit("ok"))
        .when(~F.contains(line, end), F.lit("no_delimiter"))
        .when(nothing_after, F.lit("empty_value"))
        .otherwise(F.lit("bad_value"))
    )


def quarantine(lines: DataFrame, split: str = "first", delimiter: str = ";", number: str = "tenths") -> DataFrame:
    """The malformed lines only, untouched, as ``(value, status)``, with their place if they have one."""
    classified = classify(lines, split, delimiter, number)
    return _rows_where(F.col("status") != "ok", classified.select("value", "status", *_place(classified)))


def counted(records: DataFrame, observation: Observation, split: str = "first", delimiter: str = ";") -> DataFrame:
    """The same records; ``observation`` gets the number of lines of each status.

    ``records`` are those of ``parse_records``. The lines are counted in the pass that an action
    makes over them anyway, and the counts are there once it is done.
    """
    status = _status(split, delimiter)
    return records.observe(observation, *(F.count(F.when(status == s, 1)).alias(s) for s in STATUSES))


def line_counts(observation: Observation) -> dict[str, int]:
    """Lines by status that :func:`counted` has seen, once an action is done."""
    # where no file has a row, Spark leaves the counting out with the rest of the plan
    seen = observation._jo is None or observation._jo.getRow().length()
    return observation.get if seen else dict.fromkeys(STATUSES, 0)


def apply_mode(records: DataFrame, mode: str = "drop") -> DataFrame:
    """Parsed records without the malformed ones; under ``fail`` one of them raises.

    ``quarantine`` keeps the same rows as ``drop``; :func:`quarantine` gives the rest.
    A summary skips malformed records by itself and needs no ``drop``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "fail":
        row = F.array(F.struct("*"))
        kept = F.when(F.col("t").isNotNull(), row).otherwise(_stop(records).cast(records.select(row).schema[0].dataType))
        return records.select(F.inline(kept))
    return _rows_where(F.col("t").isNotNull(), records)


def fail_on_malformed(records: DataFrame) -> DataFrame:
    """The same records; reading the value ``t`` of a malformed one stops the query.

    For callers that use ``t``, such as a summary. ``apply_mode`` stops whatever is used.
    """
    stop = _stop(records).cast(records.schema["t"].dataType)
    return records.withColumn("t", F.when(F.col("t").isNotNull(), F.col("t")).otherwise(stop))


def _place(lines: DataFrame) -> list[str]:
    return [c for c in _PLACE if c in lines.columns]


def _stop(records: DataFrame) -> Column:
    message = [F.lit("malformed record: "), F.make_valid_utf8("value")]
    if _place(records) == list(_PLACE):
        message += [F.lit(" in "), F.col("file"), F.lit(", block at byte "), F.col("block").cast("string")]
    return F.raise_error(F.concat(*message))


def _rows_where(condition: Column, df: DataFrame) -> DataFrame:
    # A filter would be moved below the projections that parse the line and evaluate them
    # a second time. A generator that gives one row or none stays where it is.
    return df.select(F.inline(F.when(condition, F.array(F.struct("*")))))
