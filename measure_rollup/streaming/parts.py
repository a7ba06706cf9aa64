"""A summary and the malformed lines of files that keep arriving, batch by batch.

Every micro-batch writes two folders: the summary of its own lines, and its malformed lines
with the place each was found at. Then it marks the batch as finished. Readers take finished
batches only, so a line is in both outputs of its batch or in none of them, and in the end in
exactly one of the two. A batch that is run again replaces both folders. What has been read
is kept in ``_progress``; nothing else is kept between batches. As summaries merge, there is no
state store, and the number of shuffle partitions may differ from run to run. Sums are
exact, of tenths and of floats, so the result does not depend on how files fall into batches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measure_rollup.operators import (
    fail_on_malformed,
    float_state,
    merge_float_states,
    merge_summaries,
    parse_records,
    quarantine,
    summarize,
)
from measure_rollup.operators.quality import MODES
from measure_rollup.operators.summary import SCHEMAS
from measure_rollup.sources import stream_lines
from measure_rollup.sources.shared import files_of

_MALFORMED = "value string, status string, file string, block long, batch long"


def run_parts(
    spark: SparkSession,
    source: str,
    output: str,
    mode: str = "drop",
    number: str = "tenths",
    max_files: int | None = None,
    max_bytes: str | None = None,
    split: str = "first",
    encoding: str = "lossy",
    delimiter: str = ";",
) -> None:
    """Fold all files in ``source`` that are new since the last call into the output.

    Returns when they are done. ``number`` is ``tenths`` or ``exact`` (32-bit floats), one for
    all of an output. Under ``mode='quarantine'`` malformed lines are kept in the output.
    """
    _check(number)
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    _Output(spark, output).use(number)
    parsing = {"split": split, "delimiter": delimiter, "number": "tenths" if number == "tenths" else "float"}

    def publish(lines: DataFrame, batch: int) -> None:
        records = parse_records(lines, encoding=encoding, **parsing)
        if mode == "fail":
            records = fail_on_malformed(records)
        summary = summarize(records) if number == "tenths" else float_state(records)
        summary.write.mode("overwrite").parquet(f"{output}/summary/batch={batch}")
        if mode == "quarantine":
            quarantine(lines, **parsing).write.mode("overwrite").parquet(f"{output}/malformed/batch={batch}")
        else:
            spark.createDataFrame([], _MALFORMED).drop("batch").write.mode("overwrite").parquet(
                f"{output}/malformed/batch={batch}"
            )
        _Output(spark, output).finish("batch", batch)

    query = (
        stream_lines(spark, source, max_files, max_bytes, place=True)
        .writeStream.option("checkpointLocation", f"{output}/_progress")
        .trigger(availableNow=True)
        .foreachBatch(publish)
        .start()
    )
    query.awaitTermination()


def latest_parts(spark: SparkSession, output: str, number: str = "tenths") -> DataFrame:
    """The summary of all finished batches; for ``exact``, the state that ``finalize_float`` takes."""
    _check(number)
    files = _Output(spark, output)
    files.use(number)
    snapshot = files.snapshot()
    paths = [f"{output}/summary/batch={n}" for n in files.finished("batch") if n > snapshot]
    if snapshot >= 0:
        paths.append(f"{output}/summary/snapshot={snapshot}")
    schema = SCHEMAS[number]
    # each folder is named, so that none is taken for a column
    parts = [spark.read.schema(schema).parquet(p) for p in paths] or [spark.createDataFrame([], schema)]
    merge = merge_summaries if number == "tenths" else merge_float_states
    return merge(reduce(DataFrame.unionByName, parts))


def malformed_lines(spark: SparkSession, output: str) -> DataFrame:
    """(value, status, file, block, batch) of the malformed lines of all finished batches."""
    paths = [f"{output}/malformed/batch={n}" for n in _Output(spark, output).finished("batch")]
    if not paths:
        return spark.createDataFrame([], _MALFORMED)
    return spark.read.schema(_MALFORMED).option("basePath", f"{output}/malformed").parquet(*paths)


def compact_parts(spark: SparkSession, output: str, number: str = "tenths") -> None:
    """Fold the finished batches into a snapshot, so that readers read each name about once.

    The summaries of batches that an *earlier* snapshot holds are removed, with older snapshots: a
    reader that has just listed the files still finds them. A run that fails anywhere leaves
    the result as it was. Malformed lines stay as they are.
    """
    files = _Output(spark, output)
    before, batches = files.snapshot(), files.finished("batch")
    if not batches or batches[-1] <= before:
        return
    last = batches[-1]
    latest_parts(spark, output, number).write.mode("overwrite").parquet(f"{output}/summary/snapshot={last}")
    files.finish("snapshot", last)
    for batch in batches:
        if batch <= before:
            files.remove(f"summary/batch={batch}")
    for old in files.finished("snapshot"):
        if old < before:
            files.remove(f"_finished/snapshot/{old}")
            files.remove(f"summary/snapshot={old}")


def _check(number: str) -> None:
    if number not in SCHEMAS:
        raise ValueError(f"number must be one of {tuple(SCHEMAS)}, not {number!r}")


class _Output:
    """What is finished in an output, by marks of its own rather than those of a committer."""

    def __init__(self, spark: SparkSession, output: str):
        self.root = output
        self.path, self.system = files_of(spark, output)

    def use(self, number: str) -> None:
        """Note the kind of number, or raise if another one is kept here."""
        for other in SCHEMAS:
            if other != number and self.system.exists(self.path(f"{self.root}/_kept/{other}")):
                raise ValueError(f"{self.root} holds {other} numbers, not {number}")
        self._mark(f"_kept/{number}")

    def finish(self, kind: str, number: int) -> None:
        self._mark(f"_finished/{kind}/{number}")

    def finished(self, kind: str) -> list[int]:
        found = self.system.globStatus(self.path(f"{self.root}/_finished/{kind}/*")) or []
        return sorted(int(f.getPath().getName()) for f in found)

    def snapshot(self) -> int:
        return max(self.finished("snapshot"), default=-1)

    def remove(self, file: str) -> None:
        self.system.delete(self.path(f"{self.root}/{file}"), True)

    def _mark(self, file: str) -> None:
        self.system.create(self.path(f"{self.root}/{file}"), True).close()
