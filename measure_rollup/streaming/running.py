"""Running summary: the state per name is kept by Structured Streaming.

Each micro-batch writes the names that changed, with their new totals, to its own folder
``batch=N`` of the output. A batch that is run again after a failure replaces its folder,
so the output is right whatever was lost. What has been read, and the state, are kept in
``_progress`` of the output: the two always belong together. ``compact_summary`` keeps the
number of folders bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measure_rollup.plans.rollup import summary_of
from measure_rollup.sources import stream_lines

_SCHEMA = "name string, min_t bigint, max_t bigint, sum_t bigint, cnt bigint, batch bigint"


def run_summary(
    spark: SparkSession,
    source: str,
    output: str,
    max_files: int | None = None,
    max_bytes: str | None = None,
    **options,
) -> None:
    """Fold all files in ``source`` that are new since the last call into the output.

    Returns when they are done. ``max_files`` or ``max_bytes`` bound a micro-batch.
    ``options`` are those of ``summary_of``; values are always tenths, whose sums do not
    depend on the order in which files arrive.
    """
    if options.get("number", "tenths") != "tenths":
        raise ValueError("a running summary is kept in tenths")
    if options.get("mode") == "quarantine":
        raise ValueError("a running summary keeps no malformed lines; run_parts does")

    def publish(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{output}/batch={batch}")

    query = (
        summary_of(stream_lines(spark, source, max_files, max_bytes), **options)
        .writeStream.outputMode("update")
        .option("checkpointLocation", f"{output}/_progress")
        .trigger(availableNow=True)
        .foreachBatch(publish)
        .start()
    )
    query.awaitTermination()


def compact_summary(spark: SparkSession, output: str) -> None:
    """Fold the finished batches into a snapshot, so that readers read each name about once.

    The snapshot of all batches up to N is written beside them and counts once it is complete.
    Only then do the batches go that the snapshot *before* it holds, and older snapshots:
    a reader that has just listed the older files still finds them. A run that fails
    anywhere leaves the result as it was, and can be repeated.
    """
    files = _Files(spark, output)
    snapshot, batches = files.snapshot(), files.batches()
    if not batches or batches[-1] <= snapshot:
        return
    last = batches[-1]
    latest_summary(spark, output).withColumn("batch", F.lit(last).cast("bigint")).write.mode("overwrite").parquet(
        f"{output}/_snapshots/snapshot={last}"
    )
    for batch in batches:
        if batch <= snapshot:
            files.remove(f"batch={batch}")
    for old in files.snapshots():
        if old < snapshot:
            files.remove(f"_snapshots/snapshot={old}")


class _Files:
    """The finished folders of an output, by number."""

    def __init__(self, spark: SparkSession, output: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.root = output
        self.system = self._path(output).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def batches(self) -> list[int]:
        return self._numbers("batch=")

    def snapshots(self) -> list[int]:
        return self._numbers("_snapshots/snapshot=")

    def snapshot(self) -> int:
        return max(self.snapshots(), default=-1)

    def remove(self, folder: str) -> None:
        self.system.delete(self._path(f"{self.root}/{folder}"), True)

    def _numbers(self, start: str) -> list[int]:
        """Folders that a write has finished, by the marks that Spark's committer leaves.

        A batch that the query has committed without one shows that marks are switched off;
        nothing could be told apart then.
        """
        there = self.system.globStatus(self._path(f"{self.root}/{start}*")) or []
        found = self.system.globStatus(self._path(f"{self.root}/{start}*/_SUCCESS")) or []
        numbers = {self._number(f.getPath()) for f in found}
        for n in {self._number(f.getPath()) for f in there} - numbers if start == "batch=" else ():
            if self.system.exists(self._path(f"{self.root}/_progress/commits/{n}")):
                raise RuntimeError(
                    f"{self.root}/{start}{n} is finished but not marked;"
                    " mapreduce.fileoutputcommitter.marksuccessfuljobs must be true"
                )
        return sorted(numbers)

    @staticmethod
    def _number(path) -> int:
        name = path.getParent().getName() if path.getName() == "_SUCCESS" else path.getName()
        return int(str(name).partition("=")[2])


def latest_summary(spark: SparkSession, output: str) -> DataFrame:
    """The current summary: for each name the totals of the last batch that changed it.

    Reads the newest snapshot and the batches after it. Minimum, maximum and count only ever
    move one way, so only the sum has to be taken from the last batch. All four states are
    plain numbers, which hash-aggregate.
    """
    files = _Files(spark, output)
    snapshot = files.snapshot()
    paths = [f"{output}/batch={n}" for n in files.batches() if n > snapshot]
    reader = spark.read.schema(_SCHEMA).option("basePath", output)
    rows = reader.parquet(*paths) if paths else spark.createDataFrame([], _SCHEMA)
    if snapshot >= 0:
        held = spark.read.schema(_SCHEMA).parquet(f"{output}/_snapshots/snapshot={snapshot}")
        rows = rows.unionByName(held)
    return rows.groupBy("name").agg(
        F.min("min_t").alias("min_t"),
        F.max("max_t").alias("max_t"),
        F.max_by("sum_t", "batch").alias("sum_t"),
        F.max("cnt").alias("cnt"),
    )
