"""Results of steps, written to the shared folder and removed after their last reader."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession

from measure_rollup.llm.batches import sent_in_few_rows
from measure_rollup.sources import new_folder
from measure_rollup.sources.shared import files_of


class Scratch:
    """The steps of one run; with ``few_rows``, Python workers get few rows at once."""

    def __init__(self, spark: SparkSession, purpose: str, few_rows: bool = False):
        self.spark = spark
        self.few_rows = few_rows
        self.path = new_folder(spark, purpose)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write a step and read it from there, so that lost executors cost no more than it."""
        with sent_in_few_rows(self.spark) if self.few_rows else nullcontext():
            df.write.parquet(f"{self.path}/{name}")
        self.free_shuffles()
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def remove(self, *names: str) -> None:
        """Steps that have been read for the last time."""
        of, system = files_of(self.spark, self.path)
        for name in names:
            system.delete(of(f"{self.path}/{name}"), True)

    def free_shuffles(self) -> None:
        """Let go of the shuffle files of steps that are done.

        Spark removes them when the driver has collected what refers to them, by itself only
        every half an hour (spark.cleaner.periodicGC.interval), which is longer than many steps.
        """
        self.spark.sparkContext._jvm.System.gc()
