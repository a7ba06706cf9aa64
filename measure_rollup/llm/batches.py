"""Arrow batches of few rows, so that an executor holds little beside its heap.

A batch is held several times: by the JVM and by the Python worker, as input and as output. With
texts in it, Spark's 10,000 rows are tens of megabytes each time, for each task, and a worker that
waits for its next task keeps what it needed for the last.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import SparkSession

ROWS = 1_000
_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def few_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows, at most ``ROWS`` at once; Arrow's free memory goes back when the last are done."""
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield batch.slice(at, ROWS)
    finally:
        pa.default_memory_pool().release_unused()


@contextmanager
def sent_in_few_rows(spark: SparkSession) -> Iterator[None]:
    """What is computed in here sends Python workers at most ``ROWS`` rows at once."""
    before = spark.conf.get(_SETTING)
    if 0 < int(before) <= ROWS:
        yield
        return
    spark.conf.set(_SETTING, str(ROWS))
    try:
        yield
    finally:
        spark.conf.set(_SETTING, before)
