"""Line scans: one row ``value string`` per record, bytes kept as they are.

Splitting a file into ranges, and giving every record to exactly one task, is done by
Spark's text source (``spark.sql.files.maxPartitionBytes``). Rows are read one by one,
so a task's memory does not depend on the size of its range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str | list[str], place: bool = False) -> DataFrame:
    """Lines of a file, a folder, a glob or a list of these.

    Folders are read with all folders below them, and a folder named ``key=value`` is a
    folder like any other, not a column. With ``place``, a line comes with its ``file`` and
    the first byte, ``block``, of the range of the file that its task reads.
    """
    return _placed(_without_cr(spark.read.options(lineSep="\n", recursiveFileLookup=True).text(path)), place)


def stream_lines(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: str | None = None,
    place: bool = False,
) -> DataFrame:
    """Lines of the files that keep arriving in a folder.

    ``max_files`` / ``max_bytes`` bound one micro-batch; give at most one of them.
    """
    reader = spark.readStream.options(lineSep="\n", recursiveFileLookup=True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return _placed(_without_cr(reader.text(path)), place)


def write_lines(lines: DataFrame, path: str) -> None:
    """Write the column ``value`` as text files, one line per row."""
    lines.select("value").write.option("lineSep", "\n").text(path)


def _placed(lines: DataFrame, place: bool) -> DataFrame:
    if not place:
        return lines
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return lines.select("value", file.alias("file"), block.alias("block"))


def _without_cr(lines: DataFrame) -> DataFrame:
    # Only "\n" ends a record, so a name may hold a lone "\r"; the "\r" of "\r\n" goes.
    value = F.col("value")
    cut = F.substring(value.cast("binary"), 1, F.octet_length(value) - 1).cast("string")
    return lines.withColumn("value", F.when(_ends_with_cr(value), cut).otherwise(value))


def _ends_with_cr(value: Column) -> Column:
    return F.endswith(value, F.lit("\r"))
