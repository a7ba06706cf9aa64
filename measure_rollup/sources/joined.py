"""The files of a folder that Spark wrote, in the order of their partitions, joined to one file."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from measure_rollup.sources.shared import files_of

_PART = re.compile(r"part-(\d+)-.*-c(\d+)\b")
_BUFFER = 1 << 20


def part_files(spark: SparkSession, folder: str) -> list[str]:
    """The part files of a folder that are not empty, in the order of partitions."""
    of, system = files_of(spark, folder)
    found = []
    for status in system.listStatus(of(folder)):
        number = _PART.match(status.getPath().getName())
        if number and status.getLen():
            # by number: from 100,000 partitions on, names are of different lengths
            found.append((int(number[1]), int(number[2]), status.getPath().toString()))
    return [file for *_, file in sorted(found)]


def join_files(spark: SparkSession, files: list[str], target: str) -> None:
    """Make ``files``, in order, the file ``target``, replacing one that is there when all is written.

    File systems that can link files do so without reading them; elsewhere the bytes are copied
    through a buffer.
    """
    of, system = files_of(spark, target)
    begun = of(f"{target}.begun")
    jvm = spark.sparkContext._jvm
    if files and system.hasPathCapability(begun, "fs.capability.paths.concat"):
        _linked(spark, system, [of(f) for f in files], begun)
    else:
        _copied(spark, system, [of(f) for f in files], begun)
    if system.exists(of(target)):
        system.delete(of(target), True)
    _rename(system, begun, of(target))


def _linked(spark: SparkSession, system, files: list, begun) -> None:
    """The first file takes the others in; such stores do not add to an empty one."""
    system.delete(begun, False)
    _rename(system, files[0], begun)
    if files[1:]:
        others = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Path, len(files) - 1)
        for n, file in enumerate(files[1:]):
            others[n] = file
        system.concat(begun, others)


def _copied(spark: SparkSession, system, files: list, begun) -> None:
    copy = spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes
    out = system.create(begun, True)
    try:
        for file in files:
            source = system.open(file)
            try:
                copy(source, out, _BUFFER, False)
            finally:
                source.close()
    finally:
        out.close()


def _rename(system, file, name) -> None:
    if not system.rename(file, name):
        raise OSError(f"could not rename {file.toString()} to {name.toString()}")
