"""A summary of files of which some are replaced, added or deleted, without reading the others.

A table of a path has the folders

* ``parts/file=KEY``: the summary of one version of one file; the key is a digest of its path,
  size and time, so a replaced file gets a new part and none is ever changed,
* ``files/version=N``: which files, of what size and time, version N is made of,
* ``totals/version=N``: the merged summary of version N,
* ``_finished/N``: a mark, written last. Readers take the newest version that has one.

An update lists the files, reads those that are new or changed, and merges again only the names
that a new, changed, replaced or deleted file holds: a minimum cannot be taken back, so their
parts are read anew, but no file is. All other names are copied from the version before. An
update that fails leaves the last version as it was and can be repeated.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measure_rollup.operators import (
    merge_float_states,
    merge_summaries,
    parse_records,
    partial_float_state,
    partial_summary,
    read_summaries,
    write_summary,
)
from measure_rollup.operators.summary import SCHEMAS
from measure_rollup.sources import read_lines
from measure_rollup.sources.shared import files_of

_GLOB = re.compile(r"[\[\]{}*?\\]")
_FILES = "path string, size bigint, time timestamp, key string"


class Update(NamedTuple):
    """Numbers of file versions that an update added and took away, and the version it made."""

    added: int
    removed: int
    version: int


def update_files(
    spark: SparkSession,
    path: str | list[str],
    table: str,
    number: str = "tenths",
    split: str = "first",
    encoding: str = "lossy",
    delimiter: str = ";",
) -> Update:
    """Bring ``table`` up to date with the files of ``path``; ``number`` is ``tenths`` or ``exact``.

    A file counts as changed if its size or its time of modification has changed. The options
    are those of ``summary_of`` and have to be the same for all updates of a table.
    """
    versions = _Versions(spark, table)
    last = versions.last()
    version = last + 1
    now = f"{table}/files/version={version}"
    _listed(spark, path).write.mode("overwrite").parquet(now)
    files, before = _files(spark, table, version), _files(spark, table, last)
    new = files.join(before, "key", "left_anti")
    gone = before.join(files, "key", "left_anti").select("key")
    # the list of files is the driver's in any scan
    paths = [row.path for row in new.select("path").collect()]
    if paths:
        _add_parts(spark, paths, new, table, number, split, encoding, delimiter)
    n_gone = gone.count()
    if not paths and not n_gone and last >= 0:
        versions.remove(f"files/version={version}")
        return Update(0, 0, last)

    versions.make("parts")
    merge = merge_summaries if number == "tenths" else merge_float_states
    parts = read_summaries(spark, f"{table}/parts", part="file", number=number)
    touched = parts.join(new.select("key").unionByName(gone), parts["file"] == F.col("key"), "left_semi")
    names = touched.select("name").distinct()
    again = parts.join(files.select("key"), parts["file"] == F.col("key"), "left_semi").join(
        names, parts["name"].eqNullSafe(names["name"]), "left_semi"
    )
    kept = _totals(spark, table, last, number)
    kept = kept.join(names, kept["name"].eqNullSafe(names["name"]), "left_anti")
    merge(again).unionByName(kept).write.mode("overwrite").parquet(f"{table}/totals/version={version}")
    versions.finish(version)
    return Update(len(paths), n_gone, version)


def file_totals(spark: SparkSession, table: str, number: str = "tenths") -> DataFrame:
    """The summary of the newest version; for ``exact``, the state that ``finalize_float`` takes."""
    return _totals(spark, table, _Versions(spark, table).last(), number)


def drop_old_parts(spark: SparkSession, table: str) -> int:
    """Delete the versions before the newest, and the parts that it does not use; their number.

    For when no reader uses them any more.
    """
    versions = _Versions(spark, table)
    last = versions.last()
    for version in versions.all()[:-1]:
        for folder in (f"_finished/{version}", f"files/version={version}", f"totals/version={version}"):
            versions.remove(folder)
    used = {row.key for row in _files(spark, table, last).select("key").collect()}
    unused = [key for key in versions.parts() if key not in used]
    for key in unused:
        versions.remove(f"parts/file={key}")
    return len(unused)


def _listed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The files of a path, of which only the list is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    key = F.sha2(F.concat_ws("/", F.unix_micros("modificationTime"), "length", "path"), 256)
    return found.select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("time"), key.alias("key")
    ).where(F.col("size") > 0)


def _add_parts(spark, paths, new, table, number, split, encoding, delimiter) -> None:
    lines = read_lines(spark, [_GLOB.sub(r"\\\g<0>", path) for path in paths], place=True)
    # both are addresses, but one is escaped
    file = F.try_url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))
    keys = new.select(_plain(F.col("path")).alias("_path"), "key")
    records = parse_records(lines, split, delimiter, "tenths" if number == "tenths" else "float", encoding)
    records = records.withColumn("_path", _plain(file))
    partial = partial_summary if number == "tenths" else partial_float_state
    per_file = partial(records, F.col("_path"), "_path")
    write_summary(per_file.join(keys, "_path").drop("_path").withColumnRenamed("key", "file"), f"{table}/parts", "file")


def _plain(address):
    """The address without the different numbers of slashes behind its scheme."""
    return F.regexp_replace(address, "^([a-zA-Z0-9+.-]+):/+", "$1:/")


def _files(spark: SparkSession, table: str, version: int) -> DataFrame:
    if version < 0:
        return spark.createDataFrame([], _FILES)
    return spark.read.schema(_FILES).parquet(f"{table}/files/version={version}")


def _totals(spark: SparkSession, table: str, version: int, number: str) -> DataFrame:
    if version < 0:
        return spark.createDataFrame([], SCHEMAS[number])
    return spark.read.schema(SCHEMAS[number]).parquet(f"{table}/totals/version={version}")


class _Versions:
    """The finished versions of a table, by marks of its own."""

    def __init__(self, spark: SparkSession, table: str):
        self.table = table
        self.path, self.system = files_of(spark, table)

    def all(self) -> list[int]:
        found = self.system.globStatus(self.path(f"{self.table}/_finished/*")) or []
        return sorted(int(f.getPath().getName()) for f in found)

    def last(self) -> int:
        return max(self.all(), default=-1)

    def parts(self) -> list[str]:
        found = self.system.globStatus(self.path(f"{self.table}/parts/file=*")) or []
        return [f.getPath().getName().partition("=")[2] for f in found]

    def finish(self, version: int) -> None:
        self.system.create(self.path(f"{self.table}/_finished/{version}"), True).close()

    def make(self, folder: str) -> None:
        self.system.mkdirs(self.path(f"{self.table}/{folder}"))

    def remove(self, folder: str) -> None:
        self.system.delete(self.path(f"{self.table}/{folder}"), True)
