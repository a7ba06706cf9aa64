"""Print or write the report of measurement text.

    spark-submit measure_rollup/__main__.py PATH [PATH ...] [--out FILE] [options]
    python -m measure_rollup PATH [PATH ...] [--out FILE] [options]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from measure_rollup.operators import quarantine
from measure_rollup.plans import run
from measure_rollup.plans.rollup import check_options, write_run
from measure_rollup.sources import read_lines


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="measure_rollup", description=__doc__.splitlines()[0])
    parser.add_argument("path", nargs="+", help="files, folders or globs")
    parser.add_argument("--out", help="file to write the report to, instead of printing it")
    parser.add_argument("--quarantine", help="folder to write malformed lines to (text reader)")
    parser.add_argument("--reader", choices=["text", "csv"], default="text")
    parser.add_argument("--split", choices=["first", "last"])
    parser.add_argument("--mode", choices=["drop", "fail", "quarantine"])
    parser.add_argument("--encoding", choices=["lossy", "strict", "bytes"])
    parser.add_argument("--number", choices=["tenths", "float", "exact"])
    parser.add_argument("--delimiter")
    parser.add_argument("--render", choices=["exact", "f32", "float"])
    parsed = parser.parse_args(arguments)
    if parsed.quarantine and parsed.reader != "text":
        parser.error("--quarantine needs the text reader")
    given = {k: v for k, v in vars(parsed).items() if v is not None}
    options = {k: v for k, v in given.items() if k in ("split", "mode", "encoding", "number", "delimiter")}
    try:
        check_options(parsed.reader, parsed.render, options)
    except ValueError as error:
        parser.error(str(error))
    paths, out, malformed = given.pop("path"), given.pop("out", None), given.pop("quarantine", None)

    spark = SparkSession.builder.appName("measure_rollup").getOrCreate()
    if out:
        write_run(spark, paths, out, **given)
    else:
        for row in run(spark, paths, **given).orderBy("part").select("report").toLocalIterator():
            print(row.report, end="")
        print()
    if malformed:
        parsing = {k: v for k, v in given.items() if k in ("split", "delimiter", "number")}
        if parsing.get("number") == "exact":
            parsing["number"] = "float"
        # malformed lines are gathered by status, so that not every scan task writes a file of each
        lines = quarantine(read_lines(spark, paths), **parsing).hint("rebalance", F.col("status"))
        lines.write.partitionBy("status").text(malformed)


if __name__ == "__main__":
    main()
