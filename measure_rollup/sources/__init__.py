"""Scans of line text and delimited text, and the shared scratch folder."""

from measure_rollup.sources.delimited import CORRUPT, read_measurements, well_formed_rows
from measure_rollup.sources.lines import read_lines, stream_lines, write_lines
from measure_rollup.sources.shared import new_folder, settle

__all__ = [
    "CORRUPT",
    "new_folder",
    "read_lines",
    "read_measurements",
    "settle",
    "stream_lines",
    "well_formed_rows",
    "write_lines",
]
