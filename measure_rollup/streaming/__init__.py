"""A running summary over files that keep arriving."""

from measure_rollup.streaming.parts import compact_parts, latest_parts, malformed_lines, run_parts
from measure_rollup.streaming.running import compact_summary, latest_summary, run_summary

__all__ = [
    "compact_parts",
    "compact_summary",
    "latest_parts",
    "latest_summary",
    "malformed_lines",
    "run_parts",
    "run_summary",
]
