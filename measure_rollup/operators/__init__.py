"""DataFrame operators: records, record quality, summaries, order and report."""

from measure_rollup.operators.floats import (
    finalize_float,
    float_state,
    merge_float_states,
    partial_float_state,
)
from measure_rollup.operators.ordering import by_name, numbered
from measure_rollup.operators.quality import (
    apply_mode,
    classify,
    counted,
    fail_on_malformed,
    line_counts,
    quarantine,
)
from measure_rollup.operators.records import parse_records, split_line
from measure_rollup.operators.report import (
    entries,
    report_line,
    report_parts,
    write_entries,
    write_report,
)
from measure_rollup.operators.summary import (
    finalize,
    merge_summaries,
    partial_summary,
    read_summaries,
    summarize,
    summarize_float,
    write_summary,
)

__all__ = [
    "apply_mode",
    "by_name",
    "classify",
    "counted",
    "entries",
    "fail_on_malformed",
    "finalize",
    "finalize_float",
    "float_state",
    "line_counts",
    "merge_float_states",
    "merge_summaries",
    "numbered",
    "parse_records",
    "partial_float_state",
    "partial_summary",
    "quarantine",
    "read_summaries",
    "report_line",
    "report_parts",
    "split_line",
    "summarize",
    "summarize_float",
    "write_entries",
    "write_report",
    "write_summary",
]
