"""The whole query, from a path to the result."""

from measure_rollup.plans.files import drop_old_parts, file_totals, update_files
from measure_rollup.plans.rollup import rollup, run, summary_of, write_run

__all__ = ["drop_old_parts", "file_totals", "rollup", "run", "summary_of", "update_files", "write_run"]
