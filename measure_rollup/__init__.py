"""Rollups of keyed measurement text on Spark."""

from measure_rollup.plans import rollup, run, summary_of

__all__ = ["rollup", "run", "summary_of"]
