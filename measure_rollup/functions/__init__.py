"""Column expressions: number parsing, number text and text encoding."""

from measure_rollup.functions.encoding import POLICIES, decode_name, valid_lines
from measure_rollup.functions.numbers import (
    f32_mean,
    f32_text,
    f32_units,
    mean_tenths,
    mean_units,
    tenths_text,
    to_float,
    to_tenths,
    units,
)

__all__ = [
    "POLICIES",
    "decode_name",
    "f32_mean",
    "f32_text",
    "f32_units",
    "mean_tenths",
    "mean_units",
    "tenths_text",
    "to_float",
    "to_tenths",
    "units",
    "valid_lines",
]
