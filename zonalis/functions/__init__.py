from .codes import (
    as_integer,
    circuit_zeroes,
    decimal_comma_text,
    format_decimal_comma,
    paste,
    recode,
    section_code,
    slice_text,
)
from .missing import first_by, null_if_nan, skipna_sum, strict_sum, strict_sum_where
from .ratios import exact, percent_of, round_even

__all__ = [
    "as_integer",
    "circuit_zeroes",
    "decimal_comma_text",
    "exact",
    "first_by",
    "format_decimal_comma",
    "null_if_nan",
    "paste",
    "percent_of",
    "recode",
    "round_even",
    "section_code",
    "skipna_sum",
    "slice_text",
    "strict_sum",
    "strict_sum_where",
]
