"""Column functions: every one takes and returns Spark ``Column`` values."""

from rosterloom.functions.dates import (
    add_months_to,
    complete_months,
    first_known_period,
    month_end,
    month_key,
    month_start,
    parse_date,
    period_from_file_name,
    previous_month_key,
)
from rosterloom.functions.numbers import parse_boolean, parse_decimal, parse_integer
from rosterloom.functions.text import (
    clean_text,
    header_code,
    label_from_map,
    starts_visibly,
    strip_accents,
    value_code,
    zero_pad,
)

__all__ = [
    "add_months_to",
    "clean_text",
    "complete_months",
    "first_known_period",
    "header_code",
    "label_from_map",
    "month_end",
    "month_key",
    "month_start",
    "parse_boolean",
    "parse_date",
    "parse_decimal",
    "parse_integer",
    "period_from_file_name",
    "previous_month_key",
    "starts_visibly",
    "strip_accents",
    "value_code",
    "zero_pad",
]
