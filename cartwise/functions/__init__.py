"""Column-level helpers: checks, time arithmetic, text, and skew-safe running sums."""

from cartwise.functions.checks import require_columns, require_timestamp
from cartwise.functions.prefix import global_running_totals, keyed_row_number, keyed_running_sum
from cartwise.functions.selection import exact_median, exact_quantile
from cartwise.functions.text import blank_to_null, parse_request_token, unknown_name
from cartwise.functions.time import add_days, floor_div, micros_to_days, to_micros

__all__ = [
    "add_days",
    "blank_to_null",
    "exact_median",
    "exact_quantile",
    "floor_div",
    "global_running_totals",
    "keyed_row_number",
    "keyed_running_sum",
    "micros_to_days",
    "parse_request_token",
    "require_columns",
    "require_timestamp",
    "to_micros",
    "unknown_name",
]
