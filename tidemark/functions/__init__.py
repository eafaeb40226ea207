"""Column expressions shared by the jobs.  All stay inside the JVM."""

from tidemark.functions.dates import (
    as_bound,
    as_date_bound,
    as_moment,
    calendar_days,
    day_name,
    day_of_week,
    day_start,
    is_night,
    is_weekend,
    month_name,
    month_start,
    parse_us_date,
    seconds_since,
)
from tidemark.functions.values import (
    from_units,
    hash_below,
    iff,
    random_day_range,
    random_days,
    ratio_to_report,
    row_json,
    row_object,
    uniform,
    uniform_value,
    whole_units,
    zero_if_null,
)

__all__ = [
    "as_bound", "as_date_bound", "as_moment", "calendar_days", "day_name", "day_of_week", "day_start",
    "from_units", "hash_below", "iff", "is_night", "is_weekend", "month_name", "month_start", "parse_us_date",
    "random_day_range", "random_days", "ratio_to_report", "row_json", "row_object", "seconds_since", "uniform", "uniform_value", "whole_units",
    "zero_if_null",
]
