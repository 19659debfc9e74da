from bankflow.functions.columns import (
    EXACT,
    EXACT_FACTOR,
    EXACT_PER_ROW,
    day_gap,
    event_hour,
    event_weekday,
    exact_avg,
    exact_sum,
    id_prefix,
    parse_day,
    percent,
    ratio,
    to_int64,
    year_month,
)

__all__ = [
    "EXACT", "EXACT_FACTOR", "EXACT_PER_ROW", "day_gap", "event_hour", "event_weekday", "exact_avg", "exact_sum",
    "id_prefix", "parse_day", "percent", "ratio", "to_int64", "year_month",
]
