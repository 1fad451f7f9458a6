from ledgerloom.functions.columns import (
    complete_time,
    day_type,
    hour_of_day,
    parse_date,
    parse_int,
    parse_money,
    percent,
    to_vnd,
)

__all__ = [
    "complete_time",
    "day_type",
    "hour_of_day",
    "parse_date",
    "parse_int",
    "parse_money",
    "percent",
    "to_vnd",
]
