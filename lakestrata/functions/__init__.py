from lakestrata.functions.literal import literal_table
from lakestrata.functions.text import (
    child_table_name,
    event_table_name,
    literal_pattern,
    snake_case,
    split_part,
)
from lakestrata.functions.timefmt import (
    add_day,
    day_bucket,
    day_text,
    hour_bucket,
    hour_text,
    iso_text,
    parse_ts,
    second_text,
    us_week_of_year,
)

__all__ = [
    "add_day",
    "child_table_name",
    "day_bucket",
    "day_text",
    "event_table_name",
    "hour_bucket",
    "hour_text",
    "iso_text",
    "literal_table",
    "literal_pattern",
    "parse_ts",
    "second_text",
    "snake_case",
    "split_part",
    "us_week_of_year",
]
