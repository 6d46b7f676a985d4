"""Column-level functions (no UDFs)."""

from ingot.functions.columns import (  # noqa: F401
    category_head,
    category_tail,
    event_date,
    fill_unknown,
    null_tokens,
    over_width,
    parse_event_time,
    range_left_bucket,
    storage_group,
    time_of_day,
)
