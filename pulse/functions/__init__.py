from pulse.functions.calendar import month_key, shift_hours, stamp, timestamp_literal
from pulse.functions.casts import as_boolean, as_long, as_timestamp, not_before

__all__ = [
    "as_boolean", "as_long", "as_timestamp", "month_key", "not_before", "shift_hours", "stamp",
    "timestamp_literal",
]
