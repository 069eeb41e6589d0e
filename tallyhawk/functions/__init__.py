from tallyhawk.functions.scalars import (
    day_from_name,
    decimal_comma,
    full_name,
    open_end,
    time_of_day,
)

__all__ = ["day_from_name", "decimal_comma", "full_name", "open_end", "time_of_day"]
