from stockflow.functions.calendar import (
    calendar_attributes,
    date_key,
    day_of_week,
    days_between,
    is_month_end,
    is_weekend,
    iso_date,
    month_label,
    quarter,
    week_number,
)
from stockflow.functions.numeric import (
    MONEY,
    WIDE_MONEY,
    count_where,
    money_out,
    round_half_even,
    round_half_up,
    safe_ratio,
)

__all__ = [
    "MONEY", "WIDE_MONEY", "calendar_attributes", "count_where", "date_key",
    "day_of_week", "days_between", "is_month_end", "is_weekend", "iso_date",
    "money_out", "month_label", "quarter",
    "round_half_even", "round_half_up", "safe_ratio", "week_number",
]
