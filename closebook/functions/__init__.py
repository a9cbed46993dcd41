"""Column functions (macros) and the calendar spine."""

from closebook.functions.columns import (  # noqa: F401
    MONEY, RATE, cents_to_dollars, day_of_week, half_up, make_date, mean_money,
    money, month_of, ratio4, surrogate_key, title_case, week_of_year,
)
from closebook.functions.calendar import calendar_columns, date_spine  # noqa: F401
