"""Column expressions. All are built from JVM functions and stay inside whole-stage codegen."""

from tidemill.functions.amounts import discount_amount, gross_amount, net_amount
from tidemill.functions.calendar import date_key, month_name, weekday_name
from tidemill.functions.keys import surrogate_key
from tidemill.functions.text import cleaned

__all__ = [
    "cleaned",
    "date_key",
    "discount_amount",
    "gross_amount",
    "month_name",
    "net_amount",
    "surrogate_key",
    "weekday_name",
]
