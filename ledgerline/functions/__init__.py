"""Column-level building blocks (all JVM-side ``pyspark.sql.functions``)."""

from ledgerline.functions.columns import (
    active_flag, customer_name, discount_flag, money, money_sum, round_half_up,
    to_utc_columns, unit_price,
)
from ledgerline.functions.dates import (
    month_key, previous_month, rolling_window, rolling_window_predicate,
)

__all__ = [
    "active_flag", "customer_name", "discount_flag", "money", "money_sum",
    "round_half_up", "to_utc_columns", "unit_price", "month_key",
    "previous_month", "rolling_window", "rolling_window_predicate",
]
