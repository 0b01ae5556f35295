"""Report time windows.

``as_of`` replaces the reports' ``CURRENT_DATE()`` so results are
reproducible; ``None`` keeps the clock.  Python dates become literals, which
Catalyst folds, so filters on partition columns prune partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_column(as_of: dt.date | str | None) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def rolling_window(as_of: dt.date | str | None, days: int = 30) -> tuple[Column, Column]:
    """Half-open ``[as_of - days, as_of)`` bounds."""
    end = as_of_column(as_of)
    return F.date_sub(end, days), end


def month_key(year: str | Column, month: str | Column) -> Column:
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    return y * 100 + m


def rolling_window_predicate(date_col: str, as_of, days: int = 30,
                             year_col: str | None = None,
                             month_col: str | None = None) -> Column:
    """``date_col`` in the rolling window.

    When the table is partitioned by year/month columns the same window is
    also stated on them (an implied, redundant range), which lets the scan
    skip every partition outside the touched months.
    """
    start, end = rolling_window(as_of, days)
    pred = (F.col(date_col) >= start) & (F.col(date_col) < end)
    if year_col and month_col:
        key = month_key(year_col, month_col)
        pred = pred & (key >= month_key(F.year(start), F.month(start))) & \
            (key <= month_key(F.year(end), F.month(end)))
    return pred


def previous_month(as_of: dt.date | str | None) -> tuple[Column, Column]:
    """(year, month) of the calendar month before ``as_of``.

    ``add_months`` clamps the day, so 31 March gives February and January
    gives December of the year before.
    """
    prev = F.add_months(as_of_column(as_of), -1)
    return F.year(prev), F.month(prev)
