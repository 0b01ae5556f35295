"""Queries over version-history tables: current state, full history of a
key, point-in-time state, and joins of current versions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.constants import CURRENT, END_AT, START_AT


def current_state(history: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Current versions (``__CURRENT = TRUE``), optionally projected."""
    cur = history.where(F.col(CURRENT))
    return cur.select(*columns) if columns else cur


def latest_state(changes: DataFrame, keys: Sequence[str], sequence_by: str) -> DataFrame:
    """The last change row of every key of a feed: the values of its current version.

    One aggregation with map-side combine: no window, no sampling job, and a
    hot key is reduced inside every map task.  Equal sequences resolve like
    the history's rule 1 (largest struct of the other columns); rows without a
    sequence value are dropped.  Column order is that of ``changes``.
    """
    keys = list(keys)
    rest = [c for c in changes.columns if c not in keys and c != sequence_by]
    last = (changes.where(F.col(sequence_by).isNotNull())
            .groupBy(*keys).agg(F.max(F.struct(sequence_by, *rest)).alias("_last")))
    return last.select(*[F.col(c) if c in keys else F.col("_last")[c].alias(c)
                         for c in changes.columns])


def version_history(history: DataFrame, key: str, columns: Sequence[str],
                    key_value=None) -> DataFrame:
    """Versions with a 'Current Version' / 'Historical Version' label.

    ``key_value`` restricts to one key (the filter on the partitioning key
    is pushed below the history window by Catalyst) and sorts its versions;
    without it all keys are returned, unsorted.
    """
    df = history if key_value is None else history.where(F.col(key) == F.lit(key_value))
    label = F.when(F.col(CURRENT), F.lit("Current Version")) \
             .otherwise(F.lit("Historical Version"))
    out = df.select(*columns, START_AT, END_AT, CURRENT, label.alias("version_type"))
    return out if key_value is None else out.orderBy(START_AT)


def change_log(history: DataFrame, key: str, columns: Sequence[str],
               key_value=None) -> DataFrame:
    """Versions as a change log: ``status_changed_at``, ``status_valid_until``,
    ``is_current``; sorted only for a single key."""
    df = history if key_value is None else history.where(F.col(key) == F.lit(key_value))
    out = df.select(*columns,
                    F.col(START_AT).alias("status_changed_at"),
                    F.col(END_AT).alias("status_valid_until"),
                    F.col(CURRENT).alias("is_current"))
    return out if key_value is None else out.orderBy("status_changed_at")


def instant_literal(when: dt.datetime | str, dtype) -> "F.Column":
    """A literal of the sequence type, parsed from text (no time-zone shift
    for wall-clock timestamps)."""
    from pyspark.sql import types as T
    if isinstance(when, str):
        when = dt.datetime.fromisoformat(when)
    text = when.isoformat(sep=" ")
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ '{text}'")
    if isinstance(dtype, T.TimestampType):
        return F.expr(f"TIMESTAMP '{text}'")
    if isinstance(dtype, T.DateType):
        return F.lit(when.date())
    return F.lit(when).cast(dtype)


def as_of(history: DataFrame, when: dt.datetime | str, columns: Sequence[str]) -> DataFrame:
    """State at ``when``: ``start <= t AND (end > t OR end IS NULL)``.

    The instant is an explicit literal of the sequence column's type.
    """
    t = instant_literal(when, history.schema[START_AT].dataType)
    return history.where((F.col(START_AT) <= t) & (F.col(END_AT).isNull() | (F.col(END_AT) > t))) \
                  .select(*columns, F.col(START_AT).alias("valid_from"),
                          F.col(END_AT).alias("valid_to"))


def current_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Inner join of the current versions of two history tables.

    Each side is filtered before the join, so only current rows shuffle.
    """
    return current_state(left).drop(START_AT, END_AT, CURRENT).alias("l").join(
        current_state(right).drop(START_AT, END_AT, CURRENT).alias("r"), on)
