"""Derived columns used by the silver and gold layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def active_flag(deleted_at: str | Column = "deleted_at") -> Column:
    """A row is live while it has no deletion time (the clock is not read)."""
    c = F.col(deleted_at) if isinstance(deleted_at, str) else deleted_at
    return c.isNull()


def discount_flag(discount: str | Column = "discount_applied") -> Column:
    """``discount > 0``; a NULL discount counts as not discounted."""
    c = F.col(discount) if isinstance(discount, str) else discount
    return F.coalesce(c > 0, F.lit(False))


def customer_name(last: str = "last_name", first: str = "first_name") -> Column:
    """``last, first``; NULL when either part is NULL (``concat`` semantics)."""
    return F.concat(F.col(last), F.lit(", "), F.col(first))


def round_half_up(c: Column, scale: int = 2) -> Column:
    """Decimal HALF_UP rounding of a double (Spark ``round`` semantics)."""
    return F.round(c, scale)


def unit_price(line_amount: str = "line_amount", quantity: str = "quantity") -> Column:
    """``round(line_amount / quantity, 2)``.

    A zero quantity gives NULL instead of failing the job under ANSI mode.
    """
    return F.round(F.try_divide(F.col(line_amount), F.col(quantity)), 2)


def money(c: str | Column) -> Column:
    """Exact cents: a double amount as ``decimal(18,2)``."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


def money_sum(c: Column) -> Column:
    """Sum of exact cents, returned as double.

    Summing doubles depends on the order rows arrive in, so two runs over the
    same data (or two partitionings) can differ in the last bits.  Summing the
    decimal value is exact and order independent; the final cast rounds once.
    """
    return F.sum(c).cast(T.DoubleType())


def line_value(quantity: str = "quantity", price: str = "unit_price") -> Column:
    """``quantity * unit_price`` as exact cents."""
    return F.col(quantity).cast(T.DecimalType(12, 0)) * money(price)


def to_utc_columns(df: DataFrame, source_zone: str = "UTC",
                   include_ntz: bool = True) -> DataFrame:
    """Shift every timestamp column from ``source_zone`` wall clock to UTC.

    ``TimestampType`` columns go through ``to_utc_timestamp``; wall-clock
    (``TimestampNTZType``) columns through ``convert_timezone``.  With the
    default zone 'UTC' the values are unchanged.  Column types are matched
    with ``isinstance`` on the schema, not by string name.
    """
    if source_zone.upper() in ("UTC", "ETC/UTC", "Z"):
        return df            # converting from UTC to UTC is the identity
    changes = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.TimestampNTZType):
            if include_ntz:
                changes[field.name] = F.convert_timezone(
                    F.lit(source_zone), F.lit("UTC"), F.col(field.name))
        elif isinstance(field.dataType, T.TimestampType):
            changes[field.name] = F.to_utc_timestamp(F.col(field.name), source_zone)
    return df.withColumns(changes) if changes else df
