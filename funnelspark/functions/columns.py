"""Scalar column functions (all built-in Spark expressions, codegen friendly)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from funnelspark.schemas import MONEY, SENTINEL_TIME, SURROGATE_NULL_TOKEN, SURROGATE_SEPARATOR


def as_timestamp(value) -> Column:
    """A literal or column as a session-time-zone ``timestamp`` (P16: load and
    run times are this explicit literal, never the wall clock)."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp")


def sentinel_time() -> Column:
    """The 1900-01-01 placeholder of an absent activity time (C10; T19: the
    written literal, whatever a 32-bit epoch type would store)."""
    return F.lit(SENTINEL_TIME).cast("timestamp")


def to_seconds(c: Column) -> Column:
    """Whole-second time (C2): ``toDateTime`` drops the fraction."""
    return F.date_trunc("second", c.cast("timestamp"))


def to_money(c: Column) -> Column:
    """Landed amount as decimal(20,2), the landing type (C4); what doesn't fit was
    rejected on landing."""
    return c.try_cast(MONEY)


def surrogate_key(*cols: Column | str) -> Column:
    """md5 of the '-'-joined text of the parts, NULL parts replaced by a fixed token."""
    parts = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"),
                        F.lit(SURROGATE_NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def listed_product_count(text: Column) -> Column:
    """Products in a landed ``[a, b]`` list: split on ',' after removing brackets.

    Mirrors the warehouse rule exactly: ``[]`` counts 1 (split of '' is one
    empty element); NULL stays NULL (C15, C16, T16).
    """
    stripped = F.replace(F.replace(text, F.lit("["), F.lit("")), F.lit("]"), F.lit(""))
    return F.when(text.isNull(), F.lit(None).cast("int")).otherwise(
        F.size(F.split(stripped, ",")))


def array_product_count(arr: Column) -> Column:
    """``CARDINALITY(array)`` with NULL kept NULL (C17): an empty array counts 0."""
    return F.when(arr.isNull(), F.lit(None).cast("int")).otherwise(F.size(arr))


def array_as_text(arr: Column) -> Column:
    """ARRAY<STRING> → ``[a, b]`` text, as landed."""
    return arr.cast("string")


def days_between(start: Column, end: Column) -> Column:
    """``dateDiff('day', start, end)``: difference of calendar dates."""
    return F.datediff(F.to_date(end), F.to_date(start))


def greatest_of_coalesced(*cols: Column) -> Column:
    """``greatest`` after replacing NULLs by the sentinel."""
    return F.greatest(*[F.coalesce(c, sentinel_time()) for c in cols])


def count_when(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as a bigint."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def sum_when(cond: Column, value: Column, zero: Column) -> Column:
    """``SUM(CASE WHEN cond THEN value ELSE 0 END)``."""
    return F.sum(F.when(cond, value).otherwise(zero))
