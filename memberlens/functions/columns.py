"""Small column expressions shared by the operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_FORMAT = "yyyy-MM-dd"


def day_string(col: Column | str) -> Column:
    """``yyyy-MM-dd`` text of a timestamp, the grouping key of every daily chart."""
    return F.date_format(col, DAY_FORMAT)


def money_sum(col: Column | str) -> Column:
    """Sum of a money column, exact to the cent, returned as double.

    Summing doubles gives results that depend on the order of the rows,
    i.e. on the partitioning. Each value is cast to ``decimal(18,2)`` first
    so the partial sums of a distributed aggregate add up to the same total
    on every run, every cluster size and in the SQL oracle.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast("decimal(18,2)")).cast("double")


def as_date(value: str | _dt.date | _dt.datetime) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value)[:10])


def days_before(as_of: str | _dt.date, days: int) -> str:
    """ISO day ``days`` before ``as_of`` (the reference's ``now.plusDays(-n)``)."""
    return (as_date(as_of) - _dt.timedelta(days=days)).isoformat()


def at_midnight(day: str | _dt.date) -> str:
    return f"{as_date(day).isoformat()} 00:00:00"


def typed_literal(df: DataFrame, column: str, value) -> Column:
    """A literal of exactly the column's type.

    Comparing a timestamp column with a string makes Spark cast the column,
    which blocks predicate pushdown into the parquet scan; a literal cast to
    the column type is constant-folded and pushed down.
    """
    return F.lit(value).cast(df.schema[column].dataType)
