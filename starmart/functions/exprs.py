"""Column expressions: surrogate keys, date keys, calendar attributes, money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.schemas import NON_REVENUE_STATUSES, VALID_STATUSES

# Money is stored as double but summed as DECIMAL(28,8): the sum does not depend
# on row order, keeps fractions of cents, and is rounded to cents once.
MONEY = "decimal(28,8)"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_key(customer_id) -> Column:
    """Key of a customer's first version (and of a product): md5 of the id."""
    return F.md5(col_(customer_id))


def version_key(customer_id, start_date) -> Column:
    """Key of a later version: md5 of id, '|' and start date – deterministic,
    unlike md5(id || load time)."""
    return F.md5(F.concat_ws("|", col_(customer_id), col_(start_date).cast("string")))


def event_date(ts="event_ts") -> Column:
    return F.to_date(col_(ts))


def date_key(d) -> Column:
    """Smart key yyyyMMdd as int."""
    return F.date_format(col_(d), "yyyyMMdd").cast("int")


def calendar_columns(full_date="full_date") -> list[Column]:
    d = col_(full_date)
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.weekofyear(d).alias("week_of_year"),
    ]


def money_sum(c) -> Column:
    """Exact sum of a double money column; double result rounded to cents."""
    return F.round(F.sum(col_(c).cast(MONEY)).cast("double"), 2)


def is_valid_total(c="order_total") -> Column:
    return col_(c) > 0


def is_valid_status(c="status") -> Column:
    return col_(c).isin(*VALID_STATUSES)


def is_revenue(c="status") -> Column:
    return ~col_(c).isin(*NON_REVENUE_STATUSES)


def differs(a: Column, b: Column, null_safe: bool = False) -> Column:
    """``a <> b`` (NULL never differs, as in SQL) or the null-safe variant."""
    return ~a.eqNullSafe(b) if null_safe else (a != b)
