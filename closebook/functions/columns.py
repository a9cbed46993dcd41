"""Column-level helpers: money and ratio arithmetic, calendar parts, keys.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none of them is a Python UDF.

Rounding rule: money stays DECIMAL end to end and is rounded with decimal
``round`` (HALF_UP). Ratios are doubles and are rounded with
``sign(x) * floor(abs(x) * 10^d + 0.5) / 10^d``, which gives the same bits in
any engine that does IEEE arithmetic (a plain ``round`` on doubles does not).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(9, 4)
RATIO_SUM = T.DecimalType(18, 4)

# Fixed value: the null placeholder the surrogate-key macro writes for a null part.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
# Weekday names indexed by the 0 = Sunday day number.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal from a date or naive datetime, built from its ISO
    text so that neither the Python nor the session time zone shifts it."""
    text = value.isoformat(sep=" ") if hasattr(value, "hour") else f"{value.isoformat()} 00:00:00"
    return F.lit(text).cast("timestamp_ntz")


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Round a decimal expression to cents and pin the type to DECIMAL(18,2)."""
    return F.round(col_(c), 2).cast(MONEY)


def half_up(x: Column | str, digits: int) -> Column:
    """Round a double half away from zero, engine-independent (see module doc)."""
    scale = float(10 ** digits)
    x = col_(x)
    return F.signum(x) * F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def nonzero(c: Column | str) -> Column:
    """``nullif(c, 0)``."""
    c = col_(c)
    return F.when(c != 0, c)


def ratio4(num: Column | str, den: Column | str) -> Column:
    """``round(num / nullif(den, 0), 4)`` as a double.

    Decimal / decimal has a different result type in every engine, so both
    sides are cast to double first and the quotient is rounded with
    :func:`half_up`.
    """
    return half_up(col_(num).cast("double") / nonzero(col_(den).cast("double")), 4)


def mean_money(total: Column | str, n: Column | str) -> Column:
    """``round(sum / count, 2)`` for an exact decimal sum and a count."""
    return half_up(col_(total).cast("double") / nonzero(col_(n).cast("double")), 2)


def mean_ratio(total: Column | str, n: Column | str) -> Column:
    """``round(avg(ratio), 4)`` from an exact DECIMAL(18,4) sum and a count."""
    return half_up(col_(total).cast("double") / nonzero(col_(n).cast("double")), 4)


def month_of(d: Column | str) -> Column:
    """``date_trunc('month', d)`` kept as DATE."""
    return F.trunc(col_(d), "month")


def year_of(d: Column | str) -> Column:
    return F.trunc(col_(d), "year")


def quarter_of(d: Column | str) -> Column:
    return F.trunc(col_(d), "quarter")


def day_of_week(d: Column | str) -> Column:
    """Day of week with 0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(col_(d)) - 1


def week_of_year(d: Column | str) -> Column:
    """ISO week number."""
    return F.weekofyear(col_(d))


def day_name(d: Column | str) -> Column:
    dow = day_of_week(d)
    expr = F.when(dow == 0, DAY_NAMES[0])
    for i, name in enumerate(DAY_NAMES[1:], start=1):
        expr = expr.when(dow == i, name)
    return expr


def is_weekday(d: Column | str) -> Column:
    return ~day_of_week(d).isin(0, 6)


def make_date(year: Column | str, month: Column | str, day: int = 1) -> Column:
    return F.make_date(col_(year).cast("int"), col_(month).cast("int"), F.lit(day))


def title_case(c: Column | str) -> Column:
    """``initcap(trim(c))``: first letter of each space-separated word upper-cased."""
    return F.initcap(F.trim(col_(c)))


def cents_to_dollars(c: Column | str, scale: int = 2) -> Column:
    """Integer cents to dollars, kept DECIMAL (multiply, never divide)."""
    cents = col_(c).cast(T.DecimalType(18, 0))
    return F.round(cents * F.lit(Decimal("0.01")), scale)


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 of the dash-joined parts, nulls replaced by a fixed placeholder."""
    parts = [F.coalesce(col_(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))
