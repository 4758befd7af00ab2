"""Shared measures of the views (R3-R6): guarded ratios, periods, changes."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dec(c: Column | str) -> Column:
    """Exact numeric view of a count or sum (integers -> decimal(20,0))."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(20,0)")


def ratio(num: Column, den: Column, scale: int = 2, pct: bool = False) -> Column:
    """ROUND(num / NULLIF(den, 0) [* 100], scale) in exact decimals,
    half away from zero (numeric semantics; no binary floating point)."""
    if pct:
        num = num * F.lit(Decimal("100.0"))
    return F.round(num / F.nullif(den, F.lit(0)), scale)


def with_period(df: DataFrame, year: str = "year", month: str = "month",
                month_name: str = "month_name") -> DataFrame:
    """Sort key year*100+month and label 'Dec 2010'."""
    return df.withColumns({
        "year_month_sort": F.col(year) * 100 + F.col(month),
        "month_year_label": F.concat(F.left(F.col(month_name), F.lit(3)), F.lit(" "),
                                     F.col(year).cast("string")),
    })


def period_change(df: DataFrame, value: str, prev: str, growth: str,
                  part: list[str] | None = None, order: tuple[str, ...] = ("year", "month")) -> DataFrame:
    """Previous period's value (LAG over the periods present) and the
    rounded % change. The window runs over one row per period (and per
    ``part``), i.e. over an already aggregated, calendar-bounded frame."""
    w = Window.orderBy(*order) if not part else Window.partitionBy(*part).orderBy(*order)
    out = df.withColumn(prev, F.lag(value).over(w))
    change = dec(F.col(value)) - dec(F.col(prev)) if _is_integral(df, value) \
        else F.col(value) - F.col(prev)
    den = dec(F.col(prev)) if _is_integral(df, value) else F.col(prev)
    return out.withColumn(growth, ratio(change, den, 2, pct=True))


def _is_integral(df: DataFrame, col: str) -> bool:
    return dict(df.dtypes)[col] in ("bigint", "int", "smallint", "tinyint")


def before_after(value: Column, day: Column, midpoint: Column) -> tuple[Column, Column]:
    """(value on or before the midpoint, value after it), 0 otherwise."""
    return (F.when(day <= midpoint, value).otherwise(F.lit(0)),
            F.when(day > midpoint, value).otherwise(F.lit(0)))
