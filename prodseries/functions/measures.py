"""Calendar, rounding and gap expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from prodseries.schemas import GAP_OK_MAX, GAP_WARNING_MAX, MONTH_NAMES


def nan_to_null(c: Column) -> Column:
    """NaN means "missing" in this data model; NULL is its only spelling past ingest."""
    return F.when(~F.isnan(c), c)


def month_start(c: Column) -> Column:
    return F.trunc(F.to_date(c), "MM")


def yyyymm(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def month_name(month: Column) -> Column:
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    return F.when(month.between(1, 12), F.get(names, month - 1))


def semester(month: Column) -> Column:
    return (F.floor((month - 1) / 6) + 1).cast("int")


def month_index(date: Column) -> Column:
    """Months on an absolute axis, so differences are calendar distances."""
    return F.year(date) * 12 + F.month(date)


def round_half_even(c: Column, digits: int) -> Column:
    scale = float(10**digits)
    return F.rint(c * scale) / scale


def cycle(position: Column, period: int) -> tuple[Column, Column]:
    angle = position * (2 * math.pi) / period
    return F.sin(angle), F.cos(angle)


def check_gap_thresholds(ok_max: float, warning_max: float) -> None:
    if warning_max <= ok_max:
        raise ValueError("gap_warning_threshold must be greater than gap_ok_threshold")


def gap_class(abs_pct: Column, ok_max: float = GAP_OK_MAX, warning_max: float = GAP_WARNING_MAX) -> Column:
    """``ok`` / ``warning`` / ``critical``; an unknown gap counts as critical."""
    check_gap_thresholds(ok_max, warning_max)
    return F.when(abs_pct <= ok_max, "ok").when(abs_pct <= warning_max, "warning").otherwise("critical")


def growth(current: Column, previous: Column) -> Column:
    """Relative change, only against a positive base."""
    return F.when(previous > 0, current / previous - 1)
