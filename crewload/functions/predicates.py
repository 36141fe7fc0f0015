"""Predicates with the source's missing-value rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def not_in_keep_null(c: str, values) -> Column:
    """``!x %in% S`` is TRUE for a missing x, so NULL rows stay."""
    return ~F.coalesce(F.col(c).isin(*values), F.lit(False))


def not_equal_drop_null(c: str, value) -> Column:
    """``!x == v`` is NA for a missing x and the row is dropped; Spark's
    three-valued ``!=`` inside ``where`` does the same."""
    return F.col(c) != F.lit(value)


def if_else(cond: Column, yes, no) -> Column:
    """Vectorised if-else that yields NULL for a NULL test."""
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    no = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond.isNull(), F.lit(None)).when(cond, yes).otherwise(no)


def fold_code(c: str, frm: str, to: str) -> Column:
    """``if_else(code == frm, to, code)``."""
    return if_else(F.col(c) == frm, F.lit(to), F.col(c))


def flag_rule_keep(date_col: str, equipment_col: str, before: dt.date, equipment: str) -> Column:
    """keep rows whose flag ``date < before & equipment == e`` is 0.

    A NULL flag (missing date or equipment) is neither 0 nor 1: dropped.
    """
    flag = (F.col(date_col) < F.lit(before)) & (F.col(equipment_col) == F.lit(equipment))
    return ~flag


def percent_half_even(num: Column, den: Column) -> Column:
    """G11/N6 live form: ``round(num/den, 2) * 100`` as a half-even integer
    percent; NULL when den is 0 (no reserve) instead of Inf/NaN."""
    return F.bround(F.try_divide(num * 100, den), 0)


def percent_2dp(num: Column, den: Column) -> Column:
    """G11 commented form: ``round((num / den) * 100, 2)``."""
    return F.round(F.try_divide(num, den) * 100, 2)
