"""Partition dates: ``yyyyMMdd`` and ``yyyy-MM-dd`` spellings of a day."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, functions as F

# Date patterns of partition names.
COMPACT = "yyyyMMdd"
DASHED = "yyyy-MM-dd"
HOURLY = "yyyyMMddHH"


def pt_to_date(pt: Column | str) -> Column:
    """Either spelling of a partition as a date."""
    pt = F.col(pt) if isinstance(pt, str) else pt
    return F.to_date(F.replace(pt, F.lit("-"), F.lit("")), COMPACT)


def date_to_pt(day: Column | str, fmt: str = COMPACT) -> Column:
    return F.date_format(day, fmt)


def shift_pt(pt: Column | str, days: int, fmt: str = COMPACT) -> Column:
    """The partition ``days`` later (negative: earlier)."""
    return date_to_pt(F.date_add(pt_to_date(pt), days), fmt)


def pt_diff(earlier: Column | str, later: Column | str) -> Column:
    """Days from ``earlier`` to ``later``, as a double."""
    return F.datediff(pt_to_date(later), pt_to_date(earlier)).cast("double")


def hour_pt_before(moment: Column | str, hours: int = 2) -> Column:
    """Hourly partition some hours before ``moment``."""
    moment = F.col(moment) if isinstance(moment, str) else moment
    return F.date_format(moment - F.make_interval(hours=F.lit(hours)), HOURLY)


def next_day_pt(moment: Column | str, fmt: str = COMPACT) -> Column:
    return date_to_pt(F.date_add(F.to_date(moment), 1), fmt)


def as_day(as_of: str | date) -> date:
    if isinstance(as_of, date):
        return as_of
    return datetime.strptime(as_of.replace("-", ""), "%Y%m%d").date()


def day_literal(as_of: str | date) -> Column:
    return F.lit(as_day(as_of))


def pt_text(as_of: str | date, shift: int = 0, dashed: bool = False) -> str:
    """A partition name as a Python string, so that Spark can prune by it."""
    day = as_day(as_of) + timedelta(days=shift)
    return day.isoformat() if dashed else day.strftime("%Y%m%d")


def on_sale_less_than(as_of: str | date, days: int, generated: str = "generate_time") -> Column:
    """Freshness test; a future start date passes."""
    return F.datediff(day_literal(as_of), F.col(generated)) < days
