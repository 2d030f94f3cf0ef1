"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import WEEKDAY_LABELS


def iso_day_of_week(d: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return (F.weekday(d) + 1).cast("int")


def day_of_week0(d: Column) -> Column:
    """0 = Monday .. 6 = Sunday (synthetic series)."""
    return F.weekday(d).cast("int")


def weekday_label(dow: Column) -> Column:
    """1..7 -> Mon..Sun, anything else -> ''."""
    labels = F.create_map(*[x for i, lab in enumerate(WEEKDAY_LABELS)
                            for x in (F.lit(i + 1), F.lit(lab))])
    return F.coalesce(F.try_element_at(labels, dow), F.lit(""))


def is_weekend(dow: Column, zero_based: bool = False) -> Column:
    days = (5, 6) if zero_based else (6, 7)
    return F.coalesce(dow.isin(*days), F.lit(False)).cast("int")


def calendar_parts(d: Column) -> dict[str, Column]:
    return {"Month": F.month(d), "Year": F.year(d), "Day": F.dayofmonth(d)}


def is_month_start(d: Column) -> Column:
    return (F.dayofmonth(d) == 1).cast("int")


def is_month_end(d: Column) -> Column:
    return (d == F.last_day(d)).cast("int")


def is_april(month: Column) -> Column:
    return (month == 4).cast("int")


def interaction_terms(promo: Column, school: Column, weekend: Column) -> dict[str, Column]:
    return {
        "promo_schoolholiday": promo * school,
        "weekend_schoolholiday": weekend * school,
        "promo_weekend": promo * weekend,
    }


def parse_date(s: Column) -> Column:
    return F.to_date(s, "yyyy-MM-dd")


def parse_date_list(s: Column) -> Column:
    """'a, b,' -> ['a', 'b']: split on commas, trim, drop empties."""
    return F.filter(F.transform(F.split(s, ","), lambda x: F.trim(x)), lambda x: x != "")
