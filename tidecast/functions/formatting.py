"""Report formatters (en-US)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fmt_number(x: Column, decimals: int = 0) -> Column:
    """Thousands separators, fixed decimals; NULL reads 0."""
    return F.format_number(F.coalesce(x.cast("double"), F.lit(0.0)), decimals)


def fmt_currency(x: Column) -> Column:
    """USD: $1,234.50, negatives as -$1,234.50; NULL reads $0.00."""
    v = F.coalesce(x.cast("double"), F.lit(0.0))
    body = F.concat(F.lit("$"), F.format_number(F.abs(v), 2))
    return F.when(v < 0, F.concat(F.lit("-"), body)).otherwise(body)


def fmt_pct(x: Column, decimals: int = 1) -> Column:
    """'12.3%' (no thousands separators); NULL reads 0."""
    v = F.coalesce(x.cast("double"), F.lit(0.0))
    return F.concat(F.format_string(f"%.{decimals}f", v), F.lit("%"))


def fmt_date(d: Column) -> Column:
    """'Mon, Jul 14'; NULL reads an em dash."""
    return F.coalesce(F.date_format(d, "EEE, MMM d"), F.lit("—"))


def fmt_weekday(d: Column) -> Column:
    return F.coalesce(F.date_format(d, "EEEE"), F.lit("—"))
