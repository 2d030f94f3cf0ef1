"""Error, rounding and level expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import DemandThresholds


def abs_error(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted)


def pct_error(actual: Column, predicted: Column, policy: str = "mask") -> Column:
    """Absolute percentage error (in %).

    policy: ``mask`` -> NULL when actual = 0; ``epsilon`` -> |a| + 1e-8 in the
    denominator; ``raw`` -> plain division (NULL on zero under Spark's rules).
    """
    err = F.abs(actual - predicted)
    if policy == "epsilon":
        return err / (F.abs(actual) + F.lit(1e-8)) * 100
    if policy == "mask":
        return F.when(actual != 0, err / F.abs(actual) * 100)
    if policy == "raw":
        return F.try_divide(err, F.abs(actual)) * 100
    raise ValueError(f"unknown zero policy {policy!r}")


def round_units(x: Column) -> Column:
    """numpy-style round half to even, to an integer."""
    return F.bround(x, 0).cast("bigint")


def demand_level(sales: Column, th: DemandThresholds = DemandThresholds()) -> Column:
    return (F.when(sales >= th.high, "high")
            .when(sales >= th.medium, "medium")
            .otherwise("low"))


def closed_day_zero(pred: Column, open_flag: Column) -> Column:
    return F.when(open_flag == 0, F.lit(0.0)).otherwise(pred)


def clip_unit(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


def risk_normalise(risk: Column, default: str = "high") -> Column:
    return F.lower(F.coalesce(risk, F.lit(default)))
