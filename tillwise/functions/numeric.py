"""Numeric rules shared by the models and the simulation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwise.config import ALPHA, R2_LOW, R2_MEDIUM

_DECIMAL = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"


def tolerant_number(text: Column) -> Column:
    """Text to double; anything that is not a finite decimal becomes NULL."""
    return F.when(text.rlike(_DECIMAL), text.try_cast("double"))


def clamp_negative(qty: Column) -> Column:
    """Negative to zero; NULL stays NULL (``greatest`` would hide it)."""
    return F.when(qty < 0, F.lit(0.0)).otherwise(qty)


def tick_floor(price: Column) -> Column:
    """Largest number of tenths not above ``price``."""
    return F.floor(price * 10)


def tick_ceil(price: Column) -> Column:
    """Smallest number of tenths not below ``price``."""
    return F.ceil(price * 10)


def r2_band(r2: Column) -> Column:
    """Low up to 0.3, Medium up to 0.8, High up to 1; anything else has no band."""
    return (
        F.when(r2.isNull() | F.isnan(r2) | (r2 < 0) | (r2 > 1), "No_R-Square")
        .when(r2 <= R2_LOW, "Low")
        .when(r2 <= R2_MEDIUM, "Medium")
        .otherwise("High")
    )


def linearity(p_value: Column, alpha: float = ALPHA) -> Column:
    return F.when(p_value < alpha, "Linear").otherwise("Not Linear")
