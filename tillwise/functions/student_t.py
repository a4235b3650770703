"""Two-sided Student-t tail for whole degrees of freedom.

For integer ``nu`` the distribution is a finite trigonometric series
(Abramowitz & Stegun 26.7.3 and 26.7.4), so no special-function library is
needed: one form in Spark expressions, one in numpy for code inside tasks.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def _series(first: Column, ratio, terms: Column) -> Column:
    """first + first*ratio(1) + first*ratio(1)*ratio(2) + ... (``terms`` factors)."""
    steps = F.when(terms >= 1, F.sequence(F.lit(1).cast("bigint"), terms)).otherwise(
        F.array().cast("array<bigint>")
    )
    start = F.struct(first.alias("term"), first.alias("total"))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] * ratio(i)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    return F.aggregate(steps, start, step, lambda acc: acc["total"])


def two_sided_p(t: Column, nu: Column) -> Column:
    """P(|T| >= |t|) with ``nu`` degrees of freedom; NULL unless ``nu`` >= 1."""
    nu = nu.cast("bigint")
    t = F.abs(t)
    cos2 = nu / (nu + t * t)
    sin = t / F.sqrt(nu + t * t)
    theta = F.atan(t / F.sqrt(nu))
    even = sin * _series(
        F.lit(1.0),
        lambda i: cos2 * (2 * i - 1) / (2 * i),
        F.floor((nu - 2) / 2),
    )
    odd = (
        theta
        + F.when(nu == 1, F.lit(0.0)).otherwise(
            sin
            * _series(
                F.sqrt(cos2),
                lambda i: cos2 * (2 * i) / (2 * i + 1),
                F.floor((nu - 3) / 2),
            )
        )
    ) * (2 / math.pi)
    inside = F.when(nu % 2 == 0, even).otherwise(odd)
    return F.when(nu >= 1, F.greatest(F.lit(0.0), F.lit(1.0) - inside))


def two_sided_p_array(t: np.ndarray, nu: int) -> np.ndarray:
    """The same tail for an array of statistics that share ``nu``."""
    t = np.abs(np.asarray(t, dtype=float))
    if nu < 1:
        return np.full(t.shape, np.nan)
    cos2 = nu / (nu + t * t)
    sin = t / np.sqrt(nu + t * t)
    if nu % 2 == 0:
        i = np.arange(1, (nu - 2) // 2 + 1)
        factors = cos2[:, None] * ((2 * i - 1) / (2 * i))[None, :]
        inside = sin * (1 + np.cumprod(factors, axis=1).sum(axis=1))
    else:
        inside = np.arctan(t / math.sqrt(nu))
        if nu > 1:
            i = np.arange(1, (nu - 3) // 2 + 1)
            factors = cos2[:, None] * ((2 * i) / (2 * i + 1))[None, :]
            inside = inside + sin * np.sqrt(cos2) * (1 + np.cumprod(factors, axis=1).sum(axis=1))
        inside = inside * (2 / math.pi)
    return np.clip(1 - inside, 0.0, 1.0)
