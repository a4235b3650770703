"""Correlation of product pairs inside a store and calculation group.

The reference result is one row per ordered pair, and a group of n products has
n*(n-1) of them. Joining sales with themselves by week would also write one row
per pair *and week*. Instead each product becomes one row holding its weekly
series, products are spread over blocks of bounded size, and each pair of blocks
is one task that multiplies two small matrices. A large group thus splits into
many tasks, no week-level pair row exists, and with thresholds only the pairs
that pass are written at all.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise import config
from tillwise.operators.keys import ITEM, present
from tillwise.operators.prep import store_lookup

BLOCK = 128
_GROUP = ["store", "calculation_group"]
# A series whose variance is this small against its squared mean is constant.
_FLAT = 1e-12
_DIGITS = 12

PAIR_SCHEMA = (
    "store string, calculation_group string, product_1 string, product_2 string, "
    "correlation_coefficient_p double, correlation_coefficient_q double, total_correlation double, "
    "correlation_coefficient_q_rank double"
)


def _series(weekly: DataFrame) -> DataFrame:
    """One row per product of a store and group: its weekly rows, in order of weeks.

    A product listed in several places has several rows in a week. Each pairs
    with each row of another product in that week, so all are kept.
    """
    week = F.struct("week_index", "avg_price", "qty")
    return _with_arrays(weekly.filter(present(ITEM)).groupBy(*ITEM).agg(F.sort_array(F.collect_list(week)).alias("s")))


def _series_all_stores(weekly: DataFrame) -> DataFrame:
    """One row per group and product with its weekly rows of all stores, and the
    stores that list it: correlations are the same in each of them."""
    rows = weekly.groupBy("product").agg(F.sort_array(F.collect_list(F.struct("week_index", "avg_price", "qty"))).alias("s"))
    listed = weekly.filter(present(ITEM)).groupBy("calculation_group", "product").agg(F.collect_set("store").alias("stores"))
    return _with_arrays(listed.join(rows, "product").withColumn("store", F.lit("")), "stores")


def _with_arrays(df: DataFrame, *more: str) -> DataFrame:
    arrays = {"weeks": "week_index", "p": "avg_price", "q": "qty"}
    return df.select(*ITEM, *more, *[F.col(f"s.{source}").alias(name) for name, source in arrays.items()])


def _block_pairs(series: DataFrame, block: int) -> DataFrame:
    """Spread the products of a group over blocks and copy each product to every
    pair of blocks that contains its own."""
    blocks = series.groupBy(*_GROUP).agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("product"), F.col("blocks")).cast("int")
    spread = (
        series.join(blocks, _GROUP)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    return spread.select(
        "*", F.least("own", "other").alias("block_1"), F.greatest("own", "other").alias("block_2")
    ).drop("blocks", "other")


class _Block:
    """The products of one block: weekly moments as matrices, weekly rows as arrays.

    In a week in which products have several rows, each row of one pairs with
    each row of the other; count, sum and sum of squares of a week are enough to
    get the moments of those row pairs without forming them. Values are shifted
    by the product's mean, which keeps sums small before they are subtracted.
    """

    def __init__(self, rows: pd.DataFrame, weeks: np.ndarray):
        self.product = rows["product"].to_numpy()
        shape = (len(rows), len(weeks))
        self.n, self.p, self.q, self.pp, self.qq = (np.zeros(shape) for _ in range(5))
        self.at, self.sold, self.mean = [], [], {"p": np.zeros(len(rows)), "q": np.zeros(len(rows))}
        for i, row in enumerate(rows.itertuples(index=False)):
            at = np.searchsorted(weeks, row.weeks)
            np.add.at(self.n[i], at, 1.0)
            for v in ("p", "q"):
                x = np.asarray(getattr(row, v), dtype=float)
                self.mean[v][i] = x.mean()
                x = x - x.mean()
                np.add.at(getattr(self, v)[i], at, x)
                np.add.at(getattr(self, v * 2)[i], at, x * x)
            self.at.append(at)
            self.sold.append(np.asarray(row.q, dtype=float))

    def raw(self, v: str) -> np.ndarray:
        return getattr(self, v)


def _pearson(a: _Block, b: _Block, v: str) -> np.ndarray:
    """Correlations of every product of ``a`` with every product of ``b``."""
    count = a.n @ b.n.T
    sx, sy = a.raw(v) @ b.n.T, a.n @ b.raw(v).T
    sxx, syy = a.raw(v * 2) @ b.n.T, a.n @ b.raw(v * 2).T
    sxy = a.raw(v) @ b.raw(v).T
    with np.errstate(divide="ignore", invalid="ignore"):
        var_x = sxx / count - (sx / count) ** 2
        var_y = syy / count - (sy / count) ** 2
        corr = (sxy / count - sx * sy / count**2) / np.sqrt(var_x * var_y)
    flat = (var_x <= _FLAT * a.mean[v][:, None] ** 2) | (var_y <= _FLAT * b.mean[v][None, :] ** 2)
    corr[flat | (count < 2)] = np.nan
    return np.round(np.clip(corr, -1, 1), _DIGITS)


def _weekly_ranks(block: _Block, i: int, other_n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Average ranks of product ``i`` among its row pairs with each other product.

    ``other_n`` has the rows per week of the other products. A row counts as
    often as it has partners; its rank is the count of smaller values plus half
    that of equal ones plus a half. Returns, per other product and week, the sum
    of the ranks minus their mean, and per other product the sum of their squares
    over all row pairs.
    """
    at, sold = block.at[i], block.sold[i]
    order = np.argsort(sold, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(sold[order]) != 0))
    partners = other_n[:, at[order]]
    tied = np.add.reduceat(partners, starts, axis=1)
    rank = np.cumsum(tied, axis=1) - tied / 2 + 0.5
    centre = (partners.sum(axis=1, keepdims=True) + 1) / 2
    ranks = np.repeat(rank - centre, np.diff(np.append(starts, len(order))), axis=1)
    weekly = np.zeros(other_n.shape)
    np.add.at(weekly.T, at[order], ranks.T)
    return weekly, (ranks * ranks * partners).sum(axis=1)


def _spearman(a: _Block, b: _Block, wanted: np.ndarray) -> np.ndarray:
    """Rank correlations of the wanted pairs, NaN for the others."""
    out = np.full(wanted.shape, np.nan)
    rows = {}
    for j in np.flatnonzero(wanted.any(axis=0)):
        partners = np.flatnonzero(wanted[:, j])
        weekly, squares = _weekly_ranks(b, j, a.n[partners])
        rows.update(zip(((i, j) for i in partners), zip(weekly, squares)))
    for i in np.flatnonzero(wanted.any(axis=1)):
        partners = np.flatnonzero(wanted[i])
        weekly, squares = _weekly_ranks(a, i, b.n[partners])
        count = a.n[i] @ b.n[partners].T
        other = [rows.pop((i, j)) for j in partners]
        products = np.array([w @ o for w, (o, _) in zip(weekly, other)])
        with np.errstate(divide="ignore", invalid="ignore"):
            corr = products / np.sqrt(squares * np.array([s for _, s in other]))
        corr[count < 2] = np.nan
        out[i, partners] = corr
    return np.round(np.clip(out, -1, 1), _DIGITS)


def _pair_task(with_rank: bool, with_threshold: bool):
    def task(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        store, group, block_1, block_2 = key
        weeks = np.unique(np.concatenate([np.asarray(w) for w in rows["weeks"]]))
        first, second = rows[rows["own"] == block_1], rows[rows["own"] == block_2]
        a = _Block(first, weeks)
        b = a if block_1 == block_2 else _Block(second, weeks)
        price, qty = _pearson(a, b, "p"), _pearson(a, b, "q")
        keep = np.ones(price.shape, dtype=bool)
        if a is b:  # a pair and its reverse have the same numbers
            keep = np.triu(keep, 1)
        if with_threshold:
            with np.errstate(invalid="ignore"):
                keep &= price < rows["threshold_p"].iloc[0]
        rank = _spearman(a, b, keep) if with_rank else np.full(price.shape, np.nan)
        if with_threshold:
            with np.errstate(invalid="ignore"):
                keep &= rank < rows["threshold_q"].iloc[0]
        i, j = np.nonzero(keep)
        price, qty, rank = (np.tile(x[i, j], 2) for x in (price, qty, rank))
        one, other = a.product[i], b.product[j]
        out = pd.DataFrame(
            {
                "store": store,
                "calculation_group": group,
                "product_1": np.concatenate([one, other]),
                "product_2": np.concatenate([other, one]),
                "correlation_coefficient_p": price,
                "correlation_coefficient_q": qty,
                "total_correlation": price + qty,
                "correlation_coefficient_q_rank": rank,
            }
        )
        if "stores" in rows.columns:
            of = {p: set(s) for p, s in zip(rows["product"], rows["stores"])}
            out["store"] = [sorted(of[x] & of[y]) for x, y in zip(out["product_1"], out["product_2"])]
            out = out.explode("store").dropna(subset=["store"])
        return out

    return task


def _correlate(series: DataFrame, block: int, with_rank: bool, with_threshold: bool = False) -> DataFrame:
    pairs = (
        _block_pairs(series, block)
        .groupBy(*_GROUP, "block_1", "block_2")
        .applyInPandas(_pair_task(with_rank, with_threshold), PAIR_SCHEMA)
    )
    measures = [c for c in pairs.columns if "correlation" in c]
    return pairs.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in measures})


def pair_correlation(weekly: DataFrame, scope: str = "store", block: int = BLOCK) -> DataFrame:
    """Price and quantity correlation of every ordered pair, and their sum.

    ``scope='store'`` uses the weeks of the pair's own store; ``scope='all'``
    takes both series from all stores: worked out once per group, and given for
    every store that lists both products.
    """
    series = _series(weekly) if scope == "store" else _series_all_stores(weekly)
    return _correlate(series, block, with_rank=False).drop("correlation_coefficient_q_rank")


def pair_rank_correlation(weekly: DataFrame, block: int = BLOCK) -> DataFrame:
    """``pair_correlation`` plus the rank correlation of quantity."""
    return _correlate(_series(weekly), block, with_rank=True)


def _threshold_columns(thresholds: Mapping[str, tuple[float, float]]):
    default = (config.DEFAULT_PAIR_THRESHOLD, config.DEFAULT_PAIR_THRESHOLD)
    return store_lookup(thresholds, default, ["threshold_p", "threshold_q"])


def filter_pairs(
    correlations: DataFrame, thresholds: Mapping[str, tuple[float, float]] = config.PAIR_THRESHOLDS
) -> DataFrame:
    """Pairs of a finished correlation table below both thresholds of their store."""
    return (
        correlations.withColumns(_threshold_columns(thresholds))
        .filter(
            (F.col("correlation_coefficient_p") < F.col("threshold_p"))
            & (F.col("correlation_coefficient_q_rank") < F.col("threshold_q"))
        )
        .drop("threshold_p", "threshold_q")
    )


def select_pairs(
    weekly: DataFrame,
    thresholds: Mapping[str, tuple[float, float]] = config.PAIR_THRESHOLDS,
    block: int = BLOCK,
) -> DataFrame:
    """Pairs below both thresholds, straight from weekly sales.

    The test runs where the correlations are computed, so pairs that fail it are
    never written. A correlation cannot be below -1: stores without a threshold
    of their own have no pairs and are left out at the start.
    """
    limits = _threshold_columns(thresholds)
    open_stores = (limits["threshold_p"] > -1) & (limits["threshold_q"] > -1)
    series = _series(weekly.filter(open_stores)).withColumns(limits)
    return _correlate(series, block, with_rank=True, with_threshold=True)
