"""Demand models with the prices of competing products."""

from __future__ import annotations

from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise import config
from tillwise.functions.numeric import linearity, r2_band
from tillwise.functions.student_t import two_sided_p_array
from tillwise.operators.demand import CONST, PRICE
from tillwise.operators.keys import ITEM, STORE_PRODUCT, place
from tillwise.operators.ordinal import number_rows
from tillwise.sources import scratch

PRICE_DIFF_ALL = "PriceDiff_All"
_DIFF_DIGITS = 6

MODEL_SCHEMA = (
    "store string, calculation_group string, product string, variable string, coefficient double, "
    "intercept double, p_value double, r_squared double, vif double"
)
VIF_SCHEMA = "store string, calculation_group string, product string, variable string, vif double"


def _day_prices(daily: DataFrame) -> DataFrame:
    """Mean of the different prices a product had on a day."""
    return daily.select(*ITEM, "date", "price").distinct().groupBy(*ITEM, "date").agg(
        F.avg("price").alias("day_price")
    )


def price_difference_features(daily: DataFrame, pairs: DataFrame) -> DataFrame:
    """Own price minus each competitor's price of the day, one row per competitor.

    A competitor sold at several prices on a day counts with their mean, so its
    side is reduced to one row per day first and the join cannot fan out.
    Differences are rounded: equal price constellations must be equal keys.
    """
    rivals = pairs.select("store", F.col("product_1").alias("product"), "product_2").distinct()
    rival_price = _day_prices(daily).withColumnsRenamed({"product": "product_2", "day_price": "rival_price"})
    return (
        daily.select(*ITEM, "date", "price", "qty")
        .join(rivals, STORE_PRODUCT)
        .join(rival_price, ["store", "calculation_group", "product_2", "date"], "left")
        .select(
            *ITEM,
            "date",
            "price",
            "qty",
            "product_2",
            F.round(F.col("price") - F.col("rival_price"), _DIFF_DIGITS).alias("price_difference"),
        )
    )


def price_differences_carried(sales: DataFrame, pairs: DataFrame) -> DataFrame:
    """``price_difference_features`` of the rows of unfilled sales.

    A competitor's price of a day without a sale is the last price before it, as
    filling carries it, or its first price if there is none before. Own days and
    the competitor's price days are merged in order of the date and each own day
    takes the last price seen: one sort per competitor, and no day is written out
    for which there is no row.
    """
    rivals = pairs.select("store", F.col("product_1").alias("product"), "product_2").distinct()
    asked = sales.select(*ITEM, "date", "price", "qty").join(rivals, STORE_PRODUCT)
    days = (
        sales.select(*ITEM, "date", "price").distinct().groupBy(*ITEM, "date")
        .agg(F.avg("price").alias("day_price"), F.min("price").alias("low"), F.max("price").alias("high"))
        .withColumnRenamed("product", "product_2")
    )
    side = ["store", "calculation_group", "product_2"]
    first = days.groupBy(*side).agg(F.min_by("low", "date").alias("high"))
    quotes = days.select(*side, "date", F.struct("date", "day_price", "high").alias("quote")).unionByName(
        first.select(
            *side, F.lit("0001-01-01").cast("date").alias("date"),
            F.struct(F.lit("0001-01-01").cast("date").alias("date"), F.col("high").alias("day_price"), "high").alias("quote"),
        )
    )
    merged = asked.unionByName(quotes, allowMissingColumns=True)
    upto = Window.partitionBy(*side).orderBy("date", F.col("quote").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = merged.withColumn("seen", F.last("quote", ignorenulls=True).over(upto)).filter(F.col("quote").isNull())
    rival_price = F.when(F.col("seen.date") == F.col("date"), F.col("seen.day_price")).otherwise(F.col("seen.high"))
    return seen.select(
        *ITEM, "date", "price", "qty", "product_2", F.round(F.col("price") - rival_price, _DIFF_DIGITS).alias("price_difference")
    )


def _timelines(own: DataFrame) -> DataFrame:
    """One row per product: its day prices from the first day on, without gaps, and the dates on which they change.

    ``own`` has one row per product, day and price. The day after the last one
    is a change too: from then on there is no price.
    """
    timeline = (
        own.groupBy(*ITEM, "date")
        .agg(F.avg("price").alias("day_price"))
        .groupBy(*ITEM)
        .agg(
            F.min("date").alias("start"),
            F.max("date").alias("end"),
            F.sort_array(F.collect_list(F.struct("date", "day_price"))).alias("days"),
        )
    )
    whole = F.size("days") == F.datediff("end", "start") + 1
    prices = F.when(whole, F.col("days.day_price")).otherwise(
        F.raise_error(F.lit("sales have missing days: fill them first")).cast("array<double>")
    )

    def change_days(listed):
        """Places whose price differs from the one before; the list of prices is made once."""
        places = F.sequence(F.lit(0), F.size(listed) - 1)
        return F.filter(places, lambda i: (i == 0) | (F.get(listed, i) != F.get(listed, i - 1)))

    changes = F.get(F.transform(F.array(F.col("days.day_price")), change_days), F.lit(0))
    dates = F.transform(changes, lambda i: F.date_add("start", i))
    return timeline.select(
        *ITEM, "start", prices.alias("prices"), F.array_append(dates, F.date_add("end", 1)).alias("changes")
    )


#: Competitors of a product whose prices stand in one row.
RIVALS = 64


def _rival_chunks(own: DataFrame, pairs: DataFrame) -> DataFrame:
    """Competitors of each product in order of their names, at most ``RIVALS`` with their timelines in a row."""
    chosen = pairs.select("store", F.col("product_1").alias("product"), "product_2").distinct()
    timelines = _timelines(own).withColumnRenamed("product", "product_2")
    by_name = Window.partitionBy(*ITEM).orderBy("product_2")
    met = place(chosen.join(timelines, ["store", "product_2"]), ITEM)
    chunk = F.floor((F.row_number().over(by_name) - 1) / RIVALS).alias("chunk")
    return (
        met.select(*ITEM, chunk, "changes", F.struct("product_2", "start", "prices").alias("rival"))
        .groupBy(*ITEM, "chunk")
        .agg(
            F.sort_array(F.collect_list("rival")).alias("others"),
            F.array_distinct(F.flatten(F.collect_list("changes"))).alias("changes"),
        )
    )


def _spans(own: DataFrame, chunks: DataFrame) -> DataFrame:
    """Days of a product between two changes of its competitors' prices, one row per span with the sales in it.

    A span is named by the change it begins with, days before any change by the
    first of them. ``sold`` has a price, its days and its quantity per entry.
    """
    changes = chunks.select(*ITEM, F.explode("changes").alias("date")).distinct()
    every = own.withColumn("is_sale", F.lit(True)).unionByName(changes.withColumn("is_sale", F.lit(False)), allowMissingColumns=True)
    upto = Window.partitionBy(*ITEM).orderBy("date", "is_sale").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    change = F.last(F.when(~F.col("is_sale"), F.col("date")), ignorenulls=True).over(upto)
    first = F.first(F.when(F.col("is_sale"), F.col("date")), ignorenulls=True).over(upto)
    return (
        every.withColumn("span", F.coalesce(change, first))
        .filter("is_sale")
        .groupBy(*ITEM, "span", "price")
        .agg(F.count(F.lit(1)).alias("days"), F.sum("qty").alias("qty"))
        .groupBy(*ITEM, "span")
        .agg(F.collect_list(F.struct("price", "days", "qty")).alias("sold"))
    )


def demand_points_cross(filled: DataFrame, pairs: DataFrame) -> DataFrame:
    """Demand points keyed by price and the vector of price differences.

    The vector is ordered by competitor name and every competitor of the product
    has its place in it. Points run from the highest price, then the highest
    differences, down; ``inverted_qty`` is the running total of quantity per day.

    Competitors' prices are looked up once per span of days between two changes
    of any of them, not once per day, by chunks of ``RIVALS`` competitors: a row
    holds the timelines of one chunk or the competitors' prices in one span, and
    no row both. Sales and chunks are brought to their product once; everything
    after that stays there.
    """
    own = place(filled.select(*ITEM, "date", "price", "qty"), ITEM).groupBy(*ITEM, "date", "price").agg(F.sum("qty").alias("qty"))
    chunks = _rival_chunks(own, pairs)
    # whole millionths while they are keys: exact, and quicker to hash and sort
    unit = 10**_DIFF_DIGITS
    seen = F.transform("others", lambda rival: F.get(rival["prices"], F.datediff("span", rival["start"])))
    by_span = (
        _spans(own, chunks)
        .join(chunks, ITEM)
        .select(*ITEM, "span", "sold", F.struct("chunk", seen.alias("prices"), F.col("others.product_2").alias("names")).alias("part"))
        .groupBy(*ITEM, "span")
        .agg(F.first("sold").alias("sold"), F.sort_array(F.collect_list("part")).alias("parts"))
    )
    sales = by_span.select(
        *ITEM,
        F.flatten("parts.names").alias("rivals"),
        F.flatten("parts.prices").alias("rival_prices"),
        F.inline("sold"),
    )
    against = F.transform("rival_prices", lambda other: F.round((F.col("price") - other) * unit).cast("bigint"))
    points = (
        sales.select(*ITEM, "rivals", "price", against.alias("differences"), "days", "qty")
        .groupBy(*ITEM, "rivals", "price", "differences")
        .agg(F.sum("days").alias("unique_days"), F.sum("qty").alias("total_qty"))
    )
    down = (
        Window.partitionBy(*ITEM)
        .orderBy(F.col("price").desc(), F.col("differences").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    nothing = F.lit(0).cast("bigint")
    total = F.aggregate("differences", nothing, lambda acc, d: acc + F.coalesce(d, nothing))
    return points.withColumn("avg_qty", F.col("total_qty") / F.col("unique_days")).select(
        *ITEM,
        "price",
        "rivals",
        F.transform("differences", lambda d: d / unit).alias("differences"),
        (total / unit).alias("price_diff_all"),
        "unique_days",
        "total_qty",
        "avg_qty",
        F.sum("avg_qty").over(down).alias("inverted_qty"),
    )


#: Columns of a block of co-moments.
BLOCK = 8


def co_moments(points: DataFrame, literal: bool) -> DataFrame:
    """Number, means and centred co-moments of each product's target and regressors, in blocks.

    The columns are ``inverted_qty``, the price, the differences in order of the
    rivals and, if ``literal``, their total; points with a missing difference do
    not count. A row is one block: means of its first columns and the sums of
    products of deviations of ``BLOCK`` columns with ``BLOCK`` others, added up
    where the points are and merged by product and block.
    """
    columns = [F.array(F.col("inverted_qty").cast("double"), F.col("price").cast("double")), F.col("differences")]
    if literal:
        columns.append(F.array("price_diff_all"))
    complete = points.filter(~F.exists("differences", lambda d: d.isNull()))
    row = F.concat(*columns, F.array_repeat(F.lit(0.0), BLOCK - 1))
    blocks = F.floor((F.size("row") / BLOCK)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), blocks - 1), lambda i: F.slice("row", i * BLOCK + 1, BLOCK))
    first = complete.select(*ITEM, row.alias("row")).select(*ITEM, cut.alias("cut"))
    left = first.select(*ITEM, "cut", F.posexplode("cut").alias("i", "a"))
    both = left.select(*ITEM, "i", "a", F.posexplode(F.slice("cut", F.col("i") + 1, F.size("cut"))).alias("ahead", "b"))
    at = [(p, q) for p in range(BLOCK) for q in range(BLOCK)]
    sums = [F.covar_pop(F.get("a", F.lit(p)), F.get("b", F.lit(q))).alias(f"c{p}_{q}") for p, q in at]
    means = [F.avg(F.get("a", F.lit(p))).alias(f"m{p}") for p in range(BLOCK)]
    blocks = both.groupBy(*ITEM, "i", (F.col("i") + F.col("ahead")).alias("j")).agg(F.count(F.lit(1)).alias("n"), *means, *sums)
    return blocks.select(
        *ITEM, "i", "j", "n",
        F.array(*(f"m{p}" for p in range(BLOCK))).alias("means"),
        F.array(*(F.col("n") * F.col(f"c{p}_{q}") for p, q in at)).alias("sums"),
    )


def _matrices(points: DataFrame, literal: bool) -> DataFrame:
    """The blocks of each product, and one row (i = -1) with the names of its regressors."""
    names = points.groupBy(*ITEM).agg(F.first("rivals").alias("rivals"))
    named = names.select(*ITEM, F.lit(-1).alias("i"), "rivals")
    return co_moments(points, literal).unionByName(named, allowMissingColumns=True)


class Moments:
    """Centred co-moments of one product: target first, then the regressors."""

    def __init__(self, names: list[str], n: int, means: np.ndarray, sums: np.ndarray):
        self.names, self.n, self.means, self.sums = names, n, means, sums

    @classmethod
    def of_blocks(cls, rows: pd.DataFrame, literal: bool) -> Moments:
        names = [PRICE, *rows.loc[rows["i"] < 0, "rivals"].iloc[0], *[PRICE_DIFF_ALL][: int(literal)]]
        k, blocks = len(names) + 1, rows[rows["i"] >= 0]
        width = (int(blocks["j"].max()) + 1) * BLOCK if len(blocks) else k
        means, sums = np.zeros(width), np.zeros((width, width))
        for i, j, m, c in zip(blocks["i"], blocks["j"], blocks["means"], blocks["sums"]):
            a, b = slice(int(i) * BLOCK, int(i + 1) * BLOCK), slice(int(j) * BLOCK, int(j + 1) * BLOCK)
            means[a], sums[a, b] = m, np.reshape(c, (BLOCK, BLOCK))
            sums[b, a] = sums[a, b].T
        n = int(blocks["n"].iloc[0]) if len(blocks) else 0
        return cls(names, n, means[:k], sums[:k, :k])

    def without(self, gone: np.ndarray) -> Moments:
        """The same without some regressors."""
        kept = np.append(0, 1 + np.flatnonzero(~gone))
        return Moments([self.names[i - 1] for i in kept[1:]], self.n, self.means[kept], self.sums[np.ix_(kept, kept)])


#: Share of a regressor's variance below which it counts as explained by the others.
_NOTHING = 1e-11


def _inflation(means: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Variance inflation of each regressor against the others and a constant, from centred co-moments.

    A regressor takes part in an exact relation if a null vector of the
    correlations has a component on it; its factor is infinite. For all others
    it is the diagonal of the inverse on the rest of the space.
    """
    size = np.sqrt(np.diag(sums))
    flat = size <= 1e-9 * np.maximum(1.0, np.abs(means))
    out = np.full(len(size), np.inf)
    if flat.all():
        return out
    scale = size[~flat]
    values, vectors = np.linalg.eigh(sums[np.ix_(~flat, ~flat)] / np.outer(scale, scale))
    none = values <= _NOTHING
    bound = (vectors[:, none] ** 2).sum(1) > 1e-9
    factors = (vectors[:, ~none] ** 2 / values[~none]).sum(1)
    out[~flat] = np.where(bound, np.inf, factors)
    return out


def inflation_factors(x: np.ndarray) -> np.ndarray:
    """Variance inflation of each column of a matrix against the others and a constant."""
    centred = x - x.mean(axis=0)
    return _inflation(x.mean(axis=0), centred.T @ centred)


def sweep(sums: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Inverse over the columns ``of``, their coefficients for column 0 and what they leave of its square sum."""
    inner, cross = sums[np.ix_(of, of)], sums[of, 0]
    scale = np.sqrt(np.diag(inner))
    scale = np.where(scale > 0, scale, 1.0)
    inverse = np.linalg.pinv(inner / np.outer(scale, scale), rcond=1e-13, hermitian=True) / np.outer(scale, scale)
    beta = inverse @ cross
    return inverse, beta, max(float(sums[0, 0] - beta @ cross), 0.0)


def least_squares(m: Moments) -> tuple[np.ndarray, np.ndarray, float]:
    """Coefficients (constant first), their p-values and R-squared."""
    inverse, slopes, sse = sweep(m.sums, np.arange(1, len(m.sums)))
    x, sst = m.means[1:], float(m.sums[0, 0])
    sse = 0.0 if sse <= 1e-12 * sst else sse
    beta = np.append(m.means[0] - slopes @ x, slopes)
    nu = m.n - len(beta)
    r2 = 1 - sse / sst if sst > 0 else np.nan
    if nu < 1:
        return beta, np.full(len(beta), np.nan), r2
    spread = np.append(1 / m.n + x @ inverse @ x, np.diag(inverse)) * (sse / nu)
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.abs(beta) / np.sqrt(spread)
    p = np.where(np.isinf(t), 0.0, two_sided_p_array(np.where(np.isfinite(t), t, 0.0), nu))
    return beta, np.where(np.isnan(t), np.nan, p), r2


def eliminate(m: Moments, max_vif: float, alpha: float) -> tuple[Moments, tuple[np.ndarray, np.ndarray, float]]:
    """Drop collinear regressors, then insignificant ones, all offenders of a
    round at once. The constant and the own price always stay."""

    def drop(bad: np.ndarray) -> bool:
        nonlocal m
        bad = bad & np.array([n != PRICE for n in m.names])
        if bad.any():
            m = m.without(bad)
        return bool(bad.any())

    while len(m.names) > 1 and drop(_inflation(m.means[1:], m.sums[1:, 1:]) > max_vif):
        pass
    fit = least_squares(m)
    while drop(np.nan_to_num(fit[1][1:]) > alpha):
        fit = least_squares(m)
    return m, fit


def _model_task(literal: bool, max_vif: float, alpha: float):
    def task(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        m = Moments.of_blocks(rows, literal)
        out = pd.DataFrame(
            columns=["variable", "coefficient", "intercept", "p_value", "r_squared", "vif"]
        )
        if m.n >= 2 and m.sums[1, 1] > (1e-9 * max(1.0, abs(m.means[1]))) ** 2:
            m, (beta, p, r2) = eliminate(m, max_vif, alpha)
            out = pd.DataFrame(
                {
                    "variable": [CONST, *m.names],
                    "coefficient": beta,
                    "intercept": beta[0],
                    "p_value": p,
                    "r_squared": r2,
                    "vif": [np.nan, *_inflation(m.means[1:], m.sums[1:, 1:])],
                }
            )
        elif m.n >= 2:  # one price only: nothing to fit
            out.loc[0] = [PRICE, np.nan, np.nan, np.nan, np.nan, np.nan]
        for name, value in zip(ITEM, key):
            out[name] = value
        return out

    return task


def _nan_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns})


def cross_model(
    points: DataFrame,
    features: str = "pairs",
    max_vif: float = config.MAX_VIF,
    alpha: float = config.ALPHA,
) -> DataFrame:
    """Least squares of cumulative demand on the own price and price differences.

    One row per surviving variable, the constant included. ``features='literal'``
    adds the total of the differences as a regressor; as an exact sum of the
    others it makes all of them collinear, which leaves the price alone.

    Spark adds up the centred co-moments of each product; a fit sees that one
    matrix of regressors by regressors and no points, however many there are.
    Points are written once, for the matrices and for the names.
    """
    literal = features == "literal"
    matrices = _matrices(scratch.stage(points, "points"), literal)
    fitted = matrices.groupBy(*ITEM).applyInPandas(_model_task(literal, max_vif, alpha), MODEL_SCHEMA)
    fitted = _nan_to_null(fitted, ["coefficient", "intercept", "p_value", "r_squared", "vif"])
    return fitted.withColumns(
        {
            "linearity": linearity(F.col("p_value"), alpha),
            "r_squared_group": r2_band(F.col("r_squared")),
        }
    )


def variance_inflation(points: DataFrame, features: str = "pairs") -> DataFrame:
    """Inflation factor of every regressor before any is dropped; NULL = infinite."""
    literal = features == "literal"

    def task(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        m = Moments.of_blocks(rows, literal)
        names = m.names if m.n >= 2 else []
        out = pd.DataFrame({"variable": names, "vif": _inflation(m.means[1:], m.sums[1:, 1:]) if names else []})
        for name, value in zip(ITEM, key):
            out[name] = value
        return out

    vif = _matrices(scratch.stage(points, "points"), literal).groupBy(*ITEM).applyInPandas(task, VIF_SCHEMA)
    return vif.withColumn("vif", F.when(F.abs("vif") != float("inf"), F.col("vif")))


_MEASURES = ["coefficient", "intercept", "p_value", "r_squared", "linearity", "r_squared_group"]


def model_comparison(simple: DataFrame, cross: DataFrame, features: DataFrame) -> DataFrame:
    """Both models of a product side by side, with the gain in R-squared.

    Starts from the product features, so products without a model stay. Row
    numbers follow store, group and product.
    """
    left = simple.withColumnsRenamed({c: f"{c}_simple" for c in _MEASURES})
    right = cross.select(
        *ITEM,
        "variable",
        *[F.col(c).alias(f"{c}_cross") for c in [*_MEASURES, "vif"]],
    )
    both = left.join(right, [*ITEM, "variable"], "left")
    lift = F.col("r_squared_cross") - F.col("r_squared_simple")
    both = both.withColumns(
        {
            "cannibalization_ind": F.when(F.col("r_squared_cross").isNull(), 0).otherwise(1),
            "lift_by_cannibalization": lift,
            "uplift_ind": F.when(lift > 0, 1).otherwise(0),
        }
    )
    return number_rows(features.join(both, ITEM, "left"), [["store"], ["calculation_group"], ["product"]])


def add_features(models: DataFrame, features: DataFrame) -> DataFrame:
    """A model table with the features of its products."""
    return models.join(features, ITEM, "left")


def uplift_models(cross: DataFrame, comparison: DataFrame) -> DataFrame:
    """The cross models that explain more than the simple one, with both R-squared."""
    better = comparison.filter(F.col("lift_by_cannibalization") > 0).select(
        *ITEM, "r_squared_simple", "r_squared_cross", "lift_by_cannibalization", "uplift_ind"
    )
    return cross.join(better, ITEM)
