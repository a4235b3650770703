"""Price grids, simulated profit and the best prices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise import config
from tillwise.functions.numeric import clamp_negative, tick_ceil, tick_floor
from tillwise.operators.demand import CONST, PRICE, constant_elasticity_qty
from tillwise.operators.keys import ITEM, STORE_PRODUCT, join_null_safe, present

_GROUP = ["store", "calculation_group"]
# Objective values this close are the same price decision.
_TIE_DIGITS = 9


def price_grid(sales: DataFrame, step: float = config.PRICE_STEP) -> DataFrame:
    """All prices from the lowest (down to a tenth) to the highest (up to a tenth).

    ``grid_idx`` numbers the steps. It is what joins use, since sums of tenths
    are not exact in floating point.
    """
    return _grid(sales.filter(present(ITEM)).groupBy(*ITEM).agg(F.min("price").alias("lo"), F.max("price").alias("hi")), step)


def moving_price_grid(sales: DataFrame, step: float = config.PRICE_STEP) -> DataFrame:
    """The grid of products whose price moved, from rows with a quantity: one aggregation.

    It equals ``price_grid`` of capped sales with price changes, as capping
    changes quantities only.
    """
    sold = F.when(F.col("qty").isNotNull(), F.col("price"))
    ends = sales.filter(present(ITEM)).groupBy(*ITEM).agg(
        F.min(sold).alias("lo"), F.max(sold).alias("hi"), F.min("price").alias("low"), F.max("price").alias("high")
    )
    product = Window.partitionBy(*STORE_PRODUCT)
    moved = ends.withColumn("moved", F.min("low").over(product) < F.max("high").over(product))
    return _grid(moved.filter("moved and lo is not null"), step)


def _grid(ends: DataFrame, step: float) -> DataFrame:
    lo, hi = tick_floor(F.col("lo")) / 10, tick_ceil(F.col("hi")) / 10
    steps = F.floor(F.round(F.round(hi - lo, 2) / F.lit(step), 2)).cast("int")
    return ends.select(*ITEM, lo.alias("lo"), F.explode(F.sequence(F.lit(0), steps)).alias("grid_idx")).select(
        *ITEM,
        "grid_idx",
        F.round(F.col("lo") + F.col("grid_idx") * F.lit(step), 4).alias("simulation_prices"),
    )


def grid_with_cost(grid: DataFrame, cost: DataFrame) -> DataFrame:
    """Grid prices above cost, with the margin per unit."""
    margin = F.col("simulation_prices") - F.col("cost_lowest")
    priced = grid.join(cost.select(*STORE_PRODUCT, "cost_lowest"), STORE_PRODUCT, "left")
    return priced.withColumn("simulation_profit", margin).filter(F.col("simulation_profit") > 0)


def _outcome(grid: DataFrame, qty: Column) -> DataFrame:
    """Quantity, never negative, and profit at each grid price."""
    predicted = grid.withColumn("qty_predicted", clamp_negative(qty))
    return predicted.select(
        *ITEM,
        "grid_idx",
        "simulation_prices",
        "qty_predicted",
        (F.col("qty_predicted") * F.col("simulation_profit")).alias("profit_predicted"),
    )


def simulate_simple(simple: DataFrame, grid: DataFrame) -> DataFrame:
    """Predicted quantity and profit of the price-only model along the grid."""
    models = simple.select(*ITEM, "intercept", "coefficient")
    return _outcome(
        models.join(grid, ITEM), F.col("intercept") + F.col("coefficient") * F.col("simulation_prices")
    )


def simulate_constant_elasticity(models: DataFrame, grid: DataFrame) -> DataFrame:
    """The same for the constant-elasticity model."""
    return _outcome(models.join(grid, ITEM), constant_elasticity_qty(F.col("simulation_prices")))


def best_price(simulated: DataFrame) -> DataFrame:
    """Most profitable grid price of each product, the lowest one on a tie.

    Profits that differ by rounding noise only are a tie.
    A mergeable maximum of (profit, -grid_idx): no sort and one row per product
    leaves each task.
    """
    top = F.max(
        F.struct(
            F.round("profit_predicted", _TIE_DIGITS).alias("rounded"),
            (-F.col("grid_idx")).alias("order"),
            "simulation_prices",
            "qty_predicted",
            "profit_predicted",
        )
    ).alias("top")
    return (
        simulated.filter(F.col("profit_predicted").isNotNull())
        .groupBy(*ITEM)
        .agg(top)
        .select(*ITEM, "top.simulation_prices", "top.qty_predicted", "top.profit_predicted")
    )


def own_effect(models: DataFrame, grid: DataFrame) -> DataFrame:
    """Contribution of the own price to quantity along the own grid."""
    own = models.filter(F.col("variable") == PRICE).select(*ITEM, "coefficient", "intercept").distinct()
    return own.join(grid, ITEM).withColumn(
        "qty_adjustment", F.col("coefficient") * F.col("simulation_prices")
    )


def _rivals(models: DataFrame) -> DataFrame:
    return (
        models.filter(~F.col("variable").isin(CONST, PRICE))
        .select(*ITEM, "variable", "coefficient")
        .distinct()
    )


def competitor_effect(models: DataFrame, grid: DataFrame, simulated: DataFrame) -> DataFrame:
    """Contribution of each competitor's price along the competitor's grid, with
    the profit the competitor itself makes at that price."""
    outcome = simulated.select(*ITEM, "grid_idx", "profit_predicted")
    prices = (
        grid.select(*ITEM, "grid_idx", "simulation_prices")
        .join(outcome, [*ITEM, "grid_idx"])
        .withColumnRenamed("product", "variable")
    )
    return (
        _rivals(models)
        .join(prices, [*_GROUP, "variable"])
        .withColumn("qty_adjustment", F.col("coefficient") * F.col("simulation_prices"))
    )


def _profiles(simulated: DataFrame) -> DataFrame:
    """Per competitor, its grid prices with the profit it makes at each, as an array."""
    price = F.struct(
        "grid_idx", F.col("simulation_prices").alias("price"), F.coalesce("profit_predicted", F.lit(0.0)).alias("profit")
    )
    profiles = simulated.groupBy(*ITEM).agg(F.sort_array(F.collect_list(price)).alias("profile"))
    return profiles.withColumnRenamed("product", "variable")


def upper_hull(prices: np.ndarray, profits: np.ndarray) -> np.ndarray:
    """Places of the points that are the highest in some direction; prices ascend."""
    kept: list[int] = []
    for i in range(len(prices)):
        while len(kept) > 1:
            a, b = kept[-2], kept[-1]
            if (profits[b] - profits[a]) * (prices[i] - prices[a]) > (profits[i] - profits[a]) * (prices[b] - prices[a]):
                break
            kept.pop()
        kept.append(i)
    return np.array(kept, np.int64)


def best_values(slopes: np.ndarray, prices: np.ndarray, profits: np.ndarray) -> np.ndarray:
    """The highest ``slope * price + profit`` over the points of a hull, for each slope.

    Neighbours on the hull are equally good at one slope; these slopes descend
    along it, so each slope looks up its place instead of trying all points.
    """
    equal = (profits[1:] - profits[:-1]) / (prices[:-1] - prices[1:])
    at = np.searchsorted(equal, slopes)
    return slopes * prices[at] + profits[at]


def _hulls(simulated: DataFrame) -> DataFrame:
    """Per competitor the hull of its prices and the profits it makes at each: an upper envelope for any margin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = [[np.array(batch.column(c)[i].as_py(), float) for c in ("prices", "profits")] for i in range(batch.num_rows)]
            hulls = [[a[at] for a in x] for x in points for at in [upper_hull(*x)]]
            columns = [pa.array([h[k] for h in hulls], pa.list_(pa.float64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], batch.schema.names)

    profiles = _profiles(simulated).select(
        *_GROUP, "variable", F.col("profile.price").alias("prices"), F.col("profile.profit").alias("profits")
    )
    return profiles.mapInArrow(run, profiles.schema)


def _reply_values(pairs: DataFrame, consistent: bool) -> DataFrame:
    """For each own price the best ``margin * pull + profit`` of a competitor, one row per pair of products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("coefficient", "own_prices", "margins", "prices", "profits"))):
                b, own, margins, prices, profits = row[0], *(np.array(x, float) for x in row[1:])
                values = best_values(margins * (-b if consistent else b), prices, profits)
                out.append(values + margins * b * own if consistent else values)
            values = pa.array(out, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], values], [*batch.schema.names[:5], "values"])

    kept = [*ITEM, "grid_idx", "alone"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.select(*kept).schema) + ", values array<double>"
    return pairs.select(*kept, "coefficient", "own_prices", "margins", "prices", "profits").mapInArrow(run, schema)


def _reply(value) -> Column:
    """The competitor's price with the highest ``value``, the lowest on a tie."""
    return F.array_max(
        F.transform(
            "profile",
            lambda c: F.struct(
                value(c).alias("value"), (-c["grid_idx"]).alias("order"), c["price"].alias("price"), c["profit"].alias("profit")
            ),
        )
    )


def joint_best_price(
    models: DataFrame, grid: DataFrame, simulated: DataFrame, consistent: bool = False
) -> DataFrame:
    """Own price with the highest profit of a product and its competitors together.

    The joint profit at own price p with margin m > 0 is
    ``m * max(0, I + b p + sum b_j p_j) + sum profit_j(p_j)``. As m is positive,
    the clamp and the maximum over competitor prices change places, and every
    competitor is maximised on its own:

        max( m (I + b p) + sum_j max_pj [ m b_j p_j + profit_j(p_j) ],
             sum_j max_pj [ profit_j(p_j) ] )

    A competitor's lines ``m b_j p_j + profit_j(p_j)`` are those of its points
    (p_j, profit_j), of which only the upper hull can win, whatever b_j is. The
    hull is built once per competitor, and every own price looks up its point on
    it: the work of a pair of products is about the sum of their grids. Only
    values are worked out for every own price; which prices the competitors take
    is looked up for the winning own prices.

    ``consistent=True`` uses own minus competitor price, as the models are
    trained on; the default multiplies the competitor price itself.
    All own prices that reach the maximum stay.
    """
    own = own_effect(models, grid)
    rivals = _rivals(models)
    own_price = F.struct("grid_idx", F.col("simulation_prices").alias("price"), F.col("simulation_profit").alias("margin"))
    own_grid = own.groupBy(*ITEM).agg(F.sort_array(F.collect_list(own_price)).alias("own_grid"))
    b = F.col("coefficient")

    def pull(own_price: Column, price: Column) -> Column:
        return b * (own_price - price) if consistent else b * price

    pairs = rivals.join(_hulls(simulated), [*_GROUP, "variable"]).join(own_grid, ITEM).select(
        *ITEM, "coefficient", "prices", "profits", F.array_max("profits").alias("alone"), F.col("own_grid.grid_idx").alias("grid_idx"),
        F.col("own_grid.price").alias("own_prices"), F.col("own_grid.margin").alias("margins"),
    )
    valued = _reply_values(pairs, consistent).select(
        *ITEM, "alone", F.explode(F.arrays_zip(F.col("grid_idx"), F.col("values").alias("value"))).alias("at")
    )
    summed = valued.groupBy(*ITEM, F.col("at.grid_idx").alias("grid_idx")).agg(
        F.sum("at.value").alias("selling"), F.sum("alone").alias("alone")
    )
    zero = F.lit(0.0)
    m, base = F.col("simulation_profit"), F.col("intercept") + F.col("qty_adjustment")
    sells, alone = m * base + F.coalesce("selling", zero), F.coalesce("alone", zero)
    every = Window.partitionBy(*ITEM).orderBy(F.col("objective").desc())
    top = (
        own.join(summed, [*ITEM, "grid_idx"], "left")
        .withColumns({"objective": F.round(F.greatest(sells, alone), _TIE_DIGITS), "sells": sells >= alone, "base": base})
        .filter(F.col("objective").isNotNull())
        .withColumn("__rank", F.rank().over(every))
        .filter(F.col("__rank") == 1)
        .select(*ITEM, "grid_idx", "simulation_prices", "cost_lowest", "simulation_profit", "sells", "base")
    )
    price = F.col("simulation_prices")
    reply = _reply(lambda c: F.when(F.col("sells"), m * pull(price, c["price"])).otherwise(zero) + c["profit"])
    replying = top.join(rivals, ITEM).join(_profiles(simulated), [*_GROUP, "variable"])
    chosen = replying.select(*ITEM, "grid_idx", "variable", price, b, reply.alias("reply"))
    competitor = F.struct(
        F.col("variable").alias("competitor"), F.col("reply.price").alias("simulation_prices"), F.col("reply.profit").alias("profit_predicted")
    )
    replies = chosen.groupBy(*ITEM, "grid_idx").agg(
        F.sum(pull(price, F.col("reply.price"))).alias("pulled"),
        F.sum("reply.profit").alias("earned"),
        F.sort_array(F.collect_list(competitor)).alias("competitors"),
    )
    qty = clamp_negative(F.col("base") + F.coalesce("pulled", zero))
    own_profit = F.col("predicted_qty") * m
    return (
        top.join(replies, [*ITEM, "grid_idx"], "left")
        .withColumn("predicted_qty", qty)
        .select(
            *ITEM,
            "simulation_prices",
            "cost_lowest",
            "simulation_profit",
            "predicted_qty",
            own_profit.alias("profit_predicted"),
            (own_profit + F.coalesce("earned", zero)).alias("profit_predicted_all"),
            "competitors",
        )
    )


def joint_members(joint: DataFrame, simulated: DataFrame) -> DataFrame:
    """One row per product and competitor of a joint result: the member's price,
    quantity and profit next to the product's own; one without a member if there
    is no competitor."""
    outcome = simulated.select(
        *_GROUP, F.col("product").alias("member"), F.col("simulation_prices").alias("member_price"),
        F.col("qty_predicted").alias("member_qty"), F.col("profit_predicted").alias("member_profit"),
    )
    listed = joint.select(
        *ITEM, "simulation_prices", "predicted_qty", "profit_predicted", "profit_predicted_all", F.explode_outer("competitors").alias("c")
    ).select("*", F.col("c.competitor").alias("member"), F.col("c.simulation_prices").alias("member_price")).drop("c")
    return listed.join(outcome, [*_GROUP, "member", "member_price"], "left")


def baseline_members(models: DataFrame, best: DataFrame) -> DataFrame:
    """Each modelled product and its competitors, at their separate best prices."""
    own = models.select(*ITEM, F.col("product").alias("member")).distinct()
    members = own.unionByName(
        _rivals(models).select(*ITEM, F.col("variable").alias("member")).distinct()
    )
    return members.join(best.withColumnRenamed("product", "member"), [*_GROUP, "member"])


def baseline_profit(models: DataFrame, best: DataFrame) -> DataFrame:
    """Sum of the separate best profits of a product and its competitors."""
    return baseline_members(models, best).groupBy(*ITEM).agg(
        F.sum("profit_predicted").alias("profit_predicted_all_reg"),
        F.count("member").alias("members"),
    )


def profit_uplift(joint: DataFrame, baseline: DataFrame, store_ref: DataFrame) -> DataFrame:
    """Gain of the joint best price over separate pricing, with the store code."""
    codes = store_ref.select(F.col("store_name").alias("store"), "store_codes")
    return (
        joint.withColumnRenamed("profit_predicted_all", "profit_predicted_all_cnbl")
        .join(baseline.select(*ITEM, "profit_predicted_all_reg"), ITEM)
        .withColumn(
            "profit_predicted_all_uplift",
            F.col("profit_predicted_all_cnbl") - F.col("profit_predicted_all_reg"),
        )
        .join(codes, "store")
    )


COMMON_COLUMNS = [
    *ITEM,
    "profit_predicted",
    "profit_predicted_all_cnbl",
    "profit_predicted_all_reg",
    "profit_predicted_all_uplift",
]


def common_result(uplift: DataFrame) -> DataFrame:
    """The columns all products share: the cross-store result table."""
    return uplift.select(*COMMON_COLUMNS)


def result_pivot(
    best: DataFrame, products: list[str], measures: tuple[str, ...] = ("profit_predicted",)
) -> DataFrame:
    """One row per store and group, a ``{measure}_{product}`` column per product,
    and the total profit of the row.

    Wide output belongs at the very end and names its products, which also saves
    the pass that would look for them. A product that is not named fails the
    query: it has no column, and leaving it out would give a wrong total. The
    long form of the same rows is ``baseline_members``.
    """
    unnamed = F.when(
        ~F.col("product").isin(*products), F.raise_error(F.concat(F.lit("no column for product "), F.col("product")))
    )
    total = F.sum("profit_predicted") if "profit_predicted" in measures else F.count(F.lit(1))
    totals = best.groupBy(*_GROUP).agg(total.alias("profit_predicted_all"), F.max(unnamed.cast("int")).alias("__unnamed"))
    totals = totals.filter(F.col("__unnamed").isNull()).drop("__unnamed")
    wide = best.groupBy(*_GROUP).pivot("product", products).agg(*[F.avg(m).alias(m) for m in measures])
    if len(measures) == 1:
        named = {p: f"{measures[0]}_{p}" for p in products}
    else:
        named = {f"{p}_{m}": f"{m}_{p}" for p in products for m in measures}
    wide = join_null_safe(wide.withColumnsRenamed(named), totals, _GROUP, "inner")
    return wide if "profit_predicted" in measures else wide.drop("profit_predicted_all")
