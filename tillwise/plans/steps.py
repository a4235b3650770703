"""The five steps from transactions to best prices.

Each step takes tables and gives tables. Steps with several consumers are
staged, as the file hand-off between the steps asks for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise import config
from tillwise.operators import cost, crosseffects, demand, pairs, prep, simulate
from tillwise.sources import scratch, tables
from tillwise.sources.scratch import stage


def extract_daily(
    transactions: DataFrame,
    categories: Sequence[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Step 0: daily sales of the listed categories and local days, as a table."""
    return stage(prep.daily_sales(prep.select_transactions(transactions, categories, start, end, names)), "daily")


def scoped_sales(daily: DataFrame) -> DataFrame:
    """Daily sales in scope, as a table; every product has one group per store."""
    return prep.require_one_group(stage(prep.scope(daily), "sales"))


def weekly_for_pairs(
    sales: DataFrame, activity: DataFrame | None = None, max_week: int | None = None
) -> DataFrame:
    """Step 1, first half: weekly sales of active products whose price moved."""
    weekly = prep.weekly_sales(sales, max_week)
    if activity is not None:
        weekly = prep.only_active(weekly, activity)
    return prep.keep_price_changes(weekly, "avg_price")


def competing_pairs(
    weekly: DataFrame,
    thresholds: Mapping[str, tuple[float, float]] = config.PAIR_THRESHOLDS,
) -> DataFrame:
    """Step 1, second half: pairs whose prices and volumes move against each other, as a table."""
    return stage(pairs.select_pairs(weekly, thresholds), "pairs")


@dataclass(frozen=True)
class Models:
    """Step 2's report: one table per sheet."""

    comparison: DataFrame
    simple: DataFrame
    cross: DataFrame

    def sheets(self) -> dict[str, DataFrame]:
        return {
            "model_comparison": self.comparison,
            "simple_regression": self.simple,
            "ols": self.cross,
        }


def simple_models(sales: DataFrame) -> DataFrame:
    """Price-only models on filled daily sales."""
    return demand.simple_regression(demand.cumulative_demand(demand.demand_points_carried(sales)))


def cross_points(sales: DataFrame, chosen: DataFrame) -> DataFrame:
    """Demand points with competitor prices, on filled daily sales.

    Only products that appear in a pair are filled.
    """
    involved = chosen.select("store", F.col("product_1").alias("product")).unionByName(
        chosen.select("store", F.col("product_2").alias("product"))
    )
    filled = prep.fill_daily(sales.join(involved, ["store", "product"], "left_semi"), calendar_of=sales)
    return crosseffects.demand_points_cross(filled, chosen)


def sales_features(sales: DataFrame) -> DataFrame:
    """Product features of filled sales; the fill only adds days, so their number
    is the length of the calendar."""
    span = sales.agg((F.datediff(F.max("date"), F.min("date")) + 1).alias("days"))
    return demand.product_features(sales, span.scalar())


def fit_models(sales: DataFrame, chosen: DataFrame, features: str = "pairs") -> Models:
    """Step 2: both models of every product, compared."""
    simple = stage(simple_models(sales), "simple")
    cross = stage(crosseffects.cross_model(cross_points(sales, chosen), features), "cross")
    described = stage(sales_features(sales), "features")
    return Models(
        comparison=crosseffects.model_comparison(simple, cross, described),
        simple=crosseffects.add_features(simple, described),
        cross=crosseffects.add_features(cross, described),
    )


def assemble_cost(
    transactions: DataFrame,
    deals: DataFrame,
    relationships: DataFrame,
    shops: DataFrame,
    products: DataFrame,
    shop_group: DataFrame,
    group_id: str,
    categories: Sequence[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Step 3: the lowest of the three costs per store and product.

    Transactions may be narrowed to category titles and local days.
    """
    return cost.lowest_cost(
        cost.product_cost(products, shops, shop_group, group_id),
        cost.lowest_deal_cost(deals, relationships, shops, products, shop_group, group_id),
        cost.cost_from_transactions(prep.select_transactions(transactions, categories, start, end, names)),
    )


def priced_grid(sales: DataFrame, costs: DataFrame) -> DataFrame:
    """Step 4, first half: grid prices above cost of products whose price moved."""
    return simulate.grid_with_cost(simulate.moving_price_grid(sales), costs)


@dataclass(frozen=True)
class JointPrices:
    """Step 4's result: gain per product, and the joint prices with their members."""

    uplift: DataFrame
    joint: DataFrame
    members: DataFrame


def joint_prices(
    models: DataFrame,
    simple: DataFrame,
    grid: DataFrame,
    store_ref: DataFrame,
    stores: Sequence[str] | None = None,
    groups: Sequence[str] | None = None,
    consistent: bool = False,
) -> JointPrices:
    """Step 4, second half: joint best prices against separate ones.

    All stores and groups, unless some are named. Models and prices are narrowed
    to those before the joins; competitors are of the same store and group, so
    none is lost.
    """
    models = prep.scope_to_test(models, stores, groups)
    grid = prep.scope_to_test(grid, stores, groups)
    simulated = simulate.simulate_simple(simple, grid)
    joint = stage(simulate.joint_best_price(models, grid, simulated, consistent), "joint")
    baseline = simulate.baseline_profit(models, simulate.best_price(simulated))
    uplift = simulate.profit_uplift(joint, baseline, store_ref)
    return JointPrices(uplift, joint, simulate.joint_members(joint, simulated))


def optimise(
    sales: DataFrame,
    costs: DataFrame,
    models: Models,
    store_ref: DataFrame,
    stores: Sequence[str] | None = None,
    groups: Sequence[str] | None = None,
    consistent: bool = False,
) -> JointPrices:
    """Step 4 as a whole, for products whose cross model explains more."""
    grid = stage(priced_grid(sales, costs), "grid")
    better = stage(crosseffects.uplift_models(models.cross, models.comparison), "uplift")
    return joint_prices(better, models.simple, grid, store_ref, stores, groups, consistent)


#: Columns of the joint price files, besides the folders'.
JOINT_FILE = [
    "store", "product", "simulation_prices", "predicted_qty", "profit_predicted", "profit_predicted_all", "member",
    "member_price", "member_qty", "member_profit", "profit_predicted_all_reg", "profit_predicted_all_uplift",
    "store_codes", "calculation_group",
]


def joint_files(result: JointPrices, store_ref: DataFrame, path: str) -> None:
    """One folder per store, group and product: the joint price, its gain and each member's price, quantity and profit."""
    gains = result.uplift.select("store", "calculation_group", "product", "simulation_prices", "profit_predicted_all_reg", "profit_predicted_all_uplift")
    codes = store_ref.withColumnRenamed("store_name", "store")
    rows = result.members.join(gains, ["store", "calculation_group", "product", "simulation_prices"]).join(codes, "store")
    tables.write_partitioned_result(rows.select(*JOINT_FILE), path)


def run(
    transactions: DataFrame,
    cost_tables: Mapping[str, DataFrame],
    group_id: str,
    store_ref: DataFrame,
    out: str,
    activity: DataFrame | None = None,
    sold: Sequence[str] | None = config.SALES_CATEGORIES,
    costed: Sequence[str] | None = config.COST_CATEGORIES,
    start: str | None = None,
    end: str | None = None,
) -> None:
    """All steps, from transactions to files below ``out``.

    Writes ``models`` (a sheet per table), ``prices`` (a folder per store, group
    and product) and ``uplift``. ``cost_tables`` has deals, relationships, shops,
    products and shop_group. Tables between the steps are staged and removed at
    the end.
    """
    spark = transactions.sparkSession
    with scratch.one_run(spark):
        sales = scoped_sales(extract_daily(transactions, None, start, end, sold))
        chosen = competing_pairs(weekly_for_pairs(sales, activity))
        models = fit_models(sales, chosen)
        costs = stage(assemble_cost(transactions, **cost_tables, group_id=group_id, start=start, end=end, names=costed), "costs")
        result = optimise(sales, costs, models, store_ref)
        tables.write_workbook(models.sheets(), f"{out}/models")
        joint_files(result, store_ref, f"{out}/prices")
        tables.write_table(simulate.common_result(result.uplift), f"{out}/uplift")
