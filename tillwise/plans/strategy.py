"""Replaceable rules: pair choice, demand model, cost choice, simulation.

A rule is a function of DataFrames, so a rule brought in by the user runs as
distributed as the stock ones.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.operators import cost, demand, pairs, simulate
from tillwise.operators.keys import ITEM, STORE_PRODUCT
from tillwise.operators.prep import keep_price_changes, weekly_sales


def no_pairs(weekly: DataFrame) -> DataFrame:
    """The stock rule: products do not interact."""
    return weekly.select("store", F.col("product").alias("product_1"), F.col("product").alias("product_2")).limit(0)


def correlated_pairs(weekly: DataFrame) -> DataFrame:
    """Pairs below the correlation thresholds of their store."""
    return pairs.select_pairs(weekly).select("store", "product_1", "product_2")


def own_price_only(sales: DataFrame, chosen: DataFrame) -> DataFrame:
    """The stock demand model: constant elasticity, whatever the pairs."""
    return demand.constant_elasticity(sales)


@dataclass(frozen=True)
class PricingStrategy:
    """weekly -> pairs; sales, pairs -> models; products, costs -> cost; models, grid -> outcome."""

    select_pairs: Callable[[DataFrame], DataFrame] = no_pairs
    build_demand_model: Callable[[DataFrame, DataFrame], DataFrame] = own_price_only
    feasible_cost: Callable[[DataFrame, DataFrame], DataFrame] = cost.feasible_cost
    simulate_prices: Callable[[DataFrame, DataFrame], DataFrame] = simulate.simulate_constant_elasticity


def candidate_pairs(sales: DataFrame, strategy: PricingStrategy = PricingStrategy()) -> DataFrame:
    return strategy.select_pairs(keep_price_changes(weekly_sales(sales), "avg_price"))


def best_prices(
    sales: DataFrame, costs: DataFrame, strategy: PricingStrategy = PricingStrategy()
) -> DataFrame:
    """Best grid price of every product under a strategy; losses are left out.

    The pairs that the strategy chooses go to its demand model, with the sales.
    """
    moving = keep_price_changes(sales)
    grid = simulate.price_grid(moving)
    products = grid.select(*STORE_PRODUCT).distinct()
    usable = strategy.feasible_cost(products, costs).withColumnRenamed("feasible_cost", "cost_lowest")
    priced = simulate.grid_with_cost(grid, usable)
    models = strategy.build_demand_model(moving, candidate_pairs(sales, strategy))
    outcome = strategy.simulate_prices(models, priced)
    return simulate.best_price(outcome.filter(F.col("profit_predicted") > 0)).select(
        *ITEM, "simulation_prices", "qty_predicted", "profit_predicted"
    )
