"""Every operator as a query over the bundled test tables.

Values that depend on the order of floating-point sums are cut to six places, so
that they can be compared with another engine's, results of the competitor
models to four: they subtract large effects from each other. The cut lies off the
middle between two steps, as short decimals often sit exactly there.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise import config
from tillwise.functions import numeric, text
from tillwise.operators import audit, cost, crosseffects, demand, ordinal, pairs, prep, simulate
from tillwise.operators.keys import ITEM
from tillwise.plans import quality, steps, strategy
from tillwise.sources import scratch, tables
from tillwise.sources.marketdata import Market

# Run parameters of the checks.
RANGE = ("1998-01-01", "1999-12-31")
DEAL_WINDOW = ("1998-01-01", "1998-03-31")
CATEGORIES = ("311 - SOFT DRINKS", "310 - CHOCOLATES", "308 - BISCUITS", "313 - CONFECTIONERY")
GROUP_ID = "main"
OUTLIER_QTY = 60
# Two of the test stores' thresholds are looser than the stock ones: the test
# data is random, and over seven years few pairs would be left.
PAIR_THRESHOLDS = {
    "Country Store": (-0.3, -0.3),
    "Metro Store": (-0.05, -0.05),
    "Metro Discount": (-0.1, -0.1),
}
PRODUCTS = [
    f"{kind} Brand#{brand}"
    for kind in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
    for brand in range(1, 26)
]


CUT = 0.4375


def _cut(df: DataFrame, columns: tuple[str, ...], unit: float) -> DataFrame:
    return df.withColumns({c: F.floor(F.col(f"`{c}`") * unit + CUT) / unit for c in columns})


def r6(df: DataFrame, *columns: str) -> DataFrame:
    return _cut(df, columns, 1e6)


def r4(df: DataFrame, *columns: str) -> DataFrame:
    return _cut(df, columns, 1e4)


class _Inputs:
    """The intermediate tables the queries start from."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.tables = Market(spark, sf_dir)

    @property
    def transactions(self) -> DataFrame:
        return self.tables["transaction_items"]

    @property
    def daily(self) -> DataFrame:
        return prep.daily_sales(self.transactions)

    @property
    def sales(self) -> DataFrame:
        return prep.scope(self.daily)

    @property
    def weekly(self) -> DataFrame:
        return steps.weekly_for_pairs(self.sales_table)

    @property
    def activity(self) -> DataFrame:
        groups = self.sales_table.select("store", "calculation_group").distinct()
        once = groups.select(
            F.lit(1).alias("threshold_id"), "*", F.lit(45.0).alias("threshold"), F.lit(10).alias("weeks_above_threshold")
        )
        again = groups.filter(F.col("store") == "Metro Store").select(
            F.lit(2).alias("threshold_id"), "*", F.lit(60.0).alias("threshold"), F.lit(3).alias("weeks_above_threshold")
        )
        return once.unionByName(again)

    @property
    def activity_of_quarter(self) -> DataFrame:
        """Thresholds that fit a quarter of each year."""
        return self.activity.withColumn("weeks_above_threshold", F.col("weeks_above_threshold") - 2)

    @cached_property
    def sales_table(self) -> DataFrame:
        """Sales written once, for queries that read them many times."""
        return prep.require_one_group(scratch.stage(self.sales, "sales"))

    @cached_property
    def chosen(self) -> DataFrame:
        """The competing pairs, as a table: several consumers read them."""
        return steps.competing_pairs(self.weekly, PAIR_THRESHOLDS)

    def cross_points(self) -> DataFrame:
        return steps.cross_points(self.sales_table, self.chosen)

    @property
    def deals(self) -> DataFrame:
        return cost.deals_in_window(self.tables["thread_deal"], *DEAL_WINDOW)

    def deal_inputs(self) -> tuple:
        t = self.tables
        return (self.deals, t["relationships"], t["shops"], t["thread_product"], t["shop_group"], GROUP_ID)

    @property
    def product_cost(self) -> DataFrame:
        t = self.tables
        return cost.product_cost(t["thread_product"], t["shops"], t["shop_group"], GROUP_ID)

    @property
    def lowest_cost(self) -> DataFrame:
        t = self.tables
        return steps.assemble_cost(
            self.transactions, self.deals, t["relationships"], t["shops"], t["thread_product"],
            t["shop_group"], GROUP_ID,
        )

    @property
    def grid(self) -> DataFrame:
        return steps.priced_grid(self.sales_table, self.lowest_cost)

    @property
    def models(self) -> steps.Models:
        return steps.fit_models(self.sales_table, self.chosen)

    @cached_property
    def comparison(self) -> DataFrame:
        return scratch.stage(self.models.comparison, "comparison")

    def simulation(self, stores=None, groups=None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Better cross models, the grid, and the simple outcome on it."""
        models = self.models
        better = crosseffects.uplift_models(models.cross, models.comparison)
        better = scratch.stage(prep.scope_to_test(better, stores, groups), "uplift")
        grid = scratch.stage(prep.scope_to_test(self.grid, stores, groups), "grid")
        return better, grid, simulate.simulate_simple(models.simple, grid)


#: The stores and groups of a trial run; what takes them says so.
SAMPLE = (config.SAMPLE_STORES, config.TEST_GROUPS)


# --- sales ------------------------------------------------------------------


def daily_sales(i: _Inputs) -> DataFrame:
    return i.daily


def extract_daily(i: _Inputs) -> DataFrame:
    return steps.extract_daily(i.transactions, CATEGORIES, *RANGE)


def local_date_range(i: _Inputs) -> DataFrame:
    return steps.extract_daily(i.transactions, None, *RANGE)


def row_count(i: _Inputs) -> DataFrame:
    return audit.row_count(i.daily)


def page_assign(i: _Inputs) -> DataFrame:
    return ordinal.assign_pages(i.daily, prep.DAILY_LEVELS, config.PAGE_SIZE)


def strip_code_prefix(i: _Inputs) -> DataFrame:
    category, product = F.col("category_title"), F.col("product_title")
    return i.transactions.groupBy(
        "category_title",
        "product_title",
        text.strip_code_prefix(category).alias("category"),
        text.strip_code_prefix(product).alias("product_literal"),
        text.strip_code_prefix(product, only_if_prefixed=True).alias("product_kept"),
    ).agg(F.count(F.lit(1)).alias("n"))


def sanitize_key(i: _Inputs) -> DataFrame:
    return i.transactions.select(
        "product_title",
        text.sanitize_key(F.col("product_title")).alias("product_key"),
        text.safe_file_name(F.concat_ws("/", "category_title", "product_title")).alias("file_name"),
    ).distinct()


def scope_filter(i: _Inputs) -> DataFrame:
    return i.sales


def calculation_group(i: _Inputs) -> DataFrame:
    return prep.add_calculation_group(i.daily)


def group_check(i: _Inputs) -> DataFrame:
    return audit.group_check(prep.add_calculation_group(i.daily))


def tolerant_cast(i: _Inputs) -> DataFrame:
    value = (
        F.when(F.col("event_id") % 7 == 0, "n/a")
        .when(F.col("event_id") % 11 == 0, "")
        .otherwise(F.col("value").cast("string"))
    )
    events = i.tables["events"].withColumn("raw", value)
    return events.select("event_id", "raw", numeric.tolerant_number(F.col("raw")).alias("number"))


def weekly_sales(i: _Inputs) -> DataFrame:
    return prep.weekly_sales(i.sales)


def weekly_sales_quarter(i: _Inputs) -> DataFrame:
    return prep.weekly_sales(i.sales, max_week=13)


def activity_threshold(i: _Inputs) -> DataFrame:
    return prep.keep_active(prep.weekly_sales(i.sales_table), i.activity)


def price_change_filter(i: _Inputs) -> DataFrame:
    return prep.keep_price_changes(i.sales_table)


def cap_outliers(i: _Inputs) -> DataFrame:
    return prep.cap_outliers(i.sales_table, OUTLIER_QTY)


def fill_daily(i: _Inputs) -> DataFrame:
    filled = prep.fill_daily(i.sales_table)
    return filled.groupBy(*ITEM, "price", "original_ind").agg(
        F.count(F.lit(1)).alias("days"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.sum("qty").alias("qty"),
    )


def csv_roundtrip(i: _Inputs) -> DataFrame:
    daily = i.daily
    path = scratch.new_path(i.spark, "daily-csv")
    tables.write_table(daily, path, "csv")
    return tables.read_table(i.spark, path, "csv", daily.schema)


def workbook_roundtrip(i: _Inputs) -> DataFrame:
    """Both sheets: every week with the number of groups its listing is in."""
    weekly, groups = prep.weekly_sales(i.sales), audit.group_check(i.sales)
    path = scratch.new_path(i.spark, "workbook")
    tables.write_workbook({"weekly": weekly, "groups": groups}, path)
    listing = ["department", "space", "category"]
    counted = tables.read_sheet(i.spark, path, "groups", groups.schema).groupBy(*listing).agg(F.count(F.lit(1)).alias("groups"))
    return tables.read_sheet(i.spark, path, "weekly", weekly.schema).join(counted, listing)


# --- checks -----------------------------------------------------------------


def top_rows(i: _Inputs) -> DataFrame:
    return audit.top_rows(i.daily, prep.DAILY_KEYS, 60)


def duplicate_rows(i: _Inputs) -> DataFrame:
    sold = i.transactions.select("shop_title", "product_id", "product_title", "category_title", "price_sell", "price_margin")
    cost_rows = sold.withColumn("cost_txn", (F.col("price_sell") - F.col("price_margin")).cast("double"))
    return audit.duplicate_rows(cost_rows.drop("price_sell", "price_margin"))


def null_audit(i: _Inputs) -> DataFrame:
    t = i.tables["thread_deal"].select("id", "price", "title", "minimum_qty", "event_start", "event_end")
    return audit.null_audit(t)


def coverage_stats(i: _Inputs) -> DataFrame:
    return audit.coverage_stats(i.sales)


def quantile_bounds(i: _Inputs) -> DataFrame:
    bounds = audit.quantile_bounds(prep.keep_price_changes(i.sales_table), ["qty", "price"])
    return r6(bounds, "q1", "q3", "q99", "iqr", "lower_bound", "upper_bound")


# --- cost -------------------------------------------------------------------


def cost_from_transactions(i: _Inputs) -> DataFrame:
    return cost.cost_from_transactions(i.transactions)


def cost_extract(i: _Inputs) -> DataFrame:
    """Costs of the listed categories and local days only."""
    sold = prep.select_transactions(i.transactions, CATEGORIES, *RANGE)
    return cost.cost_from_transactions(sold)


def cost_from_transactions_join_back(i: _Inputs) -> DataFrame:
    return cost.cost_from_transactions(i.transactions, join_back=True)


def shop_group_filter(i: _Inputs) -> DataFrame:
    products = i.tables["thread_product"].select("id", "shop_id", "title")
    return cost.in_shop_group(products, i.tables["shop_group"], GROUP_ID, "shop_id")


def _deal_rows(deals: DataFrame) -> DataFrame:
    return deals.select("id", F.col("price").cast("double").alias("price"), "title")


def deal_window(i: _Inputs) -> DataFrame:
    return _deal_rows(i.deals)


def deal_window_overlap(i: _Inputs) -> DataFrame:
    return _deal_rows(cost.deals_in_window(i.tables["thread_deal"], *DEAL_WINDOW, mode="overlap"))


def deal_cost(i: _Inputs) -> DataFrame:
    return cost.deal_cost(*i.deal_inputs())


def lowest_deal_cost(i: _Inputs) -> DataFrame:
    return cost.lowest_deal_cost(*i.deal_inputs())


def product_cost(i: _Inputs) -> DataFrame:
    return i.product_cost


def cost_sources_union(i: _Inputs) -> DataFrame:
    return cost.cost_sources_union(
        i.product_cost, cost.deal_cost(*i.deal_inputs()), cost.cost_from_transactions(i.transactions)
    )


def lowest_cost(i: _Inputs) -> DataFrame:
    return i.lowest_cost


def feasible_cost(i: _Inputs) -> DataFrame:
    products = i.sales_table.select("store", "product").distinct()
    master = i.product_cost.join(
        cost.cost_from_transactions(i.transactions), ["store", "product"], "full"
    )
    return cost.feasible_cost(products, master)


# --- pairs ------------------------------------------------------------------

_CORRELATIONS = ["correlation_coefficient_p", "correlation_coefficient_q", "total_correlation"]


def pair_correlation(i: _Inputs) -> DataFrame:
    return r6(pairs.pair_correlation(i.weekly), *_CORRELATIONS)


def pair_correlation_all_stores(i: _Inputs) -> DataFrame:
    return r6(pairs.pair_correlation(i.weekly, scope="all"), *_CORRELATIONS)


def pair_rank_correlation(i: _Inputs) -> DataFrame:
    return r6(pairs.pair_rank_correlation(i.weekly), *_CORRELATIONS, "correlation_coefficient_q_rank")


def select_pairs(i: _Inputs) -> DataFrame:
    """With the stock thresholds."""
    return pairs.select_pairs(i.weekly).select("store", "product_1", "product_2")


def pairs_of_active(i: _Inputs) -> DataFrame:
    """Pairs of products with enough strong weeks, from the weeks before the bound."""
    weekly = steps.weekly_for_pairs(i.sales_table, i.activity_of_quarter, max_week=13)
    return r6(pairs.pair_rank_correlation(weekly), *_CORRELATIONS, "correlation_coefficient_q_rank")


# --- demand -----------------------------------------------------------------

_MODEL = ["coefficient", "intercept", "p_value", "r_squared"]


def unique_prices_window(i: _Inputs) -> DataFrame:
    return prep.price_stats_per_row(i.sales_table)


def demand_points(i: _Inputs) -> DataFrame:
    return demand.demand_points_carried(i.sales_table)


def demand_points_observed(i: _Inputs) -> DataFrame:
    return demand.demand_points(i.sales_table)


def cumulative_demand(i: _Inputs) -> DataFrame:
    return r6(demand.cumulative_demand(demand.demand_points_carried(i.sales_table)), "inverted_qty")


def simple_regression(i: _Inputs) -> DataFrame:
    return r6(steps.simple_models(i.sales_table), *_MODEL)


def r2_band(i: _Inputs) -> DataFrame:
    models = steps.simple_models(i.sales_table)
    return models.groupBy("calculation_group", "r_squared_group", "linearity").agg(F.count(F.lit(1)).alias("models"))


def product_features(i: _Inputs) -> DataFrame:
    return steps.sales_features(i.sales_table)


def constant_elasticity(i: _Inputs) -> DataFrame:
    return r6(demand.constant_elasticity(i.sales), "qty_mean", "price_mean")


# --- competitor models ------------------------------------------------------


def price_difference_features(i: _Inputs) -> DataFrame:
    features = crosseffects.price_difference_features(prep.fill_daily(i.sales_table), i.chosen)
    return features.groupBy(*ITEM, "product_2").agg(
        F.count(F.lit(1)).alias("days"),
        F.count("price_difference").alias("priced_days"),
        F.round(F.sum("price_difference"), 4).alias("difference_sum"),
        F.min("price_difference").alias("difference_min"),
        F.max("price_difference").alias("difference_max"),
        F.sum("qty").alias("qty"),
    )


def price_differences_carried(i: _Inputs) -> DataFrame:
    return r6(crosseffects.price_differences_carried(i.sales_table, i.chosen), "price_difference")


def demand_points_cross(i: _Inputs) -> DataFrame:
    points = r6(i.cross_points(), "inverted_qty")
    joined = F.array_join(F.transform("differences", lambda d: F.round(d * 100).cast("bigint").cast("string")), "|")
    return points.select(
        *ITEM, "price", joined.alias("differences_in_cents"),
        F.size("rivals").cast("bigint").alias("rivals"),
        "price_diff_all", "unique_days", "total_qty", "inverted_qty",
    )


def vif(i: _Inputs) -> DataFrame:
    return r4(crosseffects.variance_inflation(i.cross_points()), "vif")


def ols_model(i: _Inputs) -> DataFrame:
    return r4(crosseffects.cross_model(i.cross_points()), *_MODEL, "vif")


def ols_model_literal(i: _Inputs) -> DataFrame:
    return r4(crosseffects.cross_model(i.cross_points(), features="literal"), *_MODEL, "vif")


def model_comparison(i: _Inputs) -> DataFrame:
    measured = [f"{m}_{kind}" for m in _MODEL for kind in ("simple", "cross")]
    return r4(i.models.comparison, *measured, "vif_cross", "lift_by_cannibalization")


def uplift_models(i: _Inputs) -> DataFrame:
    models = i.models
    better = crosseffects.uplift_models(models.cross, models.comparison)
    return r4(better, *_MODEL, "vif", "r_squared_simple", "r_squared_cross", "lift_by_cannibalization")


def model_report_roundtrip(i: _Inputs) -> DataFrame:
    """The three sheets of the model report, written and read back: rows and models per sheet and store."""
    path = scratch.new_path(i.spark, "report")
    sheets = i.models.sheets()
    tables.write_workbook(sheets, path)
    read = [
        tables.read_sheet(i.spark, path, name, sheet.schema).groupBy("store").agg(
            F.lit(name).alias("sheet"), F.count(F.lit(1)).alias("rows"), F.count_distinct("calculation_group", "product").alias("products")
        )
        for name, sheet in sheets.items()
    ]
    return read[0].unionByName(read[1]).unionByName(read[2])


def _tree(i: _Inputs) -> tuple[quality.QualityTree, DataFrame]:
    train, test = quality.split_rows(i.comparison)
    return quality.fit_quality_tree(i.comparison, train), test


def quality_tree_split(i: _Inputs) -> DataFrame:
    return i.comparison.select(*ITEM, quality.is_test_row().alias("is_test"))


def quality_tree_features(i: _Inputs) -> DataFrame:
    """The names of the tree's features, and what their importances add up to."""
    weights = _tree(i)[0].importances()
    total = weights.agg(F.round(F.sum("importance"), 6)).scalar()
    return weights.select("feature_idx", "feature", total.alias("importance_sum"))


def quality_tree_support(i: _Inputs) -> DataFrame:
    return quality.support(i.comparison)


def quality_tree_importance(i: _Inputs) -> DataFrame:
    return _tree(i)[0].importances()


def quality_tree_report(i: _Inputs) -> DataFrame:
    tree, test = _tree(i)
    return tree.report(test)


# --- prices -----------------------------------------------------------------

_OUTCOME = ["qty_predicted", "profit_predicted"]


def price_grid(i: _Inputs) -> DataFrame:
    return simulate.moving_price_grid(i.sales_table)


def grid_with_cost(i: _Inputs) -> DataFrame:
    return r6(i.grid, "simulation_profit")


def simulate_simple(i: _Inputs) -> DataFrame:
    return r6(simulate.simulate_simple(steps.simple_models(i.sales_table), i.grid), *_OUTCOME)


def best_price_simple(i: _Inputs) -> DataFrame:
    best = simulate.best_price(simulate.simulate_simple(steps.simple_models(i.sales_table), i.grid))
    return r6(best, *_OUTCOME)


def simulate_constant_elasticity(i: _Inputs) -> DataFrame:
    outcome = simulate.simulate_constant_elasticity(demand.constant_elasticity(i.sales_table), i.grid)
    return r6(outcome, *_OUTCOME)


def strategy_best_price(i: _Inputs) -> DataFrame:
    return r6(strategy.best_prices(i.sales_table, i.lowest_cost), *_OUTCOME)


def own_effect(i: _Inputs) -> DataFrame:
    better, grid, _ = i.simulation()
    return r4(simulate.own_effect(better, grid), "coefficient", "intercept", "simulation_profit", "qty_adjustment")


def competitor_effect(i: _Inputs) -> DataFrame:
    better, grid, outcome = i.simulation()
    effect = simulate.competitor_effect(better, grid, outcome)
    return r4(effect, "coefficient", "profit_predicted", "qty_adjustment")


def _joint_rows(joint: DataFrame) -> DataFrame:
    flat = joint.withColumn(
        "competitor_prices",
        F.coalesce(
            F.array_join(
                F.transform("competitors", lambda c: F.concat(c["competitor"], F.lit("="), F.round(c["simulation_prices"] * 10).cast("bigint").cast("string"))),
                "|",
            ),
            F.lit(""),
        ),
    ).drop("competitors")
    return r4(flat, "simulation_profit", "predicted_qty", "profit_predicted", "profit_predicted_all")


def joint_best_price(i: _Inputs) -> DataFrame:
    """In the sample's stores and groups."""
    return _joint_rows(simulate.joint_best_price(*i.simulation(*SAMPLE)))


def joint_best_price_all(i: _Inputs) -> DataFrame:
    return _joint_rows(simulate.joint_best_price(*i.simulation()))


def joint_best_price_consistent(i: _Inputs) -> DataFrame:
    return _joint_rows(simulate.joint_best_price(*i.simulation(), consistent=True))


def baseline_members(i: _Inputs) -> DataFrame:
    """The long form of the product and competitor pivot."""
    better, _, outcome = i.simulation()
    return r4(simulate.baseline_members(better, simulate.best_price(outcome)), *_OUTCOME)


def baseline_profit(i: _Inputs) -> DataFrame:
    better, _, outcome = i.simulation()
    baseline = simulate.baseline_profit(better, simulate.best_price(outcome))
    return r4(baseline, "profit_predicted_all_reg")


def _uplift(i: _Inputs, *scope) -> steps.JointPrices:
    return steps.optimise(i.sales_table, i.lowest_cost, i.models, i.tables["store_ref"], *scope)


def _common(result: steps.JointPrices) -> DataFrame:
    profits = [c for c in simulate.COMMON_COLUMNS if c.startswith("profit")]
    return r4(simulate.common_result(result.uplift), *profits)


def profit_uplift(i: _Inputs) -> DataFrame:
    """In the sample's stores and groups."""
    return _common(_uplift(i, *SAMPLE))


def profit_uplift_all(i: _Inputs) -> DataFrame:
    return _common(_uplift(i))


def joint_result_files(i: _Inputs) -> DataFrame:
    """The joint prices with their members, written a folder per product and read back."""
    path = scratch.new_path(i.spark, "joint-prices")
    steps.joint_files(_uplift(i), i.tables["store_ref"], path)
    schema = (
        "store string, product string, simulation_prices double, predicted_qty double, profit_predicted double, "
        "profit_predicted_all double, member string, member_price double, member_qty double, member_profit double, "
        "profit_predicted_all_reg double, profit_predicted_all_uplift double, store_codes string, calculation_group string, product_key string"
    )
    measured = [c for c in re.findall(r"(\w+) double", schema) if c not in ("simulation_prices", "member_price")]
    return r4(tables.read_partitioned_result(i.spark, path, schema), *measured)


def result_pivot(i: _Inputs) -> DataFrame:
    best = simulate.best_price(simulate.simulate_simple(steps.simple_models(i.sales_table), i.grid))
    wide = simulate.result_pivot(best, PRODUCTS)
    return r6(wide, *[c for c in wide.columns if c.startswith("profit")])


def partitioned_result(i: _Inputs) -> DataFrame:
    best = simulate.best_price(simulate.simulate_simple(steps.simple_models(i.sales_table), i.grid))
    codes = i.tables["store_ref"].withColumnRenamed("store_name", "store")
    path = scratch.new_path(i.spark, "best-prices")
    tables.write_partitioned_result(best.join(codes, "store"), path)
    schema = (
        "store string, product string, simulation_prices double, qty_predicted double, "
        "profit_predicted double, store_codes string, calculation_group string, product_key string"
    )
    return r6(tables.read_partitioned_result(i.spark, path, schema), *_OUTCOME)


def _registered(function: Callable[[_Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: function(_Inputs(spark, sf_dir))


ALL = [
    daily_sales, extract_daily, local_date_range, row_count, page_assign, strip_code_prefix,
    sanitize_key, scope_filter, calculation_group, group_check, tolerant_cast, weekly_sales,
    weekly_sales_quarter, activity_threshold, price_change_filter, cap_outliers, fill_daily,
    csv_roundtrip, workbook_roundtrip, top_rows, duplicate_rows, null_audit, coverage_stats,
    quantile_bounds, cost_extract, cost_from_transactions, cost_from_transactions_join_back, shop_group_filter,
    deal_window, deal_window_overlap, deal_cost, lowest_deal_cost, product_cost,
    cost_sources_union, lowest_cost, feasible_cost, pair_correlation, pair_correlation_all_stores,
    pair_rank_correlation, select_pairs, pairs_of_active, unique_prices_window, demand_points,
    demand_points_observed, cumulative_demand, simple_regression, r2_band, product_features,
    constant_elasticity, price_difference_features, price_differences_carried, demand_points_cross, vif, ols_model,
    ols_model_literal, model_comparison, uplift_models, model_report_roundtrip,
    quality_tree_split, quality_tree_features, quality_tree_support, quality_tree_importance,
    quality_tree_report, price_grid, grid_with_cost, simulate_simple, best_price_simple,
    simulate_constant_elasticity, strategy_best_price, own_effect, competitor_effect,
    joint_best_price, joint_best_price_all, joint_best_price_consistent, baseline_members,
    baseline_profit, profit_uplift, profit_uplift_all, joint_result_files, result_pivot,
    partitioned_result,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {function.__name__: _registered(function) for function in ALL}
