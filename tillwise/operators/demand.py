"""Demand points and the simple price model of each product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise import config
from tillwise.functions.numeric import linearity, r2_band
from tillwise.functions.student_t import two_sided_p
from tillwise.operators.keys import ITEM, STORE_PRODUCT, place
from tillwise.operators.prep import with_idle_days

PRICE = "Price"
CONST = "const"
TOO_FEW = "Less than 2 data points"


def _finish_points(per_price: DataFrame) -> DataFrame:
    """Average per day, and the number of prices per product. The window holds
    one row per price of a product."""
    prices = Window.partitionBy(*STORE_PRODUCT)
    return per_price.select(
        *ITEM,
        "price",
        "unique_days",
        "total_qty",
        (F.col("total_qty") / F.col("unique_days")).alias("avg_qty"),
        F.count("price").over(prices).alias("unique_prices"),
    )


def demand_points(daily: DataFrame) -> DataFrame:
    """Per product and price: distinct days, total quantity, quantity per day.

    Placed by product first, so that days are told apart where they are counted.
    """
    return _finish_points(
        place(daily, STORE_PRODUCT).groupBy(*ITEM, "price").agg(
            F.count_distinct("date").alias("unique_days"), F.sum("qty").alias("total_qty")
        )
    )


def demand_points_carried(daily: DataFrame) -> DataFrame:
    """``demand_points(fill_daily(daily))`` without writing out the empty days.

    A day without sales adds nothing but its day to the carried price, so the
    lengths of the gaps are enough. The work follows the days with sales instead
    of the whole calendar.
    """
    idle = F.sum(F.col("idle_ahead") + F.col("idle_after"))
    return _finish_points(
        with_idle_days(daily)
        .groupBy(*ITEM, "price")
        .agg(
            (F.count_distinct("date") + idle).alias("unique_days"), F.sum("qty").alias("total_qty")
        )
    )


def cumulative_demand(points: DataFrame) -> DataFrame:
    """Quantity sold per day at or above each price: a running sum from the
    highest price down, over the price points of one product."""
    down = (
        Window.partitionBy(*STORE_PRODUCT)
        .orderBy(F.col("price").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return points.withColumn("inverted_qty", F.sum("avg_qty").over(down))


def _slope_p_value(n: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    """p of the slope; a perfect fit gives 0, no spare degree of freedom NULL."""
    nu = n - 2
    residual = syy - sxy * sxy / sxx
    t = (sxy / sxx) / F.sqrt(residual / nu / sxx)
    return F.when(nu >= 1, F.when(residual <= 0, F.lit(0.0)).otherwise(two_sided_p(t, nu)))


def simple_regression(curve: DataFrame, alpha: float = config.ALPHA) -> DataFrame:
    """``inverted_qty ~ const + price`` per product, from running moments only."""
    x, y = "price", "inverted_qty"
    moments = curve.groupBy(*ITEM).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(x).alias("mx"),
        F.avg(y).alias("my"),
        F.regr_sxx(y, x).alias("sxx"),
        F.regr_syy(y, x).alias("syy"),
        F.regr_sxy(y, x).alias("sxy"),
    )
    fits = (F.col("n") >= 2) & (F.col("sxx") > 0)
    slope = F.try_divide("sxy", "sxx")
    # at most 1: two points fit exactly, and rounding must not put them above it
    explained = F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx") * F.col("syy"))
    measured = moments.select(
        *ITEM,
        "n",
        F.when(F.col("n") >= 2, F.lit(PRICE)).alias("variable"),
        F.when(fits, slope).alias("coefficient"),
        F.when(fits, F.col("my") - slope * F.col("mx")).alias("intercept"),
        F.when(fits, _slope_p_value(F.col("n"), F.col("sxx"), F.col("syy"), F.col("sxy"))).alias("p_value"),
        F.when(fits & explained.isNotNull(), F.least(explained, F.lit(1.0))).alias("r_squared"),
    )
    return measured.select(
        *ITEM,
        "variable",
        "coefficient",
        "intercept",
        "p_value",
        "r_squared",
        F.when(F.col("n") < 2, F.lit(TOO_FEW))
        .otherwise(linearity(F.col("p_value"), alpha))
        .alias("linearity"),
        r2_band(F.col("r_squared")).alias("r_squared_group"),
    )


def product_features(daily: DataFrame, calendar_days: Column | None = None) -> DataFrame:
    """Days with sales, distinct prices, total quantity and quantity per day.

    ``calendar_days`` is the number of days of filled sales; without it the days
    in the table count. Rows are placed by product, summed to day and price there,
    and a product's prices and days are sets no larger than its calendar.
    """
    cells = place(daily, ITEM).groupBy(*ITEM, "date", "price").agg(
        F.sum("qty").alias("qty"),
        F.sum(F.when(F.col("qty") > 0, 1).otherwise(0)).alias("selling_rows"),
    )
    grouped = cells.groupBy(*ITEM).agg(
        F.size(F.collect_set("price")).cast("bigint").alias("unique_prices"),
        F.sum("selling_rows").cast("bigint").alias("days_with_sales"),
        F.size(F.collect_set("date")).alias("__days"),
        F.sum("qty").alias("total_qty"),
    )
    days = F.col("__days") if calendar_days is None else calendar_days
    return grouped.withColumn("avg_qty", F.col("total_qty") / days).drop("__days")


def constant_elasticity(train: DataFrame) -> DataFrame:
    """Mean quantity and mean price per product, elasticity -1: the stock model."""
    return train.groupBy(*ITEM).agg(
        F.avg("qty").alias("qty_mean"),
        F.avg("price").alias("price_mean"),
        F.lit(-1.0).alias("elasticity"),
    )


def constant_elasticity_qty(price: Column) -> Column:
    """q = mean_q * (p / mean_p) ** elasticity; a missing or zero mean price counts as 1."""
    base = F.when(F.col("price_mean").isNull() | (F.col("price_mean") == 0), F.lit(1.0)).otherwise(
        F.col("price_mean")
    )
    return F.coalesce("qty_mean", F.lit(0.0)) * F.pow(price / base, F.col("elasticity"))
