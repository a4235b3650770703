"""From raw transactions to daily, filled and weekly sales."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise import config
from tillwise.functions import dates, text
from tillwise.operators.keys import HIERARCHY, ITEM, STORE_PRODUCT, place, present

DAILY_KEYS = [*HIERARCHY, "date", "price"]
DAILY_LEVELS = [["store"], ["department", "space", "category"], ["product"], ["date", "price"]]


def select_transactions(
    transactions: DataFrame,
    categories: Sequence[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Keep listed category titles and a local date range, both on raw columns.

    ``names`` are titles without their code, for sources whose codes are not known.
    """
    if categories is not None:
        transactions = transactions.filter(F.col("category_title").isin(*categories))
    if names is not None:
        transactions = transactions.filter(text.strip_code_prefix(F.col("category_title"), True).isin(*names))
    if start is not None and end is not None:
        transactions = transactions.filter(
            dates.in_local_range(F.col("transacted_at"), start, end)
        )
    return transactions


def daily_sales(transactions: DataFrame, only_if_prefixed: bool = False) -> DataFrame:
    """Quantity per store, product, local day and price.

    One shuffle with partial sums in front of it, so a store that holds most of
    the rows sends one row per product, day and price from each task.
    """

    def title(column: str) -> Column:
        return text.strip_code_prefix(F.col(column), only_if_prefixed)

    return transactions.groupBy(
        F.col("shop_title").alias("store"),
        title("department_title").alias("department"),
        title("space_title").alias("space"),
        title("category_title").alias("category"),
        F.col("product_title").alias("product"),
        dates.local_date(F.col("transacted_at")).alias("date"),
        F.round("price_sell", 2).cast("double").alias("price"),
    ).agg(F.coalesce(F.sum("quantity"), F.lit(0.0)).alias("qty"))


def calculation_group(rules: config.GroupRules = config.GroupRules()) -> Column:
    """Modelling level of a category: its space, itself, or a fixed label."""
    category = F.col("category")
    group = F.when(category.isin(*rules.by_space), F.col("space"))
    group = group.when(category.isin(*rules.by_category), category)
    for label, members in rules.by_label.items():
        group = group.when(category.isin(*members), F.lit(label))
    return group.otherwise(F.lit(rules.default))


def add_calculation_group(sales: DataFrame, rules: config.GroupRules = config.GroupRules()) -> DataFrame:
    return sales.withColumn("calculation_group", calculation_group(rules))


def _excluded_categories(rules: config.GroupRules, groups: Sequence[str]) -> list[str]:
    """Categories that the rules put in one of the groups by name; those that go by their space have none."""
    named = {name: name for name in rules.by_category}
    for label, members in rules.by_label.items():
        named |= {name: label for name in members if name not in named}
    return [name for name, group in named.items() if group in groups and name not in rules.by_space]


def scope(
    sales: DataFrame,
    spaces: Sequence[str] | None = config.SPACES,
    rules: config.GroupRules = config.GroupRules(),
    excluded_groups: Sequence[str] = config.EXCLUDED_GROUPS,
) -> DataFrame:
    """Listed spaces only, with a calculation group, without excluded groups and
    without rows that name no store.

    Filters move below the aggregate that makes the category, where every mention
    of it is worked out again for every raw row, in code that the JVM does not
    compile if it grows too long. So groups are excluded by one list of their
    categories, unless a listed space or the default is excluded too.
    """
    if spaces is not None:
        sales = sales.filter(F.col("space").isin(*spaces))
    sales = add_calculation_group(sales, rules).filter(F.col("store").isNotNull())
    if not excluded_groups:
        return sales
    if spaces is None or {*spaces, rules.default} & {*excluded_groups}:
        return sales.filter(~F.col("calculation_group").isin(*excluded_groups))
    names = _excluded_categories(rules, excluded_groups)
    return sales.filter(F.coalesce(~F.col("category").isin(*names), F.lit(True))) if names else sales


def scope_to_test(
    df: DataFrame,
    stores: Sequence[str] | None = config.SAMPLE_STORES,
    groups: Sequence[str] | None = config.TEST_GROUPS,
) -> DataFrame:
    """Restrict a result to sample stores and groups; ``None`` keeps all."""
    if stores is not None:
        df = df.filter(F.col("store").isin(*stores))
    if groups is not None:
        df = df.filter(F.col("calculation_group").isin(*groups))
    return df


def weekly_sales(daily: DataFrame, max_week: int | None = None) -> DataFrame:
    """Mean price and total quantity per product and Wednesday-to-Tuesday week.

    Prices are averaged in whole cents, so the mean does not depend on the order
    in which rows arrive. ``max_week`` keeps weeks of the year below it.
    """
    keys = [c for c in [*HIERARCHY, "calculation_group"] if c in daily.columns]
    cents = F.round(F.col("price") * 100).cast("bigint")
    weekly = (
        daily.filter(F.col("date").isNotNull())
        .groupBy(
            *keys,
            dates.week_start(F.col("date")).alias("week_start"),
            dates.week_index(F.col("date")).alias("week_index"),
            dates.week_of_year(F.col("date")).alias("week_number"),
        )
        .agg(
            (F.sum(cents) / (F.lit(100.0) * F.count("price"))).alias("avg_price"),
            F.sum("qty").alias("qty"),
        )
    )
    if max_week is not None:
        weekly = weekly.filter(F.col("week_number") < max_week)
    return weekly


def keep_price_changes(sales: DataFrame, price: str = "price") -> DataFrame:
    """Drop store products that only ever had one price.

    Two extremes per product replace a distinct count; the aggregate is one row
    per product and joins back as a semi-join.
    """
    moving = (
        sales.filter(present(STORE_PRODUCT))
        .groupBy(*STORE_PRODUCT)
        .agg(F.min(price).alias("__lo"), F.max(price).alias("__hi"))
        .filter(F.col("__lo") < F.col("__hi"))
        .select(*STORE_PRODUCT)
    )
    return sales.join(moving, STORE_PRODUCT, "left_semi")


def _active_products(weekly: DataFrame, thresholds: DataFrame) -> DataFrame:
    """(threshold_id, product, weeks) of the products with enough weeks at or over a threshold.

    The weeks of a product become one row with their quantities, and every
    threshold of its group counts in that row: weekly rows move once, however
    many thresholds there are.
    """
    group = ["store", "calculation_group"]
    strong = weekly.filter(present(ITEM)).groupBy(*ITEM).agg(F.collect_list("qty").alias("weeks"))
    limits = thresholds.select(*group, "threshold_id", "threshold", F.col("weeks_above_threshold").alias("__needed"))
    reached = F.size(F.filter("weeks", lambda qty: qty >= F.col("threshold")))
    return (
        strong.join(limits, group)
        .groupBy("threshold_id", *ITEM, "__needed")
        .agg(F.sum(reached.cast("bigint")).alias("weeks_above_threshold"))
        .filter(F.col("weeks_above_threshold") >= F.col("__needed"))
        .drop("__needed")
    )


def keep_active(weekly: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Keep products with enough strong weeks, with all of their weeks.

    ``thresholds`` has ``threshold_id, store, calculation_group, threshold,
    weeks_above_threshold``. A group may have several thresholds; each passes
    its own copy of the rows, told apart by ``threshold_id``.
    """
    return weekly.join(_active_products(weekly, thresholds), ITEM)


def only_active(weekly: DataFrame, thresholds: DataFrame) -> DataFrame:
    """``keep_active`` without the copies: products that pass any threshold."""
    return weekly.join(_active_products(weekly, thresholds), ITEM, "left_semi")


def require_one_group(sales: DataFrame) -> DataFrame:
    """The table itself, if every product of a store has one calculation group.

    Models group by store, group and product; with two groups the same sales of a
    product would be split between two models. Runs one aggregation.
    """
    groups = sales.groupBy(*STORE_PRODUCT).agg(
        F.min("calculation_group").alias("one"), F.max("calculation_group").alias("other")
    )
    mixed = groups.filter("one <> other").head()
    if mixed is not None:
        raise ValueError(f"product {mixed['product']} of {mixed['store']} is in {mixed.one} and in {mixed.other}")
    return sales


def with_idle_days(daily: DataFrame, calendar_of: DataFrame | None = None) -> DataFrame:
    """Daily rows with the days without a sale that their price carries over.

    ``idle_after`` days follow the last row of a day until the product sells
    again or the data ends; ``idle_ahead`` days lead up to a product's first row.
    A product listed in several places (department, space, category) of its group
    is one product: a day on which any listing sells is no idle day. The data's
    range is that of ``calendar_of`` if given.

    The table is placed by store and product once, and everything per product
    that follows finds it there. That is safe on daily sales: a product has at
    most as many rows as days, prices and listings, however often it is sold.
    """
    keys = ITEM if "calculation_group" in daily.columns else STORE_PRODUCT
    listing = [c for c in HIERARCHY if c in daily.columns and c not in keys]
    whole = daily if calendar_of is None else calendar_of
    span = whole.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    first, last = span.select("lo").scalar(), span.select("hi").scalar()
    in_time = Window.partitionBy(*keys).orderBy("date", "price", *listing)
    following = F.coalesce(F.lead("date").over(in_time), F.date_add(last, 1))
    return place(daily, STORE_PRODUCT).withColumns(
        {
            "idle_after": F.greatest(F.datediff(following, "date") - 1, F.lit(0)),
            "idle_ahead": F.when(
                F.row_number().over(in_time) == 1, F.datediff("date", first)
            ).otherwise(0),
        }
    )


def fill_daily(daily: DataFrame, calendar_of: DataFrame | None = None) -> DataFrame:
    """A row for every product and day of the data's date range.

    Added days have quantity 0, the carried price and ``original_ind`` 0. Each
    row becomes the run of days it stands for, so no calendar is joined.
    """
    run = F.sequence(F.date_sub("date", F.col("idle_ahead")), F.date_add("date", F.col("idle_after")))
    kept = [c for c in daily.columns if c not in ("date", "qty")]
    sold = F.col("day") == F.col("date")
    return (
        with_idle_days(daily, calendar_of)
        .select(*kept, "date", "qty", F.explode(run).alias("day"))
        .select(
            *kept,
            F.when(sold, F.col("qty")).otherwise(0.0).alias("qty"),
            F.when(sold, 1).otherwise(0).alias("original_ind"),
            F.col("day").alias("date"),
        )
    )


def cap_outliers(sales: DataFrame, limit: float = config.OUTLIER_QTY) -> DataFrame:
    """Replace quantities above ``limit`` by the product's largest one within it.

    Equal outlier rows (all columns but quantity) count once. Rows without a
    quantity are dropped. A product with no row in range gets NULL.

    One read, one shuffle, one sort: daily sales are placed by product, whose rows
    are as many as days, prices and listings. There equal rows in and out of range
    stand together, so an outlier only looks at the row before it.
    """
    within = F.col("qty") <= limit
    same = [c for c in sales.columns if c != "qty"]
    others = [c for c in same if c not in ITEM]
    product = Window.partitionBy(*ITEM).orderBy(within, *others, "qty")
    whole = product.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    row = F.struct((~within).alias("out"), *others)
    top = F.when(present(ITEM), F.max(F.when(within, F.col("qty"))).over(whole))
    marked = sales.filter(F.col("qty").isNotNull()).withColumns(
        {"__top": top, "__again": ~within & row.eqNullSafe(F.lag(row).over(product))}
    )
    capped = F.when(within, F.col("qty")).otherwise(F.col("__top"))
    return marked.filter(~F.col("__again")).withColumn("qty", capped).select(*same, "qty")


def price_stats_per_row(daily: DataFrame) -> DataFrame:
    """Each daily row with its product's number of prices and, for its price,
    the distinct days and total quantity.

    A distinct count cannot run over a window and a window would hold a whole
    product, so both levels are aggregated and joined back.
    """
    daily = place(daily, STORE_PRODUCT)
    at_price = daily.groupBy(*STORE_PRODUCT, "price").agg(
        F.count_distinct("date").alias("unique_days"), F.sum("qty").alias("total_qty")
    )
    per_product = at_price.groupBy(*STORE_PRODUCT).agg(F.count("price").alias("unique_prices"))
    return daily.join(at_price, [*STORE_PRODUCT, "price"]).join(per_product, STORE_PRODUCT)


def store_lookup(values: Mapping[str, tuple], default: Sequence, names: Sequence[str]) -> dict[str, Column]:
    """Columns from a per-store table given in code, with defaults for the rest."""
    out = {}
    for i, name in enumerate(names):
        picked = F.lit(default[i])
        for store, row in values.items():
            picked = F.when(F.col("store") == store, F.lit(row[i])).otherwise(picked)
        out[name] = picked
    return out
