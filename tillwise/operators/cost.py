"""Unit cost of a product from three sources, and the lowest of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions import dates
from tillwise.functions.text import strip_code_prefix
from tillwise.operators.keys import STORE_PRODUCT, place, present

_LISTING = ["shop_title", "product_id", "product_title", "category"]
# The same with the key of most values first: sorting compares the first key's beginnings before whole rows.
_SORTED_LISTING = ["product_id", "shop_title", "product_title", "category"]

# Times the usual number of partitions where listings, products and base products are sorted in one task.
_SMALL = 4


def latest_transaction_cost(transactions: DataFrame, join_back: bool = False) -> DataFrame:
    """Lowest cost at the latest sale of each listing (shop, id, title, category).

    A listing is reduced by one mergeable maximum of (time, -cost): no sort, no
    second read, and a much sold product costs no more than any other. Sales at
    the same instant give the lowest of their costs.

    ``join_back=True`` instead joins the latest time to the sales by shop, id and
    time, which also takes in a same-instant sale under another title or category
    of that id. The time is part of the join key, so the sales of a hot product
    still spread over tasks.
    """
    listed = transactions.withColumn("category", strip_code_prefix(F.col("category_title")))
    cost = F.col("price_sell") - F.col("price_margin")
    listed = listed.withColumn("cost_txn", cost.cast("double"))
    if not join_back:
        latest = F.max(F.struct("transacted_at", (-F.col("cost_txn")).alias("c")))
        return (
            listed.groupBy(*_SORTED_LISTING)
            .agg(latest.alias("latest"))
            .select(
                *_LISTING,
                F.col("latest.transacted_at").alias("last_txn_date"),
                (-F.col("latest.c")).alias("cost_txn"),
            )
        )
    last = listed.groupBy(*_LISTING).agg(F.max("transacted_at").alias("last_txn_date"))
    sold = listed.select(
        F.col("shop_title"), "product_id", F.col("transacted_at").alias("last_txn_date"), "cost_txn"
    )
    return (
        last.join(sold, ["shop_title", "product_id", "last_txn_date"], "left")
        .groupBy(*_LISTING, "last_txn_date")
        .agg(F.min("cost_txn").alias("cost_txn"))
    )


def cost_from_transactions(transactions: DataFrame, join_back: bool = False) -> DataFrame:
    """Lowest latest-sale cost per store, category and product."""
    latest = latest_transaction_cost(transactions, join_back).filter(F.col("cost_txn").isNotNull())
    return (
        latest.withColumnsRenamed({"shop_title": "store", "product_title": "product"})
        .filter(present(["store", "category", "product"]))
        .groupBy("store", "category", "product")
        .agg(F.min("cost_txn").alias("cost_txn"))
        .select(*STORE_PRODUCT, "cost_txn")
        .distinct()
    )


def in_shop_group(df: DataFrame, shop_group: DataFrame, group_id: str, shop: str) -> DataFrame:
    """Rows whose shop belongs to the group."""
    members = shop_group.filter(F.col("group_id") == group_id).select(F.col("shop_id").alias(shop))
    return df.join(members, shop, "left_semi")


def deals_in_window(deals: DataFrame, start: str, end: str, mode: str = "literal") -> DataFrame:
    """Deals by validity.

    ``literal``: starts at or after the window's start and ends at or after its
    end. ``overlap``: shares at least an instant with the window.
    """
    lower, upper = dates.utc_bound(start, "00:00:00"), dates.utc_bound(end, "23:59:59")
    begins = F.col("event_start") >= lower if mode == "literal" else F.col("event_start") <= upper
    ends = F.col("event_end") >= upper if mode == "literal" else F.col("event_end") >= lower
    return deals.filter(begins & ends)


def _edges(relationships: DataFrame, parent: str, child: str) -> DataFrame:
    typed = (F.col("parent_type") == parent) & (F.col("child_type") == child)
    return relationships.filter(typed).select(
        F.col("parent_id").alias(f"{parent}_id"), F.col("child_id").alias(f"{child}_id")
    )


def _stocked_products(
    relationships: DataFrame, shops: DataFrame, products: DataFrame, shop_group: DataFrame, group_id: str
) -> DataFrame:
    """Products the group's shops list and that have a unit cost, with the shop's title."""
    listed = _edges(relationships, "shop", "product")
    titles = shops.select(F.col("id").alias("shop_id"), F.col("title").alias("store"))
    titles = in_shop_group(titles, shop_group, group_id, "shop_id")
    costed = products.filter(F.col("unit_price_cost") > 0).select(
        F.col("id").alias("product_id"), F.col("title").alias("product"), "unit_price_cost"
    )
    return place(listed.join(titles, "shop_id"), ["product_id"], _SMALL).join(costed, "product_id")


def _stocked_of_base(
    relationships: DataFrame, shops: DataFrame, products: DataFrame, shop_group: DataFrame, group_id: str
) -> DataFrame:
    """What each store has of a base product: distinct titles and unit costs, placed by base product."""
    listed = _stocked_products(relationships, shops, products, shop_group, group_id)
    of_base = listed.join(_edges(relationships, "baseproduct", "product"), "product_id")
    return place(of_base.select("baseproduct_id", *STORE_PRODUCT, "unit_price_cost"), ["baseproduct_id"], _SMALL).distinct()


def deal_cost(
    deals: DataFrame,
    relationships: DataFrame,
    shops: DataFrame,
    products: DataFrame,
    shop_group: DataFrame,
    group_id: str,
) -> DataFrame:
    """Every distinct cost a shop's product has through a supplier deal.

    Deal -> base product -> product -> shop. Only distinct costs count, so both
    sides are made distinct before they meet: deals as prices of a base product,
    products as titles and unit costs that a store has of a base product. A deal
    without a price leaves the product's own unit cost.
    """
    per_base = (
        deals.select(F.col("id").alias("deal_id"), "price")
        .join(_edges(relationships, "deal", "baseproduct"), "deal_id")
        .select("baseproduct_id", "price")
        .distinct()
    )
    of_base = _stocked_of_base(relationships, shops, products, shop_group, group_id)
    return (
        of_base.join(per_base, "baseproduct_id")
        .select(
            *STORE_PRODUCT,
            F.coalesce(F.col("price").cast("double"), F.col("unit_price_cost").cast("double")).alias(
                "cost_deal"
            ),
        )
        .distinct()
    )


def lowest_deal_cost(
    deals: DataFrame,
    relationships: DataFrame,
    shops: DataFrame,
    products: DataFrame,
    shop_group: DataFrame,
    group_id: str,
) -> DataFrame:
    """Lowest positive ``deal_cost`` per store and product.

    The minimum moves below the joins: one row per base product carries the
    lowest positive price and whether some deal has none. The many-to-many
    combination of deals and products is never formed.
    """
    positive = F.col("price").cast("double")
    per_base = (
        deals.select(F.col("id").alias("deal_id"), "price")
        .join(_edges(relationships, "deal", "baseproduct"), "deal_id")
        .groupBy("baseproduct_id")
        .agg(
            F.min(F.when(positive > 0, positive)).alias("lowest"),
            F.bool_or(F.col("price").isNull()).alias("open_price"),
        )
    )
    of_base = _stocked_of_base(relationships, shops, products, shop_group, group_id)
    cost = F.least(F.col("lowest"), F.when(F.col("open_price"), F.col("unit_price_cost").cast("double")))
    return (
        of_base.join(per_base, "baseproduct_id")
        .withColumn("cost_deal", cost)
        .filter(F.col("cost_deal").isNotNull())
        .groupBy(*STORE_PRODUCT)
        .agg(F.min("cost_deal").alias("cost_deal"))
    )


def product_cost(
    products: DataFrame, shops: DataFrame, shop_group: DataFrame, group_id: str
) -> DataFrame:
    """Distinct positive master costs of stocked products of the group's shops."""
    usable = products.filter(
        ~F.col("removed")
        & F.col("is_stocked")
        & (F.col("price_cost") > 0)
        & F.col("title").isNotNull()
    ).select("shop_id", F.col("title").alias("product"), F.col("price_cost").cast("double").alias("cost_product"))
    titles = shops.select(F.col("id").alias("shop_id"), F.col("title").alias("store"))
    return (
        in_shop_group(usable, shop_group, group_id, "shop_id")
        .join(titles, "shop_id", "left")
        .select(*STORE_PRODUCT, "cost_product")
        .distinct()
    )


def lowest_positive(costs: DataFrame, column: str) -> DataFrame:
    return (
        costs.filter((F.col(column) > 0) & present(STORE_PRODUCT))
        .groupBy(*STORE_PRODUCT)
        .agg(F.min(column).alias(column))
    )


def lowest_cost(product: DataFrame, deal: DataFrame, txn: DataFrame) -> DataFrame:
    """Lowest of the three costs for every product the master lists."""
    merged = (
        lowest_positive(product, "cost_product")
        .join(lowest_positive(deal, "cost_deal"), STORE_PRODUCT, "left")
        .join(lowest_positive(txn, "cost_txn"), STORE_PRODUCT, "left")
    )
    return merged.select(
        *STORE_PRODUCT, F.least("cost_deal", "cost_txn", "cost_product").alias("cost_lowest")
    )


def cost_sources_union(product: DataFrame, deal: DataFrame, txn: DataFrame) -> DataFrame:
    """All costs below each other, with their source."""

    def tagged(df: DataFrame, column: str, source: str) -> DataFrame:
        return df.select(*STORE_PRODUCT, F.col(column).alias("cost"), F.lit(source).alias("source"))

    return (
        tagged(product, "cost_product", "product")
        .unionByName(tagged(deal, "cost_deal", "deal"))
        .unionByName(tagged(txn, "cost_txn", "transaction"))
    )


def _row_minimum(columns: Sequence[str]) -> Column:
    doubles = [F.col(c).cast("double") for c in columns]
    return F.least(*doubles) if len(doubles) > 1 else doubles[0]


def feasible_cost(products: DataFrame, costs: DataFrame) -> DataFrame:
    """Smallest value of any column whose name contains "cost"; 0 without one."""
    columns = [c for c in costs.columns if "cost" in c.lower()]
    if not columns:
        return products.withColumn("feasible_cost", F.lit(0.0))
    best = costs.groupBy(*STORE_PRODUCT).agg(F.min(_row_minimum(columns)).alias("feasible_cost"))
    return products.join(best, STORE_PRODUCT, "left").withColumn(
        "feasible_cost", F.coalesce("feasible_cost", F.lit(0.0))
    )
