"""The bundled star-schema test tables, seen as a retailer's source tables.

One SQL text per view; both Spark and the checking engine read it. The few
functions spelled differently come in through ``dialect``. Two views have a
second text for Spark, with the same rows (``sold_views``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwise.sources import scratch

BASE_TABLES = ("region", "nation", "supplier", "part", "orders", "lineitem", "events", "customer")

SPARK = {
    "plus_seconds": "({ts} + make_dt_interval(0, 0, 0, {n}))",
    "plus_days": "({ts} + make_dt_interval({n}, 0, 0, 0))",
    "text": "string",
    "half": "({x} div 2)",
    "table": "{{{}}}",
}
DUCKDB = {
    "plus_seconds": "({ts} + to_seconds({n}))",
    "plus_days": "({ts} + to_days({n}))",
    "text": "varchar",
    "half": "({x} // 2)",
    "table": "{}",
}

_STORE = """CASE r_name WHEN 'AFRICA' THEN 'Country Store' WHEN 'EUROPE' THEN 'Metro Store'
 WHEN 'ASIA' THEN 'Metro Discount' ELSE r_name END"""
# Some products are sold under two categories of one calculation group.
_CATEGORY = """CASE p_type WHEN 'STANDARD' THEN 'SOFT DRINKS' WHEN 'MEDIUM' THEN 'CHOCOLATES'
 WHEN 'PROMO' THEN 'BISCUITS'
 WHEN 'ECONOMY' THEN CASE WHEN l_orderkey % 5 = 0 THEN 'CONFECTIONERY, CHEWI' ELSE 'CONFECTIONERY' END
 WHEN 'SMALL' THEN 'HEALTH FOODS' ELSE 'SNACKS AND SAVOURIES' END"""
_SPACE = """CASE p_type WHEN 'STANDARD' THEN 'BEVERAGES' WHEN 'MEDIUM' THEN 'EDIBLE'
 WHEN 'PROMO' THEN 'BASIC FOOD PRODUCTS' WHEN 'ECONOMY' THEN 'EDIBLE'
 WHEN 'SMALL' THEN 'BASIC FOOD PRODUCTS' ELSE 'SNACKS AND SAVOURIES' END"""
# Shelf price in whole cents, by whole-number arithmetic only.
_CENTS = """floor(cast(round(p_retailprice * 100) AS bigint)
 * (100 - cast(round(l_discount * 100) AS bigint)) / 10000)"""


def view_sql(dialect: dict[str, str]) -> dict[str, str]:
    """View name -> defining query. A view may use the ones before it."""
    text, half = dialect["text"], dialect["half"]
    t = {name: dialect["table"].format(name) for name in (*BASE_TABLES, "shops")}
    sold_at = dialect["plus_seconds"].format(
        ts="l_shipdate",
        n="cast((l_orderkey * 7919 + l_linenumber * 3571 + l_partkey * 31) % 86400 AS int)",
    )
    deal_end = dialect["plus_days"].format(ts="o_orderdate", n="180")
    base_product = half.format(x="l_partkey")
    return {
        "shops": f"""
            SELECT cast(s_suppkey AS {text}) AS id, {_STORE} AS title, s_nationkey
            FROM {t["supplier"]} JOIN {t["nation"]} ON s_nationkey = n_nationkey
            JOIN {t["region"]} ON n_regionkey = r_regionkey""",
        "transaction_items": f"""
            SELECT s.title AS shop_title,
                   '10 - GROCERY' AS department_title,
                   concat(cast(100 + length({_SPACE}) AS {text}), ' - ', {_SPACE}) AS space_title,
                   concat(cast(300 + length({_CATEGORY}) AS {text}), ' - ', {_CATEGORY}) AS category_title,
                   cast(l_partkey AS {text}) AS product_id,
                   concat(p_type, ' ', p_brand) AS product_title,
                   {sold_at} AS transacted_at,
                   cast(cast({_CENTS} AS double) / 100 AS decimal(12, 2)) AS price_sell,
                   cast(floor({_CENTS} * (28 + cast(round(l_tax * 100) AS bigint) * 2) / 100) / 100.0
                        AS decimal(12, 2)) AS price_margin,
                   l_quantity AS quantity
            FROM {t["lineitem"]} JOIN {t["part"]} ON l_partkey = p_partkey
            JOIN {t["shops"]} s ON s.id = cast(l_suppkey AS {text})""",
        "thread_deal": f"""
            SELECT cast(o_orderkey AS {text}) AS id,
                   CASE WHEN o_orderkey % 10 = 0 THEN NULL
                        WHEN o_orderkey % 11 = 0 THEN cast(0 AS decimal(12, 2))
                        ELSE cast((cast(floor(o_totalprice) AS bigint) % 500 + 300) / 100.0
                                  AS decimal(12, 2)) END AS price,
                   o_orderpriority AS title,
                   1.0 AS minimum_qty,
                   o_orderdate AS event_start,
                   {deal_end} AS event_end
            FROM {t["orders"]}""",
        "relationships": f"""
            SELECT 'deal' AS parent_type, cast(l_orderkey AS {text}) AS parent_id,
                   'baseproduct' AS child_type, cast({base_product} AS {text}) AS child_id
            FROM {t["lineitem"]} WHERE l_linenumber = 1
            UNION
            SELECT 'baseproduct', cast({base_product} AS {text}), 'product',
                   concat(cast(l_partkey AS {text}), '-', cast(l_suppkey AS {text}))
            FROM {t["lineitem"]}
            UNION
            SELECT 'shop', cast(l_suppkey AS {text}), 'product',
                   concat(cast(l_partkey AS {text}), '-', cast(l_suppkey AS {text}))
            FROM {t["lineitem"]}""",
        "thread_product": f"""
            SELECT concat(cast(l_partkey AS {text}), '-', cast(l_suppkey AS {text})) AS id,
                   cast(l_suppkey AS {text}) AS shop_id,
                   concat(p_type, ' ', p_brand) AS title,
                   CASE WHEN p_size = 50 THEN cast(0 AS decimal(12, 4))
                        ELSE cast((p_size * 7 + 250) / 100.0 AS decimal(12, 4)) END AS unit_price_cost,
                   cast((480 + p_size * 6 + l_suppkey % 50) / 100.0 AS decimal(12, 4)) AS price_cost,
                   p_size % 17 = 0 AS removed,
                   l_suppkey % 9 <> 0 AS is_stocked
            FROM (SELECT DISTINCT l_suppkey, l_partkey FROM {t["lineitem"]}) sold
            JOIN {t["part"]} ON l_partkey = p_partkey""",
        "shop_group": f"""
            SELECT CASE WHEN s_nationkey % 3 = 2 THEN 'other' ELSE 'main' END AS group_id, id AS shop_id
            FROM {t["shops"]}""",
        "store_ref": f"""
            SELECT {_STORE} AS store_name, concat('S0', cast(r_regionkey AS {text})) AS store_codes
            FROM {t["region"]}""",
    }


#: The parts that each supplier sold, made distinct once for all views that start from them.
SOLD = "SELECT DISTINCT l_suppkey, l_partkey FROM {lineitem}"


def sold_views() -> dict[str, str]:
    """``relationships`` and ``thread_product`` from a table ``sold`` of the distinct pairs, for Spark.

    Numbers are made distinct before they become text. As text, numbers stay as
    distinct as they were; only a missing one makes a product's id null and has to be
    made distinct again.
    """
    base, product = "cast(l_partkey div 2 AS string)", "concat(cast(l_partkey AS string), '-', cast(l_suppkey AS string))"
    parents = (("baseproduct", base), ("shop", "cast(l_suppkey AS string)"))
    links = [
        f"""
            SELECT {kind} '{parent}' AS parent_type, {key} AS parent_id, 'product' AS child_type, {child} AS child_id
            FROM {{sold}} WHERE {missing} (l_partkey IS NULL OR l_suppkey IS NULL)"""
        for parent, key in parents
        for kind, missing, child in (("", "NOT", product), ("DISTINCT", "", "cast(NULL AS string)"))
    ]
    deals = """
            SELECT 'deal' AS parent_type, cast(l_orderkey AS string) AS parent_id,
                   'baseproduct' AS child_type, cast(base AS string) AS child_id
            FROM (SELECT DISTINCT l_orderkey, l_partkey div 2 AS base FROM {lineitem} WHERE l_linenumber = 1)"""
    products = view_sql(SPARK)["thread_product"].replace(f"({SOLD}) sold", "{sold} sold")
    return {"relationships": "\n            UNION ALL".join([deals, *links]), "thread_product": products}


class Market(dict):
    """Tables by name, read or defined when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._dir, self._views = spark, sf_dir, view_sql(SPARK) | sold_views()

    def __missing__(self, name: str) -> DataFrame:
        if name in self._views:
            sql = self._views[name]
            used = {t: self[t] for t in (*BASE_TABLES, "shops", "sold") if f"{{{t}}}" in sql}
            self[name] = self._spark.sql(sql, **used)
            if name == "shops":  # as a table Spark sees how small it is, and broadcasts it
                self[name] = scratch.stage(self[name], name)
        elif name == "sold":
            self[name] = scratch.stage(self._spark.sql(SOLD, lineitem=self["lineitem"]), "sold")
        else:
            self[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self[name]
