"""Parameters of the pipeline: environment settings, scopes, rules, thresholds."""

from __future__ import annotations

import os
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    """Names and locations a deployment overrides through the environment."""

    schema: str = "public"
    transaction_table: str = "transaction_items_partitioned"
    relationship_table: str = "relationships"
    deal_table: str = "thread_deal"
    shop_group: str = "00000000-0000-0000-0000-000000000000"
    data_dir: str = "data"
    store_ref: str = "data/Ref_StoreNameCode.csv"

    @classmethod
    def from_env(cls, env=os.environ) -> "Settings":
        data_dir = env.get("DATA_DIR", cls.data_dir)
        return cls(
            schema=env.get("DB_SCHEMA_PUBLIC", cls.schema),
            transaction_table=env.get("TABLE_TRANSACTION_ITEMS", cls.transaction_table),
            relationship_table=env.get("TABLE_RELATIONSHIPS", cls.relationship_table),
            deal_table=env.get("TABLE_THREAD_DEAL", cls.deal_table),
            shop_group=env.get("SHOP_GROUP_UUID", cls.shop_group),
            data_dir=data_dir,
            store_ref=env.get("REF_STORE_CSV", os.path.join(data_dir, "Ref_StoreNameCode.csv")),
        )

    @property
    def tables(self) -> dict[str, str]:
        """Table name of each source."""
        return {
            "transactions": self.transaction_table,
            "deals": self.deal_table,
            "relationships": self.relationship_table,
            "shops": "shops",
            "products": "thread_product",
            "shop_group": "shop_group",
            "store_ref": "store_ref",
        }


# Titles, groups and cut-offs that decide which rows count.

SALES_CATEGORIES = (
    "SOFT DRINKS",
    "SOFT DRINKS, BOTTLED",
    "SOFT DRINKS, CANNED",
    "SOFT DRINKS, MIXERS",
    "SOFT DRINKS & MIXERS",
    "SOFT DRINKS, SINGLE",
    "CONFECTIONERY",
    "CHOCOLATES",
    "CHOCOLATES, COOKING",
    "BISCUITS",
    "WINES RED, BOTTLED",
    "WINES RED - LOCAL",
    "WINES WHITE - LOCAL",
    "WINES ROSE - LOCAL",
    "HEALTH FOODS",
    "HEALTH FOODS ORGANIC",
    "BEER - FULL STRENGTH",
)

COST_CATEGORIES = (
    "SOFT DRINKS",
    "SOFT DRINKS, BOTTLED",
    "SOFT DRINKS, CANNED",
    "SOFT DRINKS, MIXERS",
    "SOFT DRINKS & MIXERS",
    "SOFT DRINKS, SINGLE",
    "CONFECTIONERY",
    "CHOCOLATES",
    "CHOCOLATES, COOKING",
    "BISCUITS",
    "SNACKS AND SAVOURIES",
    "WINES RED, BOTTLED",
    "WINES RED - LOCAL",
    "WINES WHITE - LOCAL",
    "WINES ROSE - LOCAL",
    "BEER - FULL STRENGTH",
)

SPACES = (
    "BASIC FOOD PRODUCTS",
    "BEVERAGES",
    "EDIBLE",
    "BEER - PACKS",
    "WINE - RED",
    "WINE - WHITE",
    "SNACKS AND SAVOURIES",
)

EXCLUDED_GROUPS = ("HEALTH FOODS",)

SAMPLE_STORES = ("Country Store", "Metro Store", "Metro Discount")

TEST_GROUPS = ("CHOCOLATES", "BEVERAGES", "BISCUITS", "CONFECTIONERY")

# store -> (price threshold, quantity threshold); any other store gets -1
PAIR_THRESHOLDS = {
    "Country Store": (-0.3, -0.3),
    "Metro Store": (-0.3, -0.25),
    "Metro Discount": (-0.35, -0.35),
}
DEFAULT_PAIR_THRESHOLD = -1.0


@dataclass(frozen=True)
class GroupRules:
    """How a category becomes a calculation group; the first match wins."""

    by_space: tuple[str, ...] = (
        "SOFT DRINKS",
        "SOFT DRINKS, BOTTLED",
        "SOFT DRINKS, CANNED",
        "SOFT DRINKS, MIXERS",
        "SOFT DRINKS, SINGLE",
        "BEER - FULL STRENGTH",
        "WINES RED - LOCAL",
        "WINES RED, BOTTLED",
        "WINES ROSE - LOCAL",
        "WINES WHITE - LOCAL",
    )
    by_category: tuple[str, ...] = ("BISCUITS", "CHOCOLATES", "SNACKS AND SAVOURIES")
    by_label: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "CONFECTIONERY": ("CONFECTIONERY", "CONFECTIONERY, CHEWI"),
            "HEALTH FOODS": ("HEALTH FOODS", "HEALTH FOODS ORGANIC"),
        }
    )
    default: str = "0"


LOCAL_ZONE = "Australia/Melbourne"
RANGE_OFFSET = "+11:00"
PAGE_SIZE = 10_000
OUTLIER_QTY = 100
PRICE_STEP = 0.1
MAX_VIF = 5.0
ALPHA = 0.05
R2_LOW, R2_MEDIUM = 0.3, 0.8
