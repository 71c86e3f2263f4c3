"""Price index against competitors, and its multi-level summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.functions.numeric import half_up, percent_of
from shelfline.operators.skew import large_groups, whole_and_spread
from shelfline.plans.promo import ITEM_KEYS, SKU_KEYS
from shelfline.session import stage_table

SECTION_KEYS = ["store_name", "sub_department", "section"]
LEVEL_ORDER = ["Overall", "Store", "Section", "Store + Section"]


def sku_store_prices(staged: DataFrame) -> DataFrame:
    """Average price per store and SKU."""
    priced = staged.filter((F.col("is_low_quality_record") == 0) & (F.col("realized_unit_price") > 0))
    return priced.groupBy(*SKU_KEYS).agg(
        F.avg("realized_unit_price").alias("avg_realized_price"),
        F.avg(F.col("rrp").cast("double")).alias("avg_rrp"),
        F.sum("quantity").alias("total_units_sold"),
        F.sum("total_sales").alias("total_sales_value"),
        F.count(F.lit(1)).alias("transaction_count"),
    )


def section_prices_by_owner(prices: DataFrame) -> DataFrame:
    """Section averages for the focus supplier and its competitors separately."""
    return prices.groupBy(*SECTION_KEYS, "is_focus").agg(
        F.avg("avg_realized_price").alias("section_avg_price"),
        F.avg("avg_rrp").alias("section_avg_rrp"),
        F.count_distinct("item_code").alias("skus_in_section"),
        F.sum("total_units_sold").alias("section_total_units"),
        F.sum("total_sales_value").alias("section_total_sales"),
    )


def competitor_section_prices(prices: DataFrame) -> DataFrame:
    """The benchmark: competitors' average per store and section."""
    return prices.filter(F.col("is_focus") == 0).groupBy(*SECTION_KEYS).agg(
        F.avg("avg_realized_price").alias("competitor_avg_price_in_section"),
        F.avg("avg_rrp").alias("competitor_avg_rrp_in_section"),
    )


def price_index_of(price: Column, benchmark: Column) -> Column:
    return F.when(benchmark > 0, half_up(price / benchmark * 100))


# Limits and labels of a position.
def price_positioning(index: Column) -> Column:
    return (
        F.when(index.isNull(), "unknown")
        .when(index < 90, "discount")
        .when(index <= 110, "at_market")
        .otherwise("premium")
    )


# Limits and labels of a tier.
def price_tier(index: Column) -> Column:
    return (
        F.when(index.isNull(), "No Competition Data")
        .when(index < 80, "Significant Discount")
        .when(index < 90, "Moderate Discount")
        .when(index <= 110, "Competitive")
        .when(index <= 120, "Moderate Premium")
        .otherwise("Significant Premium")
    )


def price_index(prices: DataFrame) -> DataFrame:
    """Every store SKU against its section's benchmark.

    An aggregate and an equality join rather than a window: the benchmark is
    combined before the shuffle, so a section holding a large share of all SKUs
    never has to pass through one task. The benchmark is written out first; with
    its size known, Spark broadcasts it if it can and leaves the SKUs in place.
    A NULL section finds no benchmark.
    """
    benchmark = stage_table(competitor_section_prices(prices), "section-benchmark")
    index = F.col("price_index_vs_competitors")
    return (
        prices.join(benchmark, SECTION_KEYS, "left")
        .withColumns(
            {
                "price_index_vs_competitors": price_index_of(
                    F.col("avg_realized_price"), F.col("competitor_avg_price_in_section")
                ),
                "rrp_index_vs_competitors": price_index_of(F.col("avg_rrp"), F.col("competitor_avg_rrp_in_section")),
                "own_discount_pct": percent_of(F.col("avg_rrp") - F.col("avg_realized_price"), F.col("avg_rrp")),
            }
        )
        .select(
            *SKU_KEYS,
            "avg_realized_price",
            "avg_rrp",
            "own_discount_pct",
            "competitor_avg_price_in_section",
            "competitor_avg_rrp_in_section",
            "price_index_vs_competitors",
            "rrp_index_vs_competitors",
            price_positioning(index).alias("price_positioning"),
            price_tier(index).alias("price_tier"),
            "total_units_sold",
            "total_sales_value",
            "transaction_count",
        )
    )


def build_price_mart(staged: DataFrame) -> DataFrame:
    """Staging rows to price index; the SKU prices are written once for both uses."""
    return price_index(stage_table(sku_store_prices(staged), "sku-store-prices"))


def price_order(mart: DataFrame) -> DataFrame:
    return mart.orderBy(
        F.col("is_focus").desc_nulls_first(),
        *[F.col(c).asc_nulls_last() for c in [*SECTION_KEYS, "item_code"]],
    )


# ---------------------------------------------------------------- summary

_TOTALS = [
    "index_sum", "index_n", "discount_sum", "discount_n", "discount_count", "at_market_count", "premium_count",
]


# Labels of the levels.
def _level(name: str) -> Column:
    """Keys of one summary level; the columns a level leaves out are NULL."""
    kept = {
        "Overall": [], "Store": ["store_name"], "Section": ["sub_department", "section"], "Store + Section": SECTION_KEYS,
    }[name]
    keys = [(F.col(k) if k in kept else F.lit(None).cast("string")).alias(k) for k in SECTION_KEYS]
    return F.struct(F.lit(name).alias("view_level"), *keys)


def _per_item(measured: DataFrame, levels: list[str]) -> DataFrame:
    """Totals per level member and item."""
    located = measured.withColumn("at", F.explode(F.array(*[_level(name) for name in levels]))).drop(*SECTION_KEYS)

    def positioned(label: str) -> Column:
        return F.count(F.when(F.col("price_positioning") == label, 1))

    return located.groupBy("at", *ITEM_KEYS).agg(
        F.sum("price_index_vs_competitors").alias("index_sum"),
        F.count("price_index_vs_competitors").alias("index_n"),
        F.sum("own_discount_pct").alias("discount_sum"),
        F.count("own_discount_pct").alias("discount_n"),
        positioned("discount").alias("discount_count"),
        positioned("at_market").alias("at_market_count"),
        positioned("premium").alias("premium_count"),
    )


def positioning_by_level(mart: DataFrame, levels: list[str]) -> DataFrame:
    """Measures per level member in two aggregations.

    The first has one row per level member and item, so that distinct SKUs
    become plain counts in the second. Rows are dealt out by item once and expanded, once per
    level, where they lie; those of items with more rows than a task should take are expanded
    and combined before the shuffle. The level's name is part of the key: a member whose store is really
    NULL stays apart from the rolled-up NULL of a coarser level. ``mart`` should be a table.
    """
    measured = mart.select(*SECTION_KEYS, *ITEM_KEYS, "price_index_vs_competitors", "own_discount_pct", "price_positioning")
    whole, spread = whole_and_spread(measured, ITEM_KEYS, large_groups(mart, ITEM_KEYS))
    per_item = _per_item(whole, levels)
    if spread is not None:
        per_item = per_item.unionByName(_per_item(spread, levels))
    if "Overall" in levels:
        # The overall line exists even when the mart is empty.
        nothing = mart.sparkSession.range(1).select(
            _level_constant("Overall").alias("at"),
            F.lit(None).cast("string").alias("item_code"),
            F.lit(None).cast("int").alias("is_focus"),
            *[F.lit(None).cast(per_item.schema[c].dataType).alias(c) for c in _TOTALS],
        )
        per_item = per_item.unionByName(nothing)

    focus, rival = F.col("is_focus") == 1, F.col("is_focus") == 0

    def mean(side: Column, measure: str) -> Column:
        total = F.sum(F.when(side, F.col(f"{measure}_sum")))
        return half_up(F.try_divide(total, F.sum(F.when(side, F.col(f"{measure}_n")))))

    def focus_total(column: str) -> Column:
        return F.coalesce(F.sum(F.when(focus, F.col(column))), F.lit(0))

    return per_item.groupBy("at").agg(
        F.count(F.when(focus, F.col("item_code"))).alias("focus_sku_count"),
        F.count(F.when(rival, F.col("item_code"))).alias("competitor_sku_count"),
        mean(focus, "index").alias("focus_avg_price_index"),
        mean(rival, "index").alias("competitor_avg_price_index"),
        mean(focus, "discount").alias("focus_avg_discount_pct"),
        mean(rival, "discount").alias("competitor_avg_discount_pct"),
        focus_total("discount_count").alias("focus_discount_count"),
        focus_total("at_market_count").alias("focus_at_market_count"),
        focus_total("premium_count").alias("focus_premium_count"),
    ).select("at.*", *_MEASURES)


_MEASURES = [
    "focus_sku_count", "competitor_sku_count", "focus_avg_price_index", "competitor_avg_price_index",
    "focus_avg_discount_pct", "competitor_avg_discount_pct", "focus_discount_count", "focus_at_market_count",
    "focus_premium_count",
]


def _level_constant(name: str) -> Column:
    return F.struct(
        F.lit(name).alias("view_level"), *[F.lit(None).cast("string").alias(k) for k in SECTION_KEYS]
    )


# Labels of the dominant position.
def dominant_positioning(discount: Column, at_market: Column, premium: Column) -> Column:
    """The position with strictly the most store SKUs."""
    return (
        F.when((premium > at_market) & (premium > discount), "Premium Positioning")
        .when((discount > at_market) & (discount > premium), "Discount Positioning")
        .when((at_market > discount) & (at_market > premium), "Market Rate Positioning")
        .otherwise("Mixed Positioning")
    )


def pricing_summary(mart: DataFrame) -> DataFrame:
    """All four levels with shares and the dominant position.

    Shares divide store-SKU rows by distinct SKUs, so above store level they can
    exceed 100.
    """
    skus = F.col("focus_sku_count")
    counts = [F.col(f"focus_{p}_count") for p in ("discount", "at_market", "premium")]
    return positioning_by_level(mart, LEVEL_ORDER).select(
        "view_level",
        *SECTION_KEYS,
        *_MEASURES,
        percent_of(counts[0], skus).alias("discount_pct"),
        percent_of(counts[1], skus).alias("at_market_pct"),
        percent_of(counts[2], skus).alias("premium_pct"),
        dominant_positioning(*counts).alias("dominant_positioning"),
    )


def level_rank(level: Column) -> Column:
    rank = F.lit(None).cast("int")
    for position, name in enumerate(LEVEL_ORDER, start=1):
        rank = F.when(level == name, position).otherwise(rank)
    return rank


def summary_order(summary: DataFrame) -> DataFrame:
    return summary.orderBy(level_rank(F.col("view_level")), *[F.col(c).asc_nulls_first() for c in SECTION_KEYS])
