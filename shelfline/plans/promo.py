"""Promotion detection and uplift."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.config import Config
from shelfline.functions.numeric import below, flag, half_up, percent_of, stable
from shelfline.operators.ordering import with_rank
from shelfline.operators.percentiles import percentile_columns, percentile_summary
from shelfline.operators.regression import MOMENTS, merged, moments, solved
from shelfline.operators.skew import large_groups, whole_and_spread
from shelfline.session import stage_table

SKU_KEYS = ["store_name", "item_code", "product_description", "supplier", "is_focus", "sub_department", "section"]

# Upper bound of the average discount and label of each tier.
DISCOUNT_TIERS = [
    (5, "Minimal Discount (<5%)"),
    (10, "Light Discount (5-10%)"),
    (20, "Moderate Discount (10-20%)"),
    (30, "Heavy Discount (20-30%)"),
]
DEEPEST_TIER = "Deep Discount (30%+)"
UNKNOWN_TIER = "No RRP Data"


def promo_base(staged: DataFrame) -> DataFrame:
    """Usable rows with a unit price and a recommended price."""
    return staged.filter(
        (F.col("is_low_quality_record") == 0) & F.col("realized_unit_price").isNotNull() & (F.col("rrp") > 0)
    )


def daily_sku_sales(staged: DataFrame) -> DataFrame:
    """Store x SKU x day; plain sums and averages, combined before the shuffle."""
    return _daily(promo_base(staged))


def _daily(usable: DataFrame) -> DataFrame:
    daily = usable.groupBy(*SKU_KEYS, "sale_date").agg(
        F.avg("realized_unit_price").alias("avg_realized_price"),
        F.avg(F.col("rrp").cast("double")).alias("avg_rrp"),
        F.sum("quantity").alias("daily_quantity"),
        F.sum("total_sales").alias("daily_sales"),
        F.count(F.lit(1)).alias("transaction_count"),
    )
    saved = F.col("avg_rrp") - F.col("avg_realized_price")
    return daily.withColumn("discount_from_rrp_pct", percent_of(saved, F.col("avg_rrp")))


ITEM_KEYS = ["item_code", "is_focus"]

# Column and fraction of each baseline.
BASELINES = {
    "baseline_rrp": ("avg_rrp", 0.5),
    "baseline_price": ("avg_realized_price", 0.5),
    "p25_discount": ("discount_from_rrp_pct", 0.25),
    "median_discount": ("discount_from_rrp_pct", 0.5),
    "p75_discount": ("discount_from_rrp_pct", 0.75),
    "baseline_daily_quantity": ("daily_quantity", 0.5),
}


def _spread_of_quantity() -> dict[str, Column]:
    quantity = F.col("daily_quantity").cast("double")
    return {"avg_daily_quantity": F.avg(quantity), "stddev_daily_quantity": F.stddev_samp(quantity)}


def sku_baselines(daily: DataFrame, cfg: Config) -> DataFrame:
    """Typical price, discount and daily quantity per item, across stores and dates.

    Written out, so that the join with the daily rows is planned by its real size.
    """
    aggregates = [column.alias(name) for name, column in _spread_of_quantity().items()]
    return stage_table(percentile_summary(daily, ITEM_KEYS, BASELINES, aggregates), "sku-baselines")


def with_baselines(daily: DataFrame) -> DataFrame:
    """Daily rows with the baselines of their item, for items whose rows fit a task; an item without code has none.

    A window over rows that already lie together by item moves none of them.
    """
    columns, found = percentile_columns(BASELINES)
    of_item = Window.partitionBy(*ITEM_KEYS)
    named = F.col("item_code").isNotNull() & F.col("is_focus").isNotNull()
    inside = {name: F.when(named, c.over(of_item)) for name, c in {**columns, **_spread_of_quantity()}.items()}
    return daily.withColumns(inside).withColumns(found).drop(*columns)


def promo_classification(daily: DataFrame, baselines: DataFrame, cfg: Config) -> DataFrame:
    """Daily rows with their item's baseline, promo flags, uplift and z-score.

    The baseline is one row per item. Spark broadcasts it when its file size is
    under the broadcast limit; beyond that the adaptive skew join splits hot items.
    """
    return _judged(daily.join(baselines, ITEM_KEYS, "left"), daily.columns, cfg)


def _judged(compared: DataFrame, columns: list[str], cfg: Config) -> DataFrame:
    quantity = F.col("daily_quantity").cast("double")
    baseline, spread = F.col("baseline_daily_quantity"), F.col("stddev_daily_quantity")
    discount = F.col("discount_from_rrp_pct")
    # Rounding names its value several times, so it gets a column and not an expression (see ``promo_detection``).
    unrounded = compared.withColumns({
        "uplift": F.when(baseline > 0, (quantity - baseline) / baseline * 100),
        "zscore": F.when(spread > 0, (quantity - F.col("avg_daily_quantity")) / spread).otherwise(F.lit(0.0)),
    })
    return unrounded.select(
        *columns,
        "baseline_rrp",
        "baseline_price",
        "median_discount",
        "p75_discount",
        "baseline_daily_quantity",
        "avg_daily_quantity",
        flag(discount >= cfg.promo_threshold_pct).alias("is_on_promo"),
        flag(stable(discount) > stable(F.col("p75_discount"))).alias("is_strong_promo"),
        half_up(F.col("uplift")).alias("quantity_uplift_pct"),
        half_up(F.col("zscore")).alias("quantity_zscore"),
    )


def store_sku_promo(classified: DataFrame) -> DataFrame:
    """Store x SKU totals, split into promo and other days."""
    promo = F.col("is_on_promo") == 1
    quantity, sales = F.col("daily_quantity"), F.col("daily_sales")
    price, discount = F.col("avg_realized_price"), F.col("discount_from_rrp_pct")
    zero = F.lit(0).cast("decimal(28,2)")

    grouped = classified.groupBy(*SKU_KEYS).agg(
        F.min("sale_date").alias("first_sale_date"),
        F.max("sale_date").alias("last_sale_date"),
        F.sum("is_on_promo").alias("promo_days"),
        F.count(F.lit(1)).alias("total_days"),
        F.max("is_on_promo").alias("is_on_promo"),
        F.avg("avg_rrp").alias("avg_rrp"),
        F.avg(price).alias("avg_realized_price"),
        F.avg("baseline_price").alias("baseline_price"),
        F.avg(discount).alias("avg_discount_from_rrp_pct"),
        F.max(discount).alias("max_discount_from_rrp_pct"),
        F.avg(F.when(promo, price)).alias("avg_promo_price"),
        F.avg(F.when(~promo, price)).alias("avg_non_promo_price"),
        F.avg(F.when(promo, discount)).alias("promo_discount_depth_pct"),
        F.sum(quantity).alias("total_units_sold"),
        F.sum(sales).alias("total_sales_value"),
        F.avg(quantity.cast("double")).alias("avg_daily_units"),
        F.avg("baseline_daily_quantity").alias("baseline_daily_units"),
        F.sum(F.when(promo, quantity).otherwise(zero)).alias("promo_units_sold"),
        F.sum(F.when(~promo, quantity).otherwise(zero)).alias("non_promo_units_sold"),
        F.sum(F.when(promo, sales).otherwise(zero)).alias("promo_sales_value"),
        F.sum(F.when(~promo, sales).otherwise(zero)).alias("non_promo_sales_value"),
        F.avg("quantity_uplift_pct").alias("avg_quantity_uplift_pct"),
        F.avg(F.when(promo, F.col("quantity_uplift_pct"))).alias("promo_quantity_uplift_pct"),
        F.max("quantity_zscore").alias("max_quantity_zscore"),
    )
    coverage = F.try_divide(F.col("promo_days").cast("double"), F.col("total_days").cast("double")) * 100
    return grouped.withColumn("coverage", coverage).withColumn("promo_coverage_pct", half_up(F.col("coverage"))).drop("coverage")


def promo_uplift() -> Column:
    """Promo days against the store's other days, or against the item's baseline if all days are promo; not rounded."""
    promo_rate = F.try_divide(F.col("promo_units_sold").cast("double"), F.col("promo_days"))
    other_days = F.col("total_days") - F.col("promo_days")
    other_rate = F.try_divide(F.col("non_promo_units_sold").cast("double"), other_days)
    baseline = F.col("baseline_daily_units")
    on_promo = F.col("promo_days") > 0
    return F.when(
        (F.col("non_promo_units_sold") > 0) & on_promo & (other_days > 0),
        (promo_rate - other_rate) / other_rate * 100,
    ).when((baseline > 0) & on_promo, (promo_rate - baseline) / baseline * 100)


def discount_tier(discount: Column) -> Column:
    tier = F.when(discount.isNull(), UNKNOWN_TIER)
    for limit, label in DISCOUNT_TIERS:
        tier = tier.when(below(discount, limit), label)
    return tier.otherwise(DEEPEST_TIER)


def promo_detection(classified: DataFrame) -> DataFrame:
    """The promotions mart.

    The Java runtime does not compile a method of more than 8,000 bytes, and Spark makes one of the totals and all that is
    computed from them: what is rounded is a column before, so that its expression stands in that method once.
    """
    totals = store_sku_promo(classified).withColumn("uplift", promo_uplift())
    return totals.select(
        *SKU_KEYS,
        "first_sale_date",
        "last_sale_date",
        "total_days",
        "promo_days",
        "promo_coverage_pct",
        "is_on_promo",
        discount_tier(F.col("avg_discount_from_rrp_pct")).alias("discount_tier"),
        "avg_rrp",
        "baseline_price",
        "avg_realized_price",
        "avg_non_promo_price",
        "avg_promo_price",
        "avg_discount_from_rrp_pct",
        "max_discount_from_rrp_pct",
        "promo_discount_depth_pct",
        "total_units_sold",
        "total_sales_value",
        "avg_daily_units",
        "baseline_daily_units",
        "promo_units_sold",
        "non_promo_units_sold",
        "promo_sales_value",
        "non_promo_sales_value",
        half_up(F.col("uplift")).alias("promo_uplift_pct"),
        "promo_quantity_uplift_pct",
        "max_quantity_zscore",
    )


def promo_order(mart: DataFrame) -> DataFrame:
    """Presentation order of the mart."""
    return mart.orderBy(
        F.col("is_focus").desc_nulls_first(),
        F.col("promo_uplift_pct").desc_nulls_last(),
        F.col("total_sales_value").desc_nulls_first(),
    )


def classified_parts(staged: DataFrame, cfg: Config) -> list[DataFrame]:
    """Staging rows to classified daily rows, in one part or two.

    The usable rows are dealt out by item once, and the daily sums, baselines, classification and whatever follows by item
    are made where they lie. Items of more rows than a task should take are the second part: their sums are combined before
    the shuffle, their baselines found by selection, and their daily rows stay apart. An item is in one part only.
    """
    used = promo_base(staged).select(*SKU_KEYS, "sale_date", "realized_unit_price", "rrp", "quantity", "total_sales")
    whole, spread = whole_and_spread(used, ITEM_KEYS, large_groups(staged, ITEM_KEYS))
    daily = _daily(whole)
    parts = [_judged(with_baselines(daily), daily.columns, cfg)]
    if spread is not None:
        # This daily table feeds the baselines and the classification, so it is written once.
        daily = stage_table(_daily(spread), "daily-sku-sales")
        parts.append(promo_classification(daily, sku_baselines(daily, cfg), cfg))
    return parts


def of_parts(parts: list[DataFrame], step: Callable[[DataFrame], DataFrame] = lambda part: part) -> DataFrame:
    """A step that works by item, done on every part."""
    return reduce(DataFrame.unionByName, map(step, parts))


def build_promo_mart(staged: DataFrame, cfg: Config) -> DataFrame:
    """Staging rows to promotions mart."""
    return of_parts(classified_parts(staged, cfg), promo_detection)


# ---------------------------------------------------------------- summaries


def on_promo(mart: DataFrame) -> DataFrame:
    return mart.filter(F.col("is_on_promo") == 1)


def promo_coverage(mart: DataFrame) -> DataFrame:
    """Promotions per supplier."""

    def tier_count(label: str) -> Column:
        return F.count(F.when(F.col("discount_tier") == label, 1))

    return on_promo(mart).groupBy("supplier", "is_focus").agg(
        F.count_distinct("store_name").alias("stores_with_promo"),
        F.count_distinct("item_code").alias("skus_on_promo"),
        half_up(F.avg("promo_uplift_pct")).alias("avg_uplift_pct"),
        half_up(F.avg("promo_discount_depth_pct")).alias("avg_discount_depth_pct"),
        F.sum("promo_units_sold").alias("total_promo_units"),
        F.sum("promo_sales_value").alias("total_promo_sales"),
        tier_count(DEEPEST_TIER).alias("deep_discount_count"),
        tier_count(DISCOUNT_TIERS[3][1]).alias("heavy_discount_count"),
        tier_count(DISCOUNT_TIERS[2][1]).alias("moderate_discount_count"),
    )


def _top_skus(mart: DataFrame, measure: str, criteria: str, n: int) -> DataFrame:
    """Best ``n`` rows per side; Spark keeps ``n`` per task before the shuffle."""
    ties = [F.col(c).asc_nulls_last() for c in SKU_KEYS if c != "is_focus"]
    by_measure = Window.partitionBy("is_focus").orderBy(F.col(measure).desc_nulls_last(), *ties)
    return (
        on_promo(mart)
        .withColumn("rank", F.row_number().over(by_measure))
        .filter(F.col("rank") <= n)
        .select(
            F.lit(criteria).alias("ranking_criteria"), "supplier", "is_focus", "item_code", "product_description",
            "store_name", "promo_uplift_pct", "promo_discount_depth_pct", "promo_units_sold", "promo_sales_value",
            "rank",
        )
    )


def top_skus_by_uplift(mart: DataFrame, n: int = 10) -> DataFrame:
    return _top_skus(mart.filter(F.col("promo_uplift_pct").isNotNull()), "promo_uplift_pct", "By Promo Uplift", n)


def top_skus_by_volume(mart: DataFrame, n: int = 10) -> DataFrame:
    return _top_skus(mart, "promo_units_sold", "By Promo Volume", n)


def _two_sided(mart: DataFrame, keys: list[str], counts: tuple[str, str]) -> DataFrame:
    """Focus and competitor measures side by side.

    One row per item first: that makes the distinct counts plain counts and
    avoids expanding every row once per distinct column.
    """
    focus, rival = F.col("is_focus") == 1, F.col("is_focus") == 0
    per_item = on_promo(mart).groupBy(*keys, "item_code", "is_focus").agg(
        F.sum("promo_uplift_pct").alias("uplift_sum"),
        F.count("promo_uplift_pct").alias("uplift_n"),
        F.sum("promo_discount_depth_pct").alias("discount_sum"),
        F.count("promo_discount_depth_pct").alias("discount_n"),
        F.sum("promo_sales_value").alias("sales"),
    )

    def mean(side: Column, measure: str) -> Column:
        total = F.sum(F.when(side, F.col(f"{measure}_sum")))
        return half_up(F.try_divide(total, F.sum(F.when(side, F.col(f"{measure}_n")))))

    def sales(side: Column) -> Column:
        return F.sum(F.when(side, F.col("sales")).otherwise(F.lit(0)))

    return per_item.groupBy(*keys).agg(
        F.count(F.when(focus, F.col("item_code"))).alias(counts[0]),
        F.count(F.when(rival, F.col("item_code"))).alias(counts[1]),
        mean(focus, "uplift").alias("focus_avg_uplift"),
        mean(rival, "uplift").alias("competitor_avg_uplift"),
        mean(focus, "discount").alias("focus_avg_discount"),
        mean(rival, "discount").alias("competitor_avg_discount"),
        sales(focus).alias("focus_promo_sales"),
        sales(rival).alias("competitor_promo_sales"),
    )


def store_promo_performance(mart: DataFrame) -> DataFrame:
    return _two_sided(mart, ["store_name"], ("focus_skus_on_promo", "competitor_skus_on_promo"))


def category_promo_analysis(mart: DataFrame) -> DataFrame:
    return _two_sided(mart, ["sub_department", "section"], ("focus_skus", "competitor_skus"))


_SUMMARY_KEYS = {
    "supplier": "string", "is_focus": "int", "store_name": "string", "sub_department": "string", "section": "string",
}


def _metric_rows(df: DataFrame, metric_type: str, values: list[str]) -> DataFrame:
    keys = [
        (F.col(k) if k in df.columns else F.lit(None)).cast(dtype).alias(k) for k, dtype in _SUMMARY_KEYS.items()
    ]
    measures = [F.col(v).cast("double").alias(f"metric_value_{i}") for i, v in enumerate(values, start=1)]
    return df.select(F.lit(metric_type).alias("metric_type"), *keys, *measures)


def promo_summary(mart: DataFrame) -> DataFrame:
    """Supplier, store and category metrics in one long table; ``mart`` is read three times."""
    coverage = _metric_rows(
        promo_coverage(mart), "promo_coverage",
        ["stores_with_promo", "skus_on_promo", "avg_uplift_pct", "avg_discount_depth_pct"],
    )
    stores = _metric_rows(
        store_promo_performance(mart), "store_performance",
        ["focus_skus_on_promo", "competitor_skus_on_promo", "focus_avg_uplift", "competitor_avg_uplift"],
    )
    categories = _metric_rows(
        category_promo_analysis(mart), "category_analysis",
        ["focus_skus", "competitor_skus", "focus_avg_uplift", "competitor_avg_uplift"],
    )
    return coverage.unionByName(stores).unionByName(categories)


# ---------------------------------------------------------------- duration and depth

# Upper bound in days and label of each duration; longer ones are the last.
DURATIONS = [(1, "1 day"), (7, "2-7 days"), (14, "8-14 days"), (28, "15-28 days")]
LONGEST_DURATION = "29+ days"


def promo_runs(classified: DataFrame, max_gap_days: int = 1) -> DataFrame:
    """Promotions as unbroken runs of promo days of a store's item, with their uplift.

    Promo days at most ``max_gap_days`` apart belong to one run. Sales per promo day are set against the
    store's other days, or against the item's baseline where there are none. A window holds the days
    of one item in one store, of which there are no more than days in the data.
    """
    if max_gap_days < 1:
        raise ValueError("max_gap_days must be at least 1")
    quantity, promo = F.col("daily_quantity").cast("double"), F.col("is_on_promo") == 1
    of_item = Window.partitionBy(*SKU_KEYS)
    in_order = of_item.orderBy("sale_date")
    usual = F.coalesce(F.avg(F.when(~promo, quantity)).over(of_item), F.col("baseline_daily_quantity"))
    days = classified.filter(F.col("sale_date").isNotNull()).withColumn("usual_quantity", usual).filter(promo)
    previous = F.lag("sale_date").over(in_order)
    begins = F.when(F.datediff("sale_date", previous) <= max_gap_days, 0).otherwise(1)
    numbered = days.withColumn("begins", begins).withColumn("run", F.sum("begins").over(in_order))
    runs = numbered.groupBy(*SKU_KEYS, "run").agg(
        F.min("sale_date").alias("first_day"),
        F.max("sale_date").alias("last_day"),
        F.count(F.lit(1)).alias("promo_days"),
        F.sum("daily_quantity").alias("units"),
        F.max("usual_quantity").alias("usual_quantity"),
    )
    rate = F.col("units").cast("double") / F.col("promo_days")
    return runs.withColumn("duration_days", F.datediff("last_day", "first_day") + 1).withColumn(
        "uplift_pct", F.when(F.col("usual_quantity") > 0, half_up((rate - F.col("usual_quantity")) / F.col("usual_quantity") * 100))
    )


def duration_label(days: Column) -> Column:
    label = F.when(days <= DURATIONS[0][0], DURATIONS[0][1])
    for most, name in DURATIONS[1:]:
        label = label.when(days <= most, name)
    return label.otherwise(LONGEST_DURATION)


def promo_duration_by_category(classified: DataFrame, max_gap_days: int = 1) -> DataFrame:
    """Runs and their uplift by category and duration; ``is_best`` marks each category's duration of highest average uplift.

    Of durations with the same uplift the shorter one is best; without any uplift none is.
    """
    return durations_by_category(promo_runs(classified, max_gap_days))


def durations_by_category(runs: DataFrame) -> DataFrame:
    """The same, of runs."""
    category = ["sub_department", "section"]
    grouped = runs.groupBy(*category, duration_label(F.col("duration_days")).alias("duration")).agg(
        F.count(F.lit(1)).alias("promotions"),
        half_up(F.avg("duration_days")).alias("avg_days"),
        half_up(F.avg("uplift_pct")).alias("avg_uplift_pct"),
        F.sum("units").alias("units"),
    )
    # At most one row per duration.
    best_first = Window.partitionBy(*category).orderBy(F.col("avg_uplift_pct").desc_nulls_last(), F.col("avg_days"))
    return grouped.withColumn("is_best", flag((F.row_number().over(best_first) == 1) & F.col("avg_uplift_pct").isNotNull()))


def uplift_by_depth(mart: DataFrame) -> DataFrame:
    """How uplift answers to discount depth: a straight line per category, and over all categories.

    One aggregation gives the moments of the categories; those of the whole are their sums.
    """
    category = ["sub_department", "section"]
    sums = stage_table(moments(on_promo(mart), category, "promo_discount_depth_pct", "promo_uplift_pct"), "uplift-moments")
    whole = merged(sums.withColumn("level", F.lit("overall")), ["level"]).select(
        "level", *[F.lit(None).cast("string").alias(c) for c in category], *MOMENTS
    )
    by_category = sums.select(F.lit("category").alias("level"), *category, *MOMENTS)
    return solved(by_category.unionByName(whole))


# ---------------------------------------------------------------- effectiveness, response, saturation


def effectiveness_by_category(mart: DataFrame) -> DataFrame:
    """What each discount tier brings in a category; ``is_best`` marks the tier of highest average uplift.

    Of tiers with the same uplift the one with more sales is best, then the first by name; without any uplift none is.
    """
    category = ["sub_department", "section"]
    grouped = on_promo(mart).groupBy(*category, "discount_tier").agg(
        F.count(F.lit(1)).alias("promo_skus"),
        half_up(F.avg("promo_uplift_pct")).alias("avg_uplift_pct"),
        half_up(F.avg("promo_discount_depth_pct")).alias("avg_discount_pct"),
        F.sum("promo_units_sold").alias("promo_units"),
        F.sum("promo_sales_value").alias("promo_sales"),
    )
    ratio = half_up(F.try_divide(F.col("avg_uplift_pct"), F.col("avg_discount_pct")))
    # At most one row per tier.
    best_first = Window.partitionBy(*category).orderBy(F.col("avg_uplift_pct").desc_nulls_last(), F.col("promo_sales").desc(), "discount_tier")
    best = flag((F.row_number().over(best_first) == 1) & F.col("avg_uplift_pct").isNotNull())
    return grouped.withColumn("uplift_per_discount_point", ratio).withColumn("is_best", best)


def store_promo_response(mart: DataFrame) -> DataFrame:
    """How stores answer to promotions: share of promoted items that sold better, uplift, share of sales, and their rank by uplift."""
    promo = F.col("is_on_promo") == 1
    uplift = F.when(promo, F.col("promo_uplift_pct"))
    grouped = mart.groupBy("store_name").agg(
        F.count_if(promo).alias("promo_skus"),
        F.count_if(uplift > 0).alias("responding_skus"),
        half_up(F.avg(uplift)).alias("avg_uplift_pct"),
        half_up(F.avg(F.when(promo, F.col("promo_discount_depth_pct")))).alias("avg_discount_pct"),
        F.sum("promo_sales_value").alias("promo_sales"),
        F.sum("total_sales_value").alias("total_sales"),
    )
    shares = grouped.select(
        "*",
        percent_of(F.col("responding_skus"), F.col("promo_skus")).alias("responding_pct"),
        percent_of(F.col("promo_sales"), F.col("total_sales")).alias("promo_sales_pct"),
    )
    return with_rank(stage_table(shares, "store-response"), "avg_uplift_pct", "uplift_rank")


def promo_saturation_by_category(mart: DataFrame) -> DataFrame:
    """How much of a category is on promotion, and how intense the focus supplier's promotions are against its rivals'.

    Saturation is the share of items promoted anywhere; intensity the share of a side's days with sales that were promo days.
    Rows are reduced to items before items are counted.
    """
    category, own = ["sub_department", "section"], F.col("is_focus") == 1
    items = mart.groupBy(*category, "item_code", "is_focus").agg(
        F.max("is_on_promo").alias("promoted"),
        F.sum("promo_days").alias("promo_days"),
        F.sum("total_days").alias("total_days"),
        F.sum("promo_sales_value").alias("promo_sales"),
        F.sum("total_sales_value").alias("total_sales"),
    )

    def intensity(side: Column) -> Column:
        return percent_of(F.sum(F.when(side, F.col("promo_days"))), F.sum(F.when(side, F.col("total_days"))))

    found = items.groupBy(*category).agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("promoted").alias("promoted_items"),
        percent_of(F.sum("promoted"), F.count(F.lit(1))).alias("saturation_pct"),
        percent_of(F.sum("promo_sales"), F.sum("total_sales")).alias("promo_sales_pct"),
        intensity(own).alias("focus_intensity_pct"),
        intensity(~own).alias("competitor_intensity_pct"),
    )
    return found.withColumn("intensity_gap", half_up(F.col("focus_intensity_pct") - F.col("competitor_intensity_pct")))
