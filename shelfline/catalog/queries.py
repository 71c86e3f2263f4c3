"""One entry per operator, each over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
import uuid
from datetime import datetime, timedelta
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfline.config import Config
from shelfline.functions import numeric, text
from shelfline.operators import check_summary as summary, checks, relational, series
from shelfline.operators.nearest import nearest_site
from shelfline.operators.table_diff import table_diff
from shelfline.plans import pricing, promo, quality, reports, staging
from shelfline.session import configure, scratch_path, stage_table
from shelfline.sources import ingest, sinks
from shelfline.sources.tpch_sales import SALES_TABLES, sales_rows, sales_table, state_of, table

Query = Callable[[SparkSession, str], DataFrame]

# Every tenth supplier is the focus supplier.
CFG = Config(focus_pattern="%7")
RECENCY_LIMIT = datetime(2024, 1, 30, 12)

QUERIES: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    """Measures as doubles with four decimals, which any engine reproduces exactly."""

    def shown(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return numeric.half_up(column, 4).alias(field.name)
        return column

    return df.select(*[shown(f) for f in df.schema])


def query(build: Query) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(build(configure(spark), sf_dir))

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return run


# ---------------------------------------------------------------- shared inputs


def staged_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_sales(sales_table(spark, sf_dir), CFG)


def daily_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_table(promo.daily_sku_sales(staged_sales(spark, sf_dir)), "daily-sku-sales")


def classified(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return promo.classified_parts(staged_sales(spark, sf_dir), CFG)


def promo_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return promo.build_promo_mart(staged_sales(spark, sf_dir), CFG)


def price_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pricing.build_price_mart(staged_sales(spark, sf_dir))


@lru_cache(maxsize=16)
def _written_mart(spark: SparkSession, application: str, sf_dir: str, state: tuple, build: Query) -> DataFrame:
    return stage_table(build(spark, sf_dir), "mart")


def _mart_table(spark: SparkSession, sf_dir: str, build: Query) -> DataFrame:
    return _written_mart(spark, spark.sparkContext.applicationId, sf_dir, state_of(spark, sf_dir, SALES_TABLES), build)


def promo_mart_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The promotions mart as summaries and reports find it: built once per application and content of the sources."""
    return _mart_table(spark, sf_dir, promo_mart)


def price_mart_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price mart, likewise."""
    return _mart_table(spark, sf_dir, price_mart)


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staged_sales(spark, sf_dir)
    return quality.dq_issues(staged, quality.outlier_stats(staged, CFG), CFG)


def untidy_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales as a spreadsheet export might give them: text, line breaks, bad dates and numbers."""
    item = F.col("Item_Code").cast("int")
    return sales_table(spark, sf_dir).select(
        F.replace("Store_Name", F.lit("  "), F.lit("\r\n")).alias(" Store Name"),
        F.col("Item_Code").alias("Item-Code"),
        F.col("Item_Barcode"),
        F.when(item % 19 != 3, F.replace("Description", F.lit(" "), F.lit(" \t "))).alias("Description"),
        F.col("Category"),
        F.col("Department"),
        F.col("Sub_Department").alias("Sub-Department"),
        F.col("Section"),
        F.when(item % 17 == 5, "n/a").otherwise(F.col("Quantity").cast("string")).alias("Quantity"),
        F.col("Total_Sales").cast("string").alias("Total Sales"),
        F.when(item % 23 == 1, "unknown").otherwise(F.col("RRP").cast("string")).alias("RRP "),
        F.col("Supplier"),
        F.when(item % 13 == 4, "not a date").otherwise(F.col("Date_Of_Sale").cast("string")).alias("Date Of Sale"),
    )


# ---------------------------------------------------------------- sources and sinks


@query
def ingest_sales(spark, sf_dir):
    """All sales written as CSV and loaded again with strict types."""
    path = scratch_path(spark, "sales-csv")
    sinks.write_csv(sales_rows(spark, sf_dir), path)
    return ingest.read_sales(spark, path)


@query
def validate_load(spark, sf_dir):
    return ingest.validate_load(sales_table(spark, sf_dir))


@query
def clean_text_columns(spark, sf_dir):
    return ingest.clean_text_columns(untidy_export(spark, sf_dir))


@query
def coerce_and_drop_invalid(spark, sf_dir):
    kept, _ = ingest.coerce_and_drop_invalid(ingest.clean_text_columns(untidy_export(spark, sf_dir)))
    return kept


@query
def reject_counts(spark, sf_dir):
    return ingest.reject_counts(ingest.clean_text_columns(untidy_export(spark, sf_dir)))


@query
def load_profile(spark, sf_dir):
    return ingest.load_profile(sales_table(spark, sf_dir))


@query
def materialize_layer(spark, sf_dir):
    """The promotions mart written to its layer and read back."""
    layers = sinks.Layers(scratch_path(spark, "layers"))
    mart = promo_mart(spark, sf_dir)
    return layers.write(mart, sinks.MARTS, "promo_detection", partition_by=["is_focus"], sort_by=["store_name"])


@query
def json_safe(spark, sf_dir):
    """Discount over tax as a floating-point machine divides it: infinite or NaN without tax."""
    discount, tax = F.col("l_discount"), F.col("l_tax")
    untaxed = F.when(discount == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    ratio = F.when(tax == 0, untaxed).otherwise(F.try_divide(discount, tax))
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", ratio.alias("discount_to_tax")
    )
    return sinks.json_safe(rows)


# ---------------------------------------------------------------- staging


@query
def stg_sales(spark, sf_dir):
    return staged_sales(spark, sf_dir)


@query
def surrogate_keys(spark, sf_dir):
    """The sales key, and a key with NULLs read as empty text."""
    sales = sales_table(spark, sf_dir)
    fields = [F.col(c) for c in ("Item_Code", "Item_Barcode", "RRP")]
    return sales.select(
        "Item_Code",
        text.surrogate_key(*fields).alias("key_with_nulls"),
        text.surrogate_key(*fields, null_as_empty=True).alias("key_with_blanks"),
    )


@query
def discount_depth(spark, sf_dir):
    return staged_sales(spark, sf_dir).select("sales_record_id", "rrp", "realized_unit_price", "discount_depth_pct")


@query
def promo_flag_rows(spark, sf_dir):
    rows = staged_sales(spark, sf_dir).filter(F.col("is_potential_promo") == 1)
    return rows.select("sales_record_id", "item_code", "quantity", "total_sales", "rrp")


@query
def date_parts(spark, sf_dir):
    parts = ["sale_date", "sale_year", "sale_month", "sale_day", "day_of_week", "day_name"]
    return staged_sales(spark, sf_dir).groupBy(*parts).agg(F.count(F.lit(1)).alias("n"))


@query
def quality_flags(spark, sf_dir):
    flags = ["has_invalid_quantity", "has_invalid_sales", "has_missing_rrp", "has_missing_barcode"]
    return staged_sales(spark, sf_dir).select("sales_record_id", *flags)


@query
def quality_score(spark, sf_dir):
    scored = staged_sales(spark, sf_dir).groupBy("record_quality_score")
    return scored.agg(F.count(F.lit(1)).alias("n"))


@query
def low_quality_rows(spark, sf_dir):
    rows = staged_sales(spark, sf_dir).filter(F.col("is_low_quality_record") == 1)
    return rows.select("sales_record_id", "store_name", "quantity", "total_sales", "record_quality_score")


def _outlier_query(spark, sf_dir, column):
    sales = sales_table(spark, sf_dir).select("Item_Code", "Date_Of_Sale", column)
    return staging.outlier_flags(sales, column, CFG.outlier_sigmas).filter(F.col("is_outlier") == 1)


@query
def quantity_outlier_flag(spark, sf_dir):
    return _outlier_query(spark, sf_dir, "Quantity")


@query
def price_outlier_flag(spark, sf_dir):
    return _outlier_query(spark, sf_dir, "Total_Sales")


# ---------------------------------------------------------------- promotions


@query
def promo_base(spark, sf_dir):
    rows = promo.promo_base(staged_sales(spark, sf_dir))
    return rows.select("sales_record_id", "store_name", "item_code", "realized_unit_price", "rrp")


@query
def daily_sku_sales(spark, sf_dir):
    return promo.daily_sku_sales(staged_sales(spark, sf_dir))


@query
def sku_baselines(spark, sf_dir):
    return promo.sku_baselines(daily_table(spark, sf_dir), CFG)


@query
def promo_classification(spark, sf_dir):
    return promo.of_parts(classified(spark, sf_dir))


@query
def store_sku_promo(spark, sf_dir):
    return promo.of_parts(classified(spark, sf_dir), promo.store_sku_promo)


@query
def promo_uplift(spark, sf_dir):
    mart = promo_mart(spark, sf_dir)
    return mart.select("store_name", "item_code", "total_days", "promo_days", "promo_uplift_pct")


@query
def discount_tiers(spark, sf_dir):
    return promo_mart(spark, sf_dir).groupBy("discount_tier").agg(F.count(F.lit(1)).alias("n"))


@query
def promo_detection(spark, sf_dir):
    return promo_mart(spark, sf_dir)


@query
def promo_coverage(spark, sf_dir):
    return promo.promo_coverage(promo_mart_table(spark, sf_dir))


@query
def top_skus_by_uplift(spark, sf_dir):
    return promo.top_skus_by_uplift(promo_mart_table(spark, sf_dir))


@query
def top_skus_by_volume(spark, sf_dir):
    return promo.top_skus_by_volume(promo_mart_table(spark, sf_dir))


@query
def store_promo_performance(spark, sf_dir):
    return promo.store_promo_performance(promo_mart_table(spark, sf_dir))


@query
def category_promo_analysis(spark, sf_dir):
    return promo.category_promo_analysis(promo_mart_table(spark, sf_dir))


@query
def promo_summary(spark, sf_dir):
    return promo.promo_summary(promo_mart_table(spark, sf_dir))


# ---------------------------------------------------------------- prices


@query
def sku_store_prices(spark, sf_dir):
    return pricing.sku_store_prices(staged_sales(spark, sf_dir))


@query
def section_prices_by_owner(spark, sf_dir):
    return pricing.section_prices_by_owner(pricing.sku_store_prices(staged_sales(spark, sf_dir)))


@query
def competitor_section_prices(spark, sf_dir):
    return pricing.competitor_section_prices(pricing.sku_store_prices(staged_sales(spark, sf_dir)))


@query
def price_index(spark, sf_dir):
    return price_mart(spark, sf_dir)


def _label_counts(mart, label):
    return mart.groupBy(label, "is_focus").agg(F.count(F.lit(1)).alias("n"))


@query
def price_positioning(spark, sf_dir):
    return _label_counts(price_mart_table(spark, sf_dir), "price_positioning")


@query
def price_tiers(spark, sf_dir):
    return _label_counts(price_mart_table(spark, sf_dir), "price_tier")


@query
def pricing_overall(spark, sf_dir):
    return pricing.positioning_by_level(price_mart_table(spark, sf_dir), ["Overall"])


@query
def pricing_by_store(spark, sf_dir):
    return pricing.positioning_by_level(price_mart_table(spark, sf_dir), ["Store"])


@query
def pricing_by_section(spark, sf_dir):
    return pricing.positioning_by_level(price_mart_table(spark, sf_dir), ["Section"])


@query
def pricing_by_store_section(spark, sf_dir):
    return pricing.positioning_by_level(price_mart_table(spark, sf_dir), ["Store + Section"])


@query
def pricing_summary(spark, sf_dir):
    return pricing.pricing_summary(price_mart_table(spark, sf_dir))


# ---------------------------------------------------------------- data quality


@query
def dq_summary(spark, sf_dir):
    return quality.dq_summary(staged_sales(spark, sf_dir))


@query
def dq_health_rating(spark, sf_dir):
    ratings = ["dimension", "health_rating", "reliability_status"]
    return quality.dq_summary(staged_sales(spark, sf_dir)).groupBy(*ratings).agg(F.count(F.lit(1)).alias("n"))


@query
def duplicate_groups(spark, sf_dir):
    return quality.duplicate_groups(staged_sales(spark, sf_dir))


@query
def duplicate_records(spark, sf_dir):
    return quality.duplicate_records(staged_sales(spark, sf_dir))


@query
def outlier_stats(spark, sf_dir):
    return quality.outlier_stats(staged_sales(spark, sf_dir), CFG)


@query
def quantity_outliers(spark, sf_dir):
    staged = staged_sales(spark, sf_dir)
    return quality.quantity_outliers(staged, quality.outlier_stats(staged, CFG), CFG)


@query
def price_outliers(spark, sf_dir):
    staged = staged_sales(spark, sf_dir)
    return quality.price_outliers(staged, quality.outlier_stats(staged, CFG), CFG)


@query
def missing_fields(spark, sf_dir):
    return quality.missing_fields(staged_sales(spark, sf_dir))


@query
def dq_issues(spark, sf_dir):
    return issues(spark, sf_dir)


@query
def iqr_outliers(spark, sf_dir):
    return quality.iqr_outliers(staged_sales(spark, sf_dir), "category", "realized_unit_price", CFG)


# ---------------------------------------------------------------- reports


@query
def report_data_quality(spark, sf_dir):
    return reports.report_data_quality(quality.dq_summary(staged_sales(spark, sf_dir)), "Supplier", 98.5)


@query
def report_dq_issues(spark, sf_dir):
    return reports.report_dq_issues(issues(spark, sf_dir), supplier="supplier#0000000", focus_only=True)


@query
def report_promo(spark, sf_dir):
    return reports.report_promo(promo_mart_table(spark, sf_dir), focus_only=True, min_uplift=25.0, store="nation 1")


@query
def report_promo_coverage(spark, sf_dir):
    return reports.report_promo_metric(promo.promo_summary(promo_mart_table(spark, sf_dir)), "promo_coverage")


@query
def report_store_performance(spark, sf_dir):
    return reports.report_promo_metric(promo.promo_summary(promo_mart_table(spark, sf_dir)), "store_performance")


@query
def report_category_analysis(spark, sf_dir):
    return reports.report_promo_metric(promo.promo_summary(promo_mart_table(spark, sf_dir)), "category_analysis")


@query
def report_price_index(spark, sf_dir):
    return reports.report_price_index(
        price_mart_table(spark, sf_dir), focus_only=True, store="nation 2", section="section", positioning="premium"
    )


@query
def report_pricing_summary(spark, sf_dir):
    return reports.report_pricing_summary(pricing.pricing_summary(price_mart_table(spark, sf_dir)), store="nation 1")


def _insight_inputs(spark, sf_dir):
    return (
        quality.dq_summary(staged_sales(spark, sf_dir)),
        promo_mart_table(spark, sf_dir),
        pricing.pricing_summary(price_mart_table(spark, sf_dir)),
    )


@query
def key_insights(spark, sf_dir):
    return reports.key_insights(*_insight_inputs(spark, sf_dir), CFG.focus_pattern)


@query
def run_insights(spark, sf_dir):
    return reports.run_insights(*_insight_inputs(spark, sf_dir))


@query
def dash_sales_overview(spark, sf_dir):
    return reports.sales_overview(staged_sales(spark, sf_dir))


@query
def dash_top_products(spark, sf_dir):
    return reports.top_products(staged_sales(spark, sf_dir))


@query
def dash_daily_trend(spark, sf_dir):
    return reports.daily_trend(staged_sales(spark, sf_dir))


@query
def dash_store_performance(spark, sf_dir):
    return reports.store_comparison(staged_sales(spark, sf_dir), CFG)


@query
def discount_effectiveness(spark, sf_dir):
    return reports.discount_effectiveness(promo_mart_table(spark, sf_dir))


@query
def promo_roi(spark, sf_dir):
    return reports.promo_roi(promo_mart_table(spark, sf_dir))


# ---------------------------------------------------------------- generic operators


@query
def union_relations(spark, sf_dir):
    """Customers and suppliers as business partners."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    return relational.union_relations(
        {"customers": customers, "suppliers": suppliers}, exclude=["NAME"], where="balance >= 0"
    )


@query
def deduplicate(spark, sf_dir):
    """The latest event of every user and type."""
    events = table(spark, sf_dir, "events").drop("props")
    return relational.deduplicate(events, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id")])


@query
def pivot_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    statuses = relational.column_value_list(orders, "o_orderstatus")
    return relational.pivot(
        orders, ["o_orderpriority"], "o_orderstatus", statuses, prefix="status ", as_identifier=True
    )


@query
def unpivot_measures(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        "o_orderpriority",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        (F.col("o_orderstatus") == "O").alias("is_open"),
        "o_custkey",
    )
    return relational.unpivot(
        orders, exclude=["o_orderkey"], remove=["O_CUSTKEY"], field_name="measure", value_name="content"
    )


@query
def column_values(spark, sf_dir):
    return relational.column_values(
        table(spark, sf_dir, "lineitem"), "l_partkey", max_records=25, where="l_returnflag <> 'R'"
    )


@query
def generate_series(spark, sf_dir):
    """Numbers up to the highest order key for which no line item exists."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    highest = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    numbers = series.generate_series(spark, highest)
    return numbers.join(lines, F.col("generated_number") == F.col("l_orderkey"), "left_anti")


def _span(df: DataFrame, column: str) -> tuple[datetime, datetime]:
    ends = df.agg(F.min(column), F.max(column)).first()
    return ends[0], ends[1]


@query
def date_spine(spark, sf_dir):
    """Every week of the order period with its number of orders."""
    orders = table(spark, sf_dir, "orders")
    first, last = _span(orders, "o_orderdate")
    weeks = series.date_spine(spark, "week", first, last + timedelta(days=1))
    days_in = F.datediff("o_orderdate", series.timestamp_literal(first))
    per_week = orders.groupBy(F.floor(days_in / 7).alias("week_number")).agg(F.count(F.lit(1)).alias("orders"))
    number = F.floor(F.datediff("date_week", series.timestamp_literal(first)) / 7)
    numbered = weeks.withColumn("week_number", number)
    return numbered.join(per_week, "week_number", "left").select(
        F.col("date_week").cast("date").alias("date_week"), F.coalesce("orders", F.lit(0)).alias("orders")
    )


@query
def gap_filled_daily(spark, sf_dir):
    """Purchases per hour, quiet hours and the hour of the last event included."""
    events = table(spark, sf_dir, "events")
    first, last = _span(events, "ts")
    purchases = events.filter(F.col("event_type") == "purchase")
    start = first.replace(minute=0, second=0, microsecond=0)
    # The spine ends before its end.
    end = last + timedelta(microseconds=1)
    return series.gap_filled(
        purchases, "ts", "hour", {"purchases": F.count(F.lit(1)), "value": F.sum("value")}, start, end
    )


@query
def star_except(spark, sf_dir):
    return relational.select_except(
        table(spark, sf_dir, "customer"), ["C_ACCTBAL", "c_name"], prefix="the_", suffix="_x", alias="c"
    )


@query
def group_by_first_n(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity")
    return relational.group_by_first(
        lines, 3, F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("quantity")
    )


@query
def blank_to_null_profile(spark, sf_dir):
    columns = ["store_name", "item_code", "item_barcode", "supplier", "quantity", "total_sales", "rrp", "sale_date"]
    return relational.null_profile(staged_sales(spark, sf_dir).select(*columns))


@query
def safe_arithmetic_rollup(spark, sf_dir):
    quantity, rrp, paid = F.col("Quantity"), F.col("RRP"), F.col("Total_Sales")
    return sales_table(spark, sf_dir).groupBy("Category").agg(
        F.sum(numeric.safe_add(quantity, rrp, paid)).alias("added"),
        F.sum(numeric.safe_subtract(paid, rrp, quantity)).alias("subtracted"),
        numeric.safe_divide(F.sum(paid).cast("double"), F.sum(quantity).cast("double")).alias("price_per_unit"),
        F.count(numeric.safe_divide(paid.cast("double"), F.col("Item_Code").cast("double"))).alias("divided"),
    )


@query
def histogram_width_bucket(spark, sf_dir):
    bucket = numeric.bucket_of(F.col("l_extendedprice"), 1000, 60000, 12)
    return table(spark, sf_dir, "lineitem").groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high")
    )


@query
def nearest_site_haversine(spark, sf_dir):
    """For every customer nation the nearest foreign nation it is supplied from.

    Each nation has a made position on a grid. Only pairs that trade are formed,
    by equality joins, and they are counted before the distance is computed.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    pairs = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .filter(F.col("c_nationkey") != F.col("s_nationkey"))
        .groupBy("c_nationkey", "s_nationkey")
        .agg(F.count(F.lit(1)).alias("order_lines"))
    )

    def position(nation: str) -> tuple[Column, Column]:
        return F.col(nation) * 6.5 - 78, (F.col(nation) * 37) % 360 - 180.0

    distance = numeric.haversine(*position("c_nationkey"), *position("s_nationkey"), unit="km")
    placed = pairs.withColumn("distance_km", numeric.half_up(distance, 2))
    nearest = F.min(F.struct("distance_km", "s_nationkey", "order_lines")).alias("nearest")
    return placed.groupBy("c_nationkey").agg(nearest).select(
        "c_nationkey", F.col("nearest.s_nationkey").alias("nearest_nation"), "nearest.distance_km",
        "nearest.order_lines",
    )


@query
def scalar_from_query(spark, sf_dir):
    """Orders above the average price."""
    orders = table(spark, sf_dir, "orders")
    average = orders.agg(F.avg(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("average"))
    missing = relational.scalar_or_default(orders.filter("o_orderkey < 0").select("o_orderstatus"), "none")
    above = orders.filter(F.col("o_totalprice") > relational.scalar_or_default(average, 0.0))
    return above.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.max(missing).alias("status_of_missing_order")
    )


@query
def union_by_pattern(spark, sf_dir):
    """Orders split into one view per status, found again by name."""
    orders = table(spark, sf_dir, "orders")
    # A prefix of this call's own, so that nothing else in the catalog matches.
    own = f"v{uuid.uuid4().hex}"
    views = []
    for status in relational.column_value_list(orders, "o_orderstatus"):
        part = orders.filter(F.col("o_orderstatus") == status).select("o_orderkey", "o_custkey", "o_orderdate")
        views.append(f"{own}_orders_status_{status.lower()}")
        part.createOrReplaceTempView(views[-1])
    union = relational.union_by_pattern(spark, f"{own.upper()}_ORDERS_STATUS_%", exclude="%_P")
    for view in views:
        spark.catalog.dropTempView(view)
    return union.withColumn(relational.SOURCE_COLUMN, F.replace(relational.SOURCE_COLUMN, F.lit(f"{own}_"), F.lit("")))


@query
def column_slugs(spark, sf_dir):
    label = F.concat(F.col("p_size").cast("string"), F.lit(" - "), F.initcap("p_name"), F.lit("!"), F.col("p_brand"))
    slugs = table(spark, sf_dir, "part").select(text.slug_column(label).alias("slug"))
    return slugs.groupBy("slug").agg(F.count(F.lit(1)).alias("n"))


@query
def nearest_site_grid(spark, sf_dir):
    """The nearest supplier of every customer, by made positions; a third of the customers live in one city."""
    def placed(key: str, factor: int) -> tuple[Column, Column]:
        return (F.col(key) * factor % 17001) / 100 - 85, (F.col(key) * (factor + 4) % 36001) / 100 - 180

    in_city = F.col("c_custkey") % 3 == 0
    latitude, longitude = placed("c_custkey", 7919)
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(in_city, -1.3 + F.col("c_custkey") % 40 / 1000).otherwise(latitude).alias("latitude"),
        F.when(in_city, 36.8 + F.col("c_custkey") % 70 / 1000).otherwise(longitude).alias("longitude"),
    )
    latitude, longitude = placed("s_suppkey", 104729)
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", latitude.alias("latitude"), longitude.alias("longitude"))
    found = nearest_site(customers, "c_custkey", suppliers, "s_suppkey")
    return found.select("c_custkey", "s_suppkey", F.col("distance").alias("distance_km"))


# ---------------------------------------------------------------- web


def _url_counts(spark, sf_dir, part: Column, name: str):
    return table(spark, sf_dir, "pages").groupBy(part.alias(name)).agg(F.count(F.lit(1)).alias("n"))


@query
def url_host_counts(spark, sf_dir):
    return _url_counts(spark, sf_dir, text.url_host(F.col("url")), "host")


@query
def url_path_counts(spark, sf_dir):
    return _url_counts(spark, sf_dir, text.url_path(F.col("url")), "path")


@query
def url_param_counts(spark, sf_dir):
    parameters = ["utm_source", "page", "ref"]
    url = F.col("url")
    found = F.explode(
        F.array(*[F.struct(F.lit(p).alias("parameter"), text.url_parameter(url, p).alias("value")) for p in parameters])
    )
    values = table(spark, sf_dir, "pages").select(found.alias("found")).select("found.*")
    return values.groupBy("parameter", "value").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- checks


@query
def check_not_null(spark, sf_dir):
    return checks.not_null(sales_table(spark, sf_dir), "Item_Barcode")


@query
def check_unique(spark, sf_dir):
    return checks.unique(table(spark, sf_dir, "orders"), "o_custkey")


@query
def check_accepted_values(spark, sf_dir):
    return checks.accepted_values(table(spark, sf_dir, "orders"), "o_orderstatus", ["O", "F"])


@query
def check_accepted_range(spark, sf_dir):
    return checks.accepted_range(table(spark, sf_dir, "customer"), "c_acctbal", 0.0, 9000.0)


@query
def check_at_least_one(spark, sf_dir):
    return checks.at_least_one(sales_table(spark, sf_dir), "RRP", ["Store_Name", "Item_Code"])


@query
def check_cardinality_equality(spark, sf_dir):
    return checks.cardinality_equality(
        table(spark, sf_dir, "customer"), "c_nationkey", table(spark, sf_dir, "supplier"), "s_nationkey"
    )


def _events_of(spark, sf_dir, event_type):
    return table(spark, sf_dir, "events").filter(F.col("event_type") == event_type)


@query
def check_equal_rowcount(spark, sf_dir):
    clicks, views = _events_of(spark, sf_dir, "click"), _events_of(spark, sf_dir, "view")
    return checks.equal_rowcount(clicks, views, ["user_id"])


@query
def check_fewer_rows_than(spark, sf_dir):
    purchases, views = _events_of(spark, sf_dir, "purchase"), _events_of(spark, sf_dir, "view")
    return checks.fewer_rows_than(purchases, views, ["user_id"])


@query
def check_equality(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    returned = lines.filter(F.col("l_returnflag") == "R")
    accepted = lines.filter(F.col("l_returnflag") == "A")
    return checks.equality(returned, accepted, ["l_partkey", "l_linenumber"])


@query
def check_expression_is_true(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return checks.expression_is_true(lines, "l_extendedprice < l_quantity * 4000")


@query
def check_mutually_exclusive_ranges(spark, sf_dir):
    """Event ranges per user that overlap the user's next one."""
    seconds = F.round(F.col("value") * 100).cast("bigint") * 36
    ranges = table(spark, sf_dir, "events").select(
        "user_id", F.col("ts").alias("begins"), F.timestamp_add("SECOND", seconds, F.col("ts")).alias("ends")
    )
    return checks.mutually_exclusive_ranges(
        stage_table(ranges, "event-ranges"), "begins", "ends", "user_id"
    )


@query
def check_not_accepted_values(spark, sf_dir):
    return checks.not_accepted_values(table(spark, sf_dir, "part"), "p_type", ["SMALL", "LARGE", "TINY"])


@query
def check_not_constant(spark, sf_dir):
    return checks.not_constant(table(spark, sf_dir, "orders"), "o_orderstatus", ["o_custkey"])


@query
def check_not_empty_string(spark, sf_dir):
    rows = checks.not_empty_string(sales_table(spark, sf_dir), "Item_Barcode")
    return rows.select("Item_Code", "Item_Barcode", "Description", "Supplier", "Date_Of_Sale")


@query
def check_not_null_proportion(spark, sf_dir):
    return checks.not_null_proportion(sales_table(spark, sf_dir), "Item_Barcode", 0.9, group_by=["Supplier"])


@query
def check_recency(spark, sf_dir):
    return checks.recency(table(spark, sf_dir, "events"), "ts", RECENCY_LIMIT, group_by=["user_id"])


@query
def check_relationships_where(spark, sf_dir):
    return checks.relationships_where(
        table(spark, sf_dir, "lineitem"), "l_partkey", table(spark, sf_dir, "part"), "p_partkey",
        child_where="l_returnflag = 'R'", parent_where="p_size > 25",
    )


@query
def check_sequential_values(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return checks.sequential_values(lines, "l_linenumber", 1, group_by=["l_orderkey"])


@query
def check_unique_combination(spark, sf_dir):
    return checks.unique_combination(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_values_equal(spark, sf_dir):
    """Rows whose promotion flag disagrees with their rounded discount."""
    judged = staged_sales(spark, sf_dir).select(
        "sales_record_id", "is_potential_promo",
        numeric.flag(F.col("discount_depth_pct") >= CFG.promo_threshold_pct).alias("rounded_promo"),
        "discount_depth_pct",
    )
    return checks.values_equal(judged, "is_potential_promo", "rounded_promo")


@query
def check_summary(spark, sf_dir):
    """All checks of the sales in one scan, and two that look at other tables, each with its verdict."""
    stores = [f"Section {i}" for i in range(4)]
    wanted = [
        summary.not_null("Store_Name"),
        summary.not_null("Item_Barcode").limits(error_if="< 1"),
        summary.accepted_values("Section", stores).limits(error_if="> 100000000000"),
        summary.not_accepted_values("Category", ["TINY", "HUGE"]),
        summary.accepted_range("Quantity", 0, 50),
        summary.not_empty_string("Item_Barcode"),
        summary.expression_is_true("paid_below_list", "Total_Sales <= RRP * Quantity").limits(warn_if="< 0"),
        summary.at_least_one("RRP"),
        summary.not_constant("Supplier"),
        summary.not_null_proportion("Item_Barcode", 0.97),
        summary.recency("Date_Of_Sale", datetime(2030, 1, 1)).limits(error_if="> 1"),
        summary.unique("Item_Code", "Store_Name", "Date_Of_Sale", "Quantity", "Total_Sales").limits(error_if="> 10"),
        summary.fewer_rows_than(table(spark, sf_dir, "orders").select(F.count(F.lit(1))).scalar()),
    ]
    rows = summary.check_summary(sales_table(spark, sf_dir), wanted)
    orphans = checks.relationships_where(table(spark, sf_dir, "lineitem"), "l_partkey", table(spark, sf_dir, "part"), "p_partkey", parent_where="p_size > 25")
    clicks, views = _events_of(spark, sf_dir, "click"), _events_of(spark, sf_dir, "view")
    uneven = checks.equal_rowcount(clicks, views, ["user_id"])
    others = [
        summary.measured("lines_without_large_part", orphans, measure=F.count_distinct("from_id"), error_if="> 100000000000"),
        summary.measured("clicks_equal_views", uneven, failures=F.sum("diff_count"), measure=F.max("diff_count")),
    ]
    for other in others:
        rows = rows.unionByName(other)
    return rows


@query
def check_table_diff(spark, sf_dir):
    """The sales against a copy with rows left out, rows doubled and prices lost."""
    columns = ["Store_Name", "Item_Code", "Item_Barcode", "Quantity", "RRP", "Date_Of_Sale"]
    ours = sales_table(spark, sf_dir).select(*columns)
    item = F.col("Item_Code").cast("int")
    times = F.when(item % 97 == 0, 0).when(item % 101 == 0, 2).otherwise(1)
    theirs = ours.withColumn("RRP", F.when(item % 89 != 0, F.col("RRP"))).withColumn("copy", F.explode(F.array_repeat(F.lit(1), times))).drop("copy")
    return table_diff(ours, theirs)


@query
def promo_duration_by_category(spark, sf_dir):
    """Promo days of a store's item up to 400 days apart count as one promotion: sales are that sparse here."""
    return promo.durations_by_category(promo.of_parts(classified(spark, sf_dir), lambda part: promo.promo_runs(part, max_gap_days=400)))


@query
def uplift_by_depth_regression(spark, sf_dir):
    return promo.uplift_by_depth(promo_mart_table(spark, sf_dir))


@query
def effectiveness_by_category(spark, sf_dir):
    return promo.effectiveness_by_category(promo_mart_table(spark, sf_dir))


@query
def store_promo_response(spark, sf_dir):
    return promo.store_promo_response(promo_mart_table(spark, sf_dir))


@query
def promo_saturation_by_category(spark, sf_dir):
    return promo.promo_saturation_by_category(promo_mart_table(spark, sf_dir))
