"""Standardised, scored sales rows: one projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfline.config import Config
from shelfline.functions.numeric import MONEY, flag, half_up, stable
from shelfline.functions.text import is_focus_supplier, key_text, level_label, store_label, supplier_label, surrogate_key

_KEY_FIELDS = ["Store_Name", "Item_Code", "Date_Of_Sale", "Quantity", "Total_Sales"]
_SCORED_FIELDS = 9


def unit_price(sales: Column, quantity: Column) -> Column:
    """Sales per unit for positive quantities."""
    return F.when(quantity > 0, sales.cast("double") / quantity.cast("double"))


def _any_unit_price(sales: Column, quantity: Column) -> Column:
    """Sales per unit for every non-zero quantity, returns included."""
    return F.try_divide(sales.cast("double"), quantity.cast("double"))


def discount_depth(price: Column, rrp: Column) -> Column:
    """Percentage below the recommended price; 0 when it cannot be told."""
    listed = rrp.cast("double")
    return F.when((rrp > 0) & price.isNotNull(), half_up((listed - price) / listed * 100)).otherwise(F.lit(0.0))


def promo_price_flag(price: Column, rrp: Column, threshold: float) -> Column:
    ceiling = rrp.cast("double") * (1 - threshold)
    return flag((rrp > 0) & (stable(price) <= stable(ceiling)))


def quality_score(name: Column, code: Column, barcode: Column, text: Column, quantity: Column,
                  sales: Column, rrp: Column, supplier: Column, sold_on: Column) -> Column:
    """Share of the nine field checks a row passes, in percent."""
    checks = [
        name.isNotNull(), code.isNotNull(), barcode.isNotNull(), text.isNotNull(), quantity > 0,
        sales >= 0, rrp > 0, supplier.isNotNull(), sold_on.isNotNull(),
    ]
    passed = sum((flag(c) for c in checks), F.lit(0))
    return passed / F.lit(float(_SCORED_FIELDS)) * 100


def checks_passed(score: Column) -> Column:
    """The whole number of checks behind a score, for exact sums."""
    return F.rint(score * _SCORED_FIELDS / 100).cast("bigint")


def score_from_checks(passed: Column, rows: Column) -> Column:
    return F.try_divide(passed.cast("double"), rows * _SCORED_FIELDS) * 100


def _key_part(sales: DataFrame, name: str) -> Column:
    """Numbers of more than two decimals enter the key without trailing zeros, so a table's scale does not change its keys."""
    kind = sales.schema[name].dataType
    return key_text(F.col(name)) if isinstance(kind, T.DecimalType) and kind.scale > MONEY.scale else F.col(name)


def stage_sales(sales: DataFrame, cfg: Config) -> DataFrame:
    """The staging projection."""
    quantity, paid, rrp = F.col("Quantity"), F.col("Total_Sales"), F.col("RRP")
    barcode, sold_on = F.col("Item_Barcode"), F.col("Date_Of_Sale")
    price = _any_unit_price(paid, quantity)

    staged = sales.select(
        surrogate_key(*[_key_part(sales, c) for c in _KEY_FIELDS]).alias("sales_record_id"),
        store_label(F.col("Store_Name")).alias("store_name"),
        F.trim("Item_Code").alias("item_code"),
        F.trim("Item_Barcode").alias("item_barcode"),
        F.trim("Description").alias("product_description"),
        level_label(F.col("Category")).alias("category"),
        level_label(F.col("Department")).alias("department"),
        level_label(F.col("Sub_Department")).alias("sub_department"),
        level_label(F.col("Section")).alias("section"),
        supplier_label(F.col("Supplier")).alias("supplier"),
        is_focus_supplier(F.col("Supplier"), cfg.focus_pattern).alias("is_focus"),
        quantity.alias("quantity"),
        paid.alias("total_sales"),
        rrp.alias("rrp"),
        unit_price(paid, quantity).alias("realized_unit_price"),
        discount_depth(price, rrp).alias("discount_depth_pct"),
        promo_price_flag(price, rrp, cfg.promo_threshold).alias("is_potential_promo"),
        sold_on.alias("sale_date"),
        F.year(sold_on).alias("sale_year"),
        F.month(sold_on).alias("sale_month"),
        F.dayofmonth(sold_on).alias("sale_day"),
        (F.dayofweek(sold_on) - 1).alias("day_of_week"),
        F.date_format(sold_on, "EEEE").alias("day_name"),
        flag(quantity.isNull() | (quantity <= 0)).alias("has_invalid_quantity"),
        flag(paid.isNull() | (paid < 0)).alias("has_invalid_sales"),
        flag(rrp.isNull() | (rrp <= 0)).alias("has_missing_rrp"),
        flag(barcode.isNull() | (F.trim(barcode) == "")).alias("has_missing_barcode"),
        quality_score(
            F.col("Store_Name"), F.col("Item_Code"), barcode, F.col("Description"), quantity, paid, rrp,
            F.col("Supplier"), sold_on,
        ).alias("record_quality_score"),
    )
    unusable = (
        (F.col("has_invalid_quantity") == 1)
        | (F.col("has_invalid_sales") == 1)
        | (F.col("record_quality_score") < cfg.min_quality_score)
    )
    return staged.withColumn("is_low_quality_record", flag(unusable))


def outlier_flags(sales: DataFrame, column: str, sigmas: float = 3.0) -> DataFrame:
    """Adds ``is_outlier``: missing, negative, or far above the mean of the whole table."""
    value = F.col(column).cast("double")
    limit = sales.agg((F.avg(value) + sigmas * F.stddev_samp(value)).alias("limit")).scalar()
    return sales.withColumn("is_outlier", flag(value.isNull() | (value < 0) | (value > limit)))
