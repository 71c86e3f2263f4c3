"""Data-quality scorecard and issue list."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.config import Config
from shelfline.functions.numeric import half_up, percent_of
from shelfline.operators.percentiles import percentile_summary
from shelfline.operators.skew import keyed_join
from shelfline.plans.staging import checks_passed, score_from_checks
from shelfline.session import stage_table

DIMENSION_ORDER = ["Overall Dataset", "Store", "Supplier", "Category"]
_FLAGS = {
    "low_quality_records": "is_low_quality_record",
    "invalid_quantity_count": "has_invalid_quantity",
    "invalid_sales_count": "has_invalid_sales",
    "missing_rrp_count": "has_missing_rrp",
    "missing_barcode_count": "has_missing_barcode",
}


# Limits and labels of the ratings.
def health_rating(score: Column) -> Column:
    return (
        F.when(score >= 90, "Excellent")
        .when(score >= 80, "Good")
        .when(score >= 70, "Fair")
        .when(score >= 60, "Poor")
        .otherwise("Critical")
    )


# Limits and labels of reliability.
def reliability_status(low_pct: Column) -> Column:
    return (
        F.when(low_pct <= 5, "Reliable")
        .when(low_pct <= 15, "Moderate Issues")
        .when(low_pct <= 30, "Significant Issues")
        .otherwise("Unreliable")
    )


def dq_summary(staged: DataFrame) -> DataFrame:
    """Scorecard overall and per store, supplier and category.

    Sales are first reduced to store x supplier x category; only those few rows
    are repeated once per dimension.
    """
    per_combination = staged.groupBy("store_name", "supplier", "category").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum(checks_passed(F.col("record_quality_score"))).alias("passed"),
        *[F.sum(column).alias(name) for name, column in _FLAGS.items()],
    )
    totals = ["total_records", "passed", *_FLAGS]

    def member(dimension: str, value: Column) -> Column:
        return F.struct(F.lit(dimension).alias("dimension"), value.alias("dimension_value"))

    everything = member("Overall Dataset", F.lit("All"))
    members = F.array(
        everything,
        member("Store", F.col("store_name")),
        member("Supplier", F.col("supplier")),
        member("Category", F.col("category")),
    )
    # The overall line exists even when there are no sales.
    nothing = staged.sparkSession.range(1).select(
        everything.alias("of"), *[F.lit(None).cast("bigint").alias(c) for c in totals]
    )
    rows = per_combination.select(F.explode(members).alias("of"), *totals).unionByName(nothing)
    summed = rows.groupBy("of").agg(*[F.sum(c).alias(c) for c in totals])
    records, low = F.coalesce("total_records", F.lit(0)), F.col("low_quality_records")
    score = half_up(score_from_checks(F.col("passed"), records))
    low_pct = percent_of(low, records)
    return summed.select(
        "of.dimension",
        "of.dimension_value",
        records.alias("total_records"),
        (records - low).alias("high_quality_records"),
        "low_quality_records",
        low_pct.alias("low_quality_pct"),
        score.alias("avg_quality_score"),
        health_rating(score).alias("health_rating"),
        reliability_status(low_pct).alias("reliability_status"),
        "invalid_quantity_count",
        "invalid_sales_count",
        "missing_rrp_count",
        "missing_barcode_count",
    )


def dimension_rank(dimension: Column) -> Column:
    rank = F.lit(None).cast("int")
    for position, name in enumerate(DIMENSION_ORDER, start=1):
        rank = F.when(dimension == name, position).otherwise(rank)
    return rank


def dq_order(summary: DataFrame) -> DataFrame:
    return summary.orderBy(dimension_rank(F.col("dimension")), F.col("low_quality_pct").desc_nulls_first())


# ---------------------------------------------------------------- issues

_DUPLICATE_KEYS = ["store_name", "item_code", "sale_date"]


def duplicate_groups(staged: DataFrame) -> DataFrame:
    """Store, item and day with more than one record."""
    return (
        staged.groupBy(*_DUPLICATE_KEYS)
        .agg(F.count(F.lit(1)).alias("duplicate_count"), F.sum("total_sales").alias("total_duplicate_sales"))
        .filter(F.col("duplicate_count") > 1)
    )


def duplicate_records(staged: DataFrame) -> DataFrame:
    """The records of every duplicate group, one row each.

    Rows instead of an array per group: a group may be too large for one task.
    """
    records = staged.select(*_DUPLICATE_KEYS, "sales_record_id")
    return keyed_join(records, duplicate_groups(staged), _DUPLICATE_KEYS)


def outlier_stats(staged: DataFrame, cfg: Config) -> DataFrame:
    """One row, already computed: mean, deviation and 99th percentile of quantity and unit price."""
    usable = (F.col("quantity") > 0) & F.col("realized_unit_price").isNotNull()
    narrow = stage_table(
        staged.filter(usable).select(
            F.col("quantity").cast("double").alias("quantity"), F.col("realized_unit_price").alias("price")
        ),
        "outlier-input",
    )
    stats = percentile_summary(
        narrow,
        keys=[],
        percentiles={"q99_quantity": ("quantity", 0.99), "q99_price": ("price", 0.99)},
        aggregates=[
            F.avg("quantity").alias("avg_quantity"),
            F.stddev_samp("quantity").alias("stddev_quantity"),
            F.avg("price").alias("avg_price"),
            F.stddev_samp("price").alias("stddev_price"),
        ],
    )
    ordered = ["avg_quantity", "stddev_quantity", "q99_quantity", "avg_price", "stddev_price", "q99_price"]
    return stage_table(stats.select(*ordered), "outlier-stats")


# The labels of its severities.
class _Outliers:
    """Conditions and labels over the one-row statistics, read as a scalar subquery."""

    def __init__(self, stats: DataFrame, cfg: Config):
        found = stats.select(F.struct("*").alias("stats")).scalar()
        self.quantity = F.col("quantity").cast("double")
        self.price = F.col("realized_unit_price")
        self.avg_quantity, self.avg_price = found.getField("avg_quantity"), found.getField("avg_price")
        self.quantity_limit = self.avg_quantity + cfg.outlier_sigmas * found.getField("stddev_quantity")
        self.price_limit = self.avg_price + cfg.outlier_sigmas * found.getField("stddev_price")
        self.q99_quantity, self.q99_price = found.getField("q99_quantity"), found.getField("q99_price")

    def is_quantity_issue(self) -> Column:
        return (self.quantity < 0) | (self.quantity > self.quantity_limit)

    def quantity_severity(self) -> Column:
        return (
            F.when(self.quantity < 0, "Negative Quantity")
            .when(self.quantity > self.quantity_limit, "Extremely High Quantity")
            .when(self.quantity > self.q99_quantity, "High Quantity (>99th percentile)")
        )

    def is_price_issue(self) -> Column:
        return (F.col("total_sales") < 0) | (self.price < 1) | (self.price > self.price_limit)

    def price_severity(self) -> Column:
        return (
            F.when(F.col("total_sales") < 0, "Negative Sales Value")
            .when(self.price > self.price_limit, "Extremely High Price")
            .when(self.price > self.q99_price, "High Price (>99th percentile)")
            .when(self.price < 1, "Suspiciously Low Price")
        )


# Labels of missing data.
def missing_label() -> Column:
    no_rrp, no_barcode = F.col("has_missing_rrp") == 1, F.col("has_missing_barcode") == 1
    return (
        F.when(no_rrp & no_barcode, "Missing RRP and Barcode")
        .when(no_rrp, "Missing RRP")
        .when(no_barcode, "Missing Barcode")
    )


def _issue(issue_type: str, severity: Column, deviation: Column) -> Column:
    return F.struct(
        F.lit(issue_type).alias("issue_type"),
        severity.alias("issue_severity"),
        deviation.cast("double").alias("deviation_from_avg"),
    )


_RECORD = [
    "sales_record_id", "store_name", "supplier", "item_code", "product_description", "quantity", "total_sales",
    "sale_date",
]


def _issue_rows(staged: DataFrame, *issues: tuple[Column, Column]) -> DataFrame:
    """One row per record and issue that applies, in a single pass over the sales.

    The filter is redundant, but Spark moves it below the staging projection, so
    that record ids and labels are only computed for the rows it keeps.
    """
    applicable = F.array_compact(F.array(*[F.when(condition, issue) for condition, issue in issues]))
    affected = reduce(lambda a, b: a | b, [condition for condition, _ in issues])
    return staged.filter(affected).select(*_RECORD, F.explode(applicable).alias("issue")).select(*_RECORD, "issue.*")


def _quantity_issue(limits: _Outliers) -> tuple[Column, Column]:
    deviation = half_up(F.try_divide(limits.quantity, limits.avg_quantity))
    return limits.is_quantity_issue(), _issue("Quantity Outlier", limits.quantity_severity(), deviation)


def _price_issue(limits: _Outliers) -> tuple[Column, Column]:
    deviation = half_up(F.try_divide(limits.price, limits.avg_price))
    return limits.is_price_issue(), _issue("Price Outlier", limits.price_severity(), deviation)


def _missing_issue() -> tuple[Column, Column]:
    return missing_label().isNotNull(), _issue("Missing Critical Data", missing_label(), F.lit(None))


def quantity_outliers(staged: DataFrame, stats: DataFrame, cfg: Config) -> DataFrame:
    return _issue_rows(staged, _quantity_issue(_Outliers(stats, cfg)))


def price_outliers(staged: DataFrame, stats: DataFrame, cfg: Config) -> DataFrame:
    return _issue_rows(staged, _price_issue(_Outliers(stats, cfg)))


def missing_fields(staged: DataFrame) -> DataFrame:
    return _issue_rows(staged, _missing_issue())


# Priority by label.
def issue_priority(severity: Column) -> Column:
    return (
        F.when(severity.like("Negative%"), 1)
        .when(severity.like("Extremely%"), 2)
        .when(severity.like("High%"), 3)
        .when(severity.like("Missing RRP and Barcode%"), 2)
        .otherwise(4)
    )


def dq_issues(staged: DataFrame, stats: DataFrame, cfg: Config) -> DataFrame:
    """All issues with priority; a record appears once per issue it has."""
    limits = _Outliers(stats, cfg)
    found = _issue_rows(staged, _quantity_issue(limits), _price_issue(limits), _missing_issue())
    return found.select(
        *_RECORD,
        "issue_type",
        "issue_severity",
        issue_priority(F.col("issue_severity")).alias("priority_rank"),
        "deviation_from_avg",
        F.when(F.upper("supplier").like(cfg.focus_pattern), 1).otherwise(0).alias("affects_focus"),
    )


def issue_order(issues: DataFrame) -> DataFrame:
    return issues.orderBy(
        F.col("priority_rank").asc_nulls_last(),
        F.col("affects_focus").desc_nulls_first(),
        F.col("sale_date").desc_nulls_first(),
    )


def iqr_outliers(staged: DataFrame, group: str, measure: str, cfg: Config, reach: float = 1.5) -> DataFrame:
    """Rows beyond ``reach`` interquartile ranges of their group's quartiles."""
    rows = stage_table(
        staged.select("sales_record_id", group, F.col(measure).cast("double").alias(measure)).filter(
            F.col(measure).isNotNull()
        ),
        "iqr-input",
    )
    quartiles = {"q1": (measure, 0.25), "q3": (measure, 0.75)}
    fences = stage_table(percentile_summary(rows, [group], quartiles, []), "iqr-fences")
    spread = reach * (F.col("q3") - F.col("q1"))
    value = F.col(measure)
    return (
        keyed_join(rows, fences, [group])
        .select(
            "sales_record_id", group, measure, (F.col("q1") - spread).alias("lower_fence"),
            (F.col("q3") + spread).alias("upper_fence"),
        )
        .filter((value < F.col("lower_fence")) | (value > F.col("upper_fence")))
        .withColumn("side", F.when(value < F.col("lower_fence"), "low").otherwise("high"))
    )
