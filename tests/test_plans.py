"""Staging, marts, summaries and reports on hand-computed rows."""

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import first, rows_of, sale, sales_frame
from shelfline import Config, stage_table
from shelfline.operators import slices
from shelfline.plans import pricing, promo, quality, reports, staging
from shelfline.plans.build import build_all
from shelfline.sources.sinks import Layers

DAY = date(2025, 9, 22)


def staged(spark, cfg, *rows):
    return staging.stage_sales(sales_frame(spark, list(rows)), cfg)


# ---------------------------------------------------------------- staging


def test_clean_row(spark, cfg):
    row = first(staged(spark, cfg, sale(Supplier=" Acme  Foods ")))
    assert row["store_name"] == "north mall" and row["supplier"] == "ACME FOODS" and row["section"] == "TEA"
    assert (row["is_focus"], row["realized_unit_price"], row["discount_depth_pct"]) == (1, 10.0, 0.0)
    assert (row["day_of_week"], row["day_name"], row["sale_month"]) == (1, "Monday", 9)
    assert (row["record_quality_score"], row["is_low_quality_record"]) == (100.0, 0)


def test_sunday_is_zero(spark, cfg):
    assert first(staged(spark, cfg, sale(Date_Of_Sale=date(2025, 9, 28))))["day_of_week"] == 0


@pytest.mark.parametrize(
    "changes,price,depth,flagged",
    [
        ({"Total_Sales": "18.00"}, 9.0, 10.0, 1),
        ({"Total_Sales": "18.02"}, 9.01, 9.9, 0),
        ({"Quantity": 0}, None, 0.0, 0),
        ({"Quantity": None}, None, 0.0, 0),
        ({"Quantity": -2}, None, 200.0, 1),
        ({"RRP": None}, 10.0, 0.0, 0),
        ({"RRP": 0}, 10.0, 0.0, 0),
        ({"Total_Sales": None}, None, 0.0, 0),
    ],
)
def test_price_discount_and_promo_flag(spark, cfg, changes, price, depth, flagged):
    row = first(staged(spark, cfg, sale(**changes)))
    assert (row["realized_unit_price"], row["discount_depth_pct"], row["is_potential_promo"]) == (price, depth, flagged)


def test_quality_flags_and_score(spark, cfg):
    row = first(staged(spark, cfg, sale(Item_Barcode="  ", RRP=0, Quantity=0)))
    # A blank barcode is flagged but counts as present in the score.
    assert row["has_missing_barcode"] == row["has_missing_rrp"] == row["has_invalid_quantity"] == 1
    assert row["record_quality_score"] == pytest.approx(7 / 9 * 100)
    assert row["is_low_quality_record"] == 1
    poor = first(staged(spark, cfg, sale(Item_Barcode=None, RRP=None, Supplier=None)))
    assert (poor["has_invalid_quantity"], poor["is_low_quality_record"]) == (0, 1)


def test_outlier_flags(spark):
    rows = [sale(Quantity=q) for q in [2] * 30 + [500, -1]] + [sale(Quantity=None)]
    found = staging.outlier_flags(sales_frame(spark, rows), "Quantity").filter("is_outlier = 1")
    assert rows_of(found, "Quantity") == [(-1.0,), (500.0,), (None,)]


# ---------------------------------------------------------------- promotions


def on(day, **changes):
    return sale(Date_Of_Sale=DAY + timedelta(days=day), **changes)


@pytest.fixture(scope="module")
def promo_rows(spark, cfg):
    return staged(
        spark, cfg,
        # Store A: two normal days, one promo day (20 % off).
        on(0, Store_Name="A", Quantity=2, Total_Sales=20), on(1, Store_Name="A", Quantity=4, Total_Sales=40),
        on(2, Store_Name="A", Quantity=9, Total_Sales=72),
        # Store B: promo only, two records on the day.
        on(0, Store_Name="B", Quantity=5, Total_Sales=35), on(0, Store_Name="B", Quantity=1, Total_Sales=7),
        # The focus supplier's item, sold once without promo.
        on(0, Store_Name="A", Item_Code="20", Supplier="Acme", Quantity=1, Total_Sales=10),
        # Dropped: low quality, no price, no recommended price.
        on(0, Quantity=-1), on(0, RRP=None),
    )


def test_daily_sales(promo_rows):
    daily = promo.daily_sku_sales(promo_rows)
    assert daily.count() == 5
    row = first(daily.filter("store_name = 'b'"))
    assert (row["daily_quantity"], row["daily_sales"], row["transaction_count"]) == (6.0, 42.0, 2)
    assert (row["avg_realized_price"], row["discount_from_rrp_pct"]) == (7.0, 30.0)


def test_baselines(promo_rows, cfg):
    rows = {r["item_code"]: r for r in promo.sku_baselines(stage_table(promo.daily_sku_sales(promo_rows), "d"), cfg).collect()}
    tea = rows["10"]
    assert (tea["baseline_daily_quantity"], tea["avg_daily_quantity"], tea["baseline_price"]) == (5.0, 5.25, 9.0)
    assert (tea["median_discount"], tea["p25_discount"], tea["p75_discount"]) == (10.0, 0.0, 22.5)
    assert tea["stddev_daily_quantity"] == pytest.approx(2.9860788)
    assert rows["20"]["stddev_daily_quantity"] is None


def test_promo_mart(promo_rows, cfg):
    mart = promo.build_promo_mart(promo_rows, cfg)
    rows = {(r["store_name"], r["item_code"]): r for r in mart.collect()}
    a, b, focus = rows["a", "10"], rows["b", "10"], rows["a", "20"]
    assert (a["promo_days"], a["total_days"], a["promo_coverage_pct"], a["is_on_promo"]) == (1, 3, 33.33, 1)
    # 9 units on the promo day against 3 a day otherwise.
    assert a["promo_uplift_pct"] == 200.0
    assert (a["discount_tier"], a["promo_discount_depth_pct"]) == ("Light Discount (5-10%)", 20.0)
    assert (float(a["promo_units_sold"]), float(a["non_promo_sales_value"])) == (9.0, 60.0)
    # All days on promo: against the item's median of 5 a day.
    assert (b["promo_uplift_pct"], b["discount_tier"]) == (20.0, "Deep Discount (30%+)")
    assert b["avg_non_promo_price"] is None
    # One day only: no deviation, so no z-score.
    assert (focus["promo_uplift_pct"], focus["max_quantity_zscore"], focus["is_focus"]) == (None, 0.0, 1)
    assert [r["is_focus"] for r in promo.promo_order(mart).collect()] == [1, 0, 0]


def test_slices_of_any_size_give_the_same_mart(promo_rows, cfg, monkeypatch):
    marts = []
    for rows in (10**6, 2):
        monkeypatch.setattr(slices, "SLICE_ROWS", rows)
        marts.append(rows_of(promo.build_promo_mart(promo_rows, cfg)))
    assert marts[0] == marts[1]


def test_an_item_without_code_has_no_baseline(spark, cfg):
    mart = promo.build_promo_mart(staged(spark, cfg, sale(Item_Code=None, Total_Sales=10)), cfg)
    row = first(mart)
    assert (row["baseline_price"], row["is_on_promo"], row["promo_uplift_pct"]) == (None, 1, None)


@pytest.mark.parametrize(
    "discount,label",
    [(None, "No RRP Data"), (-3.0, "Minimal Discount (<5%)"), (5.0, "Light Discount (5-10%)"),
     (10 - 1e-13, "Moderate Discount (10-20%)"), (29.99, "Heavy Discount (20-30%)"), (30.0, "Deep Discount (30%+)")],
)
def test_discount_tier(spark, discount, label):
    assert spark.range(1).select(promo.discount_tier(F.lit(discount).cast("double"))).first()[0] == label


@pytest.fixture(scope="module")
def promo_mart(promo_rows, cfg):
    return stage_table(promo.build_promo_mart(promo_rows, cfg), "mart")


def test_promo_summary(promo_mart):
    coverage = first(promo.promo_coverage(promo_mart))
    assert (coverage["stores_with_promo"], coverage["skus_on_promo"], coverage["avg_uplift_pct"]) == (2, 1, 110.0)
    assert (coverage["deep_discount_count"], coverage["total_promo_units"]) == (1, 15.0)
    stores = rows_of(promo.store_promo_performance(promo_mart), "store_name", "focus_skus_on_promo",
                     "competitor_skus_on_promo", "focus_avg_uplift", "competitor_avg_uplift", "competitor_promo_sales")
    assert stores == [("a", 0, 1, None, 200.0, 72.0), ("b", 0, 1, None, 20.0, 42.0)]
    summary = promo.promo_summary(promo_mart)
    assert summary.groupBy("metric_type").count().count() == 3
    category = reports.report_promo_metric(summary, "category_analysis")
    assert rows_of(category) == [("HOT", "TEA", 0.0, 1.0, None, 110.0)]


def test_top_skus(promo_mart):
    assert rows_of(promo.top_skus_by_uplift(promo_mart, 1), "store_name", "rank") == [("a", 1)]
    assert rows_of(promo.top_skus_by_volume(promo_mart), "store_name", "rank") == [("a", 1), ("b", 2)]


# ---------------------------------------------------------------- prices


@pytest.fixture(scope="module")
def price_rows(spark, cfg):
    return staged(
        spark, cfg,
        sale(Item_Code="1", Total_Sales=20), sale(Item_Code="2", Total_Sales=40),
        sale(Item_Code="3", Supplier="Acme", Total_Sales=27, RRP=None),
        sale(Item_Code="4", Supplier="Acme", Section="Alone"),
        sale(Item_Code="5", Section=None), sale(Item_Code="6", Section=None, Supplier="Acme"),
    )


def test_price_index(price_rows):
    rows = {r["item_code"]: r for r in pricing.build_price_mart(price_rows).collect()}
    # The competitors' average in the section is 15.
    assert rows["1"]["price_index_vs_competitors"] == 66.67 and rows["1"]["price_positioning"] == "discount"
    assert rows["2"]["price_index_vs_competitors"] == 133.33 and rows["2"]["price_tier"] == "Significant Premium"
    assert rows["3"]["price_index_vs_competitors"] == 90.0 and rows["3"]["price_positioning"] == "at_market"
    assert rows["3"]["own_discount_pct"] is None and rows["3"]["rrp_index_vs_competitors"] is None
    assert rows["4"]["price_tier"] == "No Competition Data" and rows["4"]["price_positioning"] == "unknown"
    # A missing section finds no benchmark, although one exists under the same missing name.
    assert rows["5"]["competitor_avg_price_in_section"] is rows["6"]["price_index_vs_competitors"] is None


def test_section_prices_by_owner(price_rows):
    found = pricing.section_prices_by_owner(pricing.sku_store_prices(price_rows)).filter("section = 'TEA'")
    assert rows_of(found, "is_focus", "section_avg_price", "skus_in_section") == [(0, 15.0, 2), (1, 13.5, 1)]


def test_pricing_summary(price_rows):
    summary = pricing.pricing_summary(pricing.build_price_mart(price_rows))
    levels = dict(rows_of(summary.groupBy("view_level").count()))
    assert levels == {"Overall": 1, "Store": 1, "Section": 3, "Store + Section": 3}
    overall = first(summary.filter("view_level = 'Overall'"))
    assert (overall["focus_sku_count"], overall["competitor_sku_count"]) == (3, 3)
    assert (overall["focus_avg_price_index"], overall["competitor_avg_price_index"]) == (90.0, 100.0)
    assert (overall["at_market_pct"], overall["dominant_positioning"]) == (33.33, "Market Rate Positioning")
    assert [r["view_level"] for r in pricing.summary_order(summary).collect()][:2] == ["Overall", "Store"]
    filtered = reports.report_pricing_summary(summary, store="elsewhere")
    assert {r["view_level"] for r in filtered.collect()} == {"Overall", "Section"}


def test_pricing_summary_of_nothing(price_rows):
    row = first(pricing.pricing_summary(pricing.build_price_mart(price_rows.filter("false"))))
    assert (row["view_level"], row["focus_sku_count"], row["focus_avg_price_index"]) == ("Overall", 0, None)
    assert (row["discount_pct"], row["dominant_positioning"], row["focus_premium_count"]) == (None, "Mixed Positioning", 0)


# ---------------------------------------------------------------- data quality


def test_dq_summary(spark, cfg):
    rows = staged(spark, cfg, sale(), sale(Quantity=0, Store_Name=None), sale(RRP=None, Supplier="B", Category="X"))
    found = {(r["dimension"], r["dimension_value"]): r for r in quality.dq_summary(rows).collect()}
    assert len(found) == 7
    overall = found["Overall Dataset", "All"]
    assert (overall["total_records"], overall["high_quality_records"], overall["low_quality_pct"]) == (3, 2, 33.33)
    assert (overall["avg_quality_score"], overall["health_rating"]) == (88.89, "Good")
    assert overall["reliability_status"] == "Unreliable"
    assert (found["Store", None]["total_records"], found["Supplier", "B"]["missing_rrp_count"]) == (1, 1)
    ordered = [r["dimension"] for r in quality.dq_order(quality.dq_summary(rows)).collect()]
    assert ordered[0] == "Overall Dataset" and ordered[-1] == "Category"
    best = reports.report_data_quality(quality.dq_summary(rows), "Category", 85.0)
    assert [r["dimension_value"] for r in best.collect()] == ["FOODS", "X"]


def test_dq_summary_of_nothing(spark, cfg):
    row = first(quality.dq_summary(staged(spark, cfg)))
    assert (row["dimension"], row["total_records"], row["low_quality_records"]) == ("Overall Dataset", 0, None)
    assert (row["health_rating"], row["reliability_status"]) == ("Critical", "Unreliable")


def test_duplicates(spark, cfg):
    rows = staged(spark, cfg, sale(), sale(Total_Sales=5), sale(Item_Code="11"), sale(Store_Name=None), sale(Store_Name=None))
    groups = rows_of(quality.duplicate_groups(rows), "store_name", "duplicate_count", "total_duplicate_sales")
    assert groups == [("north mall", 2, 25.0), (None, 2, 40.0)]
    assert quality.duplicate_records(rows).count() == 4


def test_issues(spark, cfg):
    normal = [sale(Item_Code=str(i)) for i in range(40)]
    odd = [
        sale(Item_Code="neg", Quantity=-2, Total_Sales=-9, RRP=None, Supplier="Acme"),
        sale(Item_Code="bulk", Quantity=900, Total_Sales=9000),
        sale(Item_Code="cheap", Quantity=10, Total_Sales=1, Item_Barcode=" ", RRP=None),
        sale(Item_Code="none", Quantity=None, Item_Barcode=None),
    ]
    rows = staged(spark, cfg, *normal, *odd)
    stats = quality.outlier_stats(rows, cfg)
    found = rows_of(quality.dq_issues(rows, stats, cfg), "item_code", "issue_severity", "priority_rank", "affects_focus")
    assert found == sorted(
        [
            ("neg", "Negative Quantity", 1, 1), ("neg", "Negative Sales Value", 1, 1), ("neg", "Missing RRP", 4, 1),
            ("bulk", "Extremely High Quantity", 2, 0), ("cheap", "Suspiciously Low Price", 4, 0),
            ("cheap", "Missing RRP and Barcode", 2, 0), ("none", "Missing Barcode", 4, 0),
        ],
        key=str,
    )
    deviations = dict(rows_of(quality.quantity_outliers(rows, stats, cfg), "item_code", "deviation_from_avg"))
    mean = (40 * 2 + 900 + 10) / 42
    assert deviations == {"neg": round(-2 / mean, 2), "bulk": round(900 / mean, 2)}
    top = reports.report_dq_issues(quality.dq_issues(rows, stats, cfg), supplier="acm", limit=2)
    assert [r["priority_rank"] for r in top.collect()] == [1, 1]


def test_iqr_outliers(spark, cfg):
    rows = staged(spark, cfg, *[sale(Quantity=q, Total_Sales=q) for q in (1, 2, 3, 4, 5, 40)])
    found = quality.iqr_outliers(rows, "category", "quantity", cfg)
    assert rows_of(found, "quantity", "lower_fence", "upper_fence", "side") == [(40.0, -1.5, 8.5, "high")]


# ---------------------------------------------------------------- reports


def test_reports_on_promotions(promo_mart):
    assert reports.report_promo(promo_mart, focus_only=True).count() == 0
    assert [r["store_name"] for r in reports.report_promo(promo_mart).collect()] == ["a", "b"]
    assert rows_of(reports.report_promo(promo_mart, min_uplift=100), "store_name") == [("a",)]
    assert reports.report_promo(promo_mart, store="B", top_n=5).count() == 1
    assert rows_of(reports.discount_effectiveness(promo_mart), "discount_tier", "avg_uplift_pct") == [
        ("Deep Discount (30%+)", 20.0), ("Light Discount (5-10%)", 200.0),
    ]
    assert first(reports.promo_roi(promo_mart))["uplift_per_discount_point"] == 4.4


def test_report_price_index(price_rows):
    mart = pricing.build_price_mart(price_rows)
    found = reports.report_price_index(mart, focus_only=True, store="NORTH", section="te", positioning="at_market")
    assert rows_of(found, "item_code") == [("3",)]


def test_insights_survive_missing_values(spark, cfg, promo_rows, price_rows):
    dq = quality.dq_summary(promo_rows)
    mart = promo.build_promo_mart(promo_rows, cfg)
    summary = pricing.pricing_summary(pricing.build_price_mart(promo_rows.filter("is_focus = 1")))
    lines = {r["category"]: r["insight"] for r in reports.key_insights(dq, mart, summary, cfg.focus_pattern).collect()}
    assert set(lines) == {"Data Quality", "Pricing"}
    assert lines["Data Quality"] == "0.0% of the own rows are flawed (health: Excellent)"
    assert lines["Pricing"].startswith("Own prices stand at n/a of 100")
    topics = [r["topic"] for r in reports.run_insights(dq, mart, summary).collect()]
    assert topics == ["data_quality", "pricing_position"]


def test_dashboard(spark, cfg):
    rows = staged(
        spark, cfg, on(0, Total_Sales=100), on(7, Total_Sales=150), on(9, Store_Name="B", Total_Sales=50, Supplier="Acme"),
        on(9, Store_Name="C", Total_Sales=50),
    )
    overview = first(reports.sales_overview(rows))
    assert (overview["total_sales"], overview["focus_share_pct"]) == (350.0, 14.29)
    trend = {r["sale_date"]: r for r in reports.daily_trend(rows).collect()}
    assert len(trend) == 10
    assert trend[DAY + timedelta(days=7)]["week_over_week_pct"] == 50.0
    assert float(trend[DAY + timedelta(days=3)]["total_sales"]) == 0.0
    assert rows_of(reports.store_comparison(rows, cfg), "store_name", "sales_rank") == [("b", 2), ("c", 2), ("north mall", 1)]
    assert first(reports.top_products(rows, 1))["total_sales"] == 350.0


def test_build_all(spark, cfg, tmp_path):
    sales = sales_frame(spark, [sale(Store_Name=s, Item_Code=i, Supplier=p, Total_Sales=t) for s in "AB"
                                for i, p, t in (("1", "Acme", 15), ("2", "Other", 20), ("3", "Other", 30))])
    built = build_all(sales, cfg, Layers(str(tmp_path)))
    counts = {name: df.count() for name, df in built.items()}
    assert counts["sales"] == counts["promo_detection"] == counts["price_index"] == 6
    assert counts["pricing_summary"] == 1 + 2 + 1 + 2 and counts["data_quality_summary"] == 1 + 2 + 2 + 1
    assert counts["data_quality_issues"] == 0
    again = build_all(sales.limit(3), cfg, Layers(str(tmp_path)))
    assert again["sales"].count() == 3


def days_of(*offsets):
    return [date(2025, 1, 1) + timedelta(days=d) for d in offsets]


def classified_rows(spark, rows):
    """(store, item, day, on promo, quantity, baseline) as classified daily rows."""
    schema = (
        "store_name string, item_code string, product_description string, supplier string, is_focus int, sub_department string, section string,"
        "sale_date date, is_on_promo int, daily_quantity decimal(18,2), baseline_daily_quantity double"
    )
    full = [(store, item, "d", "x", 0, "dept", item[:1] if item else None, day, on, Decimal(quantity), base) for store, item, day, on, quantity, base in rows]
    return spark.createDataFrame(full, schema)


def test_promo_runs(spark):
    d = days_of(0, 1, 2, 5, 9, 20)
    rows = [("s", "A1", d[0], 1, 8, 3.0), ("s", "A1", d[1], 1, 4, 3.0), ("s", "A1", d[2], 0, 2, 3.0), ("s", "A1", d[3], 1, 4, 3.0)]
    rows += [("t", "A1", d[0], 1, 6, 3.0), ("s", None, d[0], 1, 6, None), ("s", None, d[1], 1, 6, None), ("s", "A1", None, 1, 6, 3.0)]
    runs = promo.promo_runs(classified_rows(spark, rows))
    shown = rows_of(runs, "store_name", "item_code", "first_day", "duration_days", "promo_days", "uplift_pct")
    assert shown == sorted([("s", "A1", d[0], 2, 2, 200.0), ("s", "A1", d[3], 1, 1, 100.0), ("t", "A1", d[0], 1, 1, 100.0), ("s", None, d[0], 2, 2, None)], key=str)
    wide = promo.promo_runs(classified_rows(spark, rows), max_gap_days=4)
    assert ("s", "A1", 6, 3) in rows_of(wide, "store_name", "item_code", "duration_days", "promo_days")
    with pytest.raises(ValueError):
        promo.promo_runs(classified_rows(spark, rows), 0)


def test_promo_duration_of_a_hot_item(spark):
    """One item holds nearly all rows: every second week of three years in many stores, beside a few others."""
    rows = [(f"s{store}", "H1", day, int(n % 14 < 7), 10 if n % 14 < 7 else 5, 5.0) for store in range(12) for n, day in enumerate(days_of(*range(1096)))]
    rows += [("s0", "B1", day, 1, 9, 3.0) for day in days_of(0, 10)] + [("s0", "C1", days_of(0)[0], 1, 9, None)]
    found = rows_of(promo.promo_duration_by_category(classified_rows(spark, rows).repartition(4)))
    per_store = 79  # 78 whole fortnights and a last promotion of four days
    assert found == sorted(
        [
            ("dept", "H", "2-7 days", 12 * per_store, round((78 * 7 + 4) / 79, 2), 100.0, 12.0 * (78 * 70 + 40), 1),
            ("dept", "B", "1 day", 2, 1.0, 200.0, 18.0, 1),
            ("dept", "C", "1 day", 1, 1.0, None, 9.0, 0),
        ],
        key=str,
    )


def mart_of(spark, rows):
    """(store, item, focus, section, on promo, tier, uplift, depth, promo days, days, promo units, promo sales, sales) as rows of the mart."""
    schema = (
        "store_name string, item_code string, is_focus int, section string, is_on_promo int, discount_tier string, promo_uplift_pct double,"
        "promo_discount_depth_pct double, promo_days bigint, total_days bigint, promo_units_sold decimal(28,2), promo_sales_value decimal(28,2),"
        "total_sales_value decimal(28,2)"
    )
    full = [(*r[:10], *map(Decimal, r[10:])) for r in rows]
    return spark.createDataFrame(full, schema).withColumn("sub_department", F.lit("dept"))


def test_effectiveness_response_and_saturation(spark):
    mart = mart_of(
        spark,
        [
            ("a", "1", 1, "tea", 1, "Light", 40.0, 8.0, 2, 4, 10, 50, 80), ("a", "2", 0, "tea", 1, "Deep", 40.0, 32.0, 1, 4, 5, 60, 90),
            ("a", "3", 0, "tea", 0, "Light", None, None, 0, 5, 0, 0, 30), ("b", "1", 1, "tea", 0, "Light", None, None, 0, 6, 0, 0, 70),
            ("b", "2", 0, "tea", 1, "Light", -10.0, 8.0, 3, 3, 7, 21, 21), ("c", "4", 0, "oil", 1, "Light", None, 7.0, 1, 1, 1, 2, 2),
        ],
    )
    found = rows_of(promo.effectiveness_by_category(mart), "section", "discount_tier", "promo_skus", "avg_uplift_pct", "uplift_per_discount_point", "is_best")
    assert found == sorted([("tea", "Light", 2, 15.0, 1.88, 0), ("tea", "Deep", 1, 40.0, 1.25, 1), ("oil", "Light", 1, None, None, 0)], key=str)
    found = rows_of(promo.store_promo_response(mart), "store_name", "promo_skus", "responding_pct", "avg_uplift_pct", "promo_sales_pct", "uplift_rank")
    assert found == sorted([("a", 2, 100.0, 40.0, 55.0, 1), ("b", 1, 0.0, -10.0, 23.08, 2), ("c", 1, 0.0, None, 100.0, 3)], key=str)
    columns = ["section", "items", "promoted_items", "saturation_pct", "focus_intensity_pct", "competitor_intensity_pct", "intensity_gap"]
    found = rows_of(promo.promo_saturation_by_category(mart), *columns)
    assert found == sorted([("tea", 3, 2, 66.67, 20.0, 33.33, -13.33), ("oil", 1, 1, 100.0, None, 100.0, None)], key=str)


def test_duration_labels(spark):
    df = spark.createDataFrame([(1,), (2,), (7,), (8,), (14,), (28,), (29,)], "days int").select(promo.duration_label(F.col("days")))
    assert [r[0] for r in df.collect()] == ["1 day", "2-7 days", "2-7 days", "8-14 days", "8-14 days", "15-28 days", "29+ days"]


def test_config_is_validated():
    for bad in ({"promo_threshold": 0}, {"promo_threshold": 1.5}):
        with pytest.raises(ValueError):
            Config(focus_pattern="%X%", **bad)
    assert Config("%X%", promo_threshold=0.07).promo_threshold_pct == 7.0
