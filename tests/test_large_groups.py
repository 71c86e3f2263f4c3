"""Groups that one task takes whole, and larger ones, give the same results; rows are moved once."""

import random
import re
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows_of, sale, sales_frame
from shelfline import stage_table
from shelfline.operators import percentiles, skew
from shelfline.operators.percentiles import percentile_summary
from shelfline.plans import pricing, promo, staging
from shelfline.sources.tpch_sales import sales_rows

WANTED = {"a25": ("a", 0.25), "a50": ("a", 0.5), "b99": ("b", 0.99)}


@pytest.fixture(scope="module")
def mixed(spark):
    """A third of all rows under one key, a NULL key, a key without values."""
    rng = random.Random(7)
    rows = [
        ("hot" if i % 3 == 0 else rng.choice(["x", "y", None]), rng.choice([None, 1.0, 2.5, rng.uniform(0, 9)]), rng.gauss(0, 50))
        for i in range(1500)
    ]
    rows.append(("empty", None, None))
    return stage_table(spark.createDataFrame(rows, "k string, a double, b double"), "mixed"), rows


@pytest.mark.parametrize("most", [0, 400, 10**6])
def test_percentiles(mixed, monkeypatch, most):
    df, rows = mixed
    monkeypatch.setattr(skew, "WHOLE_ROWS", most)
    found = {r["k"]: r for r in percentile_summary(df, ["k"], WANTED, [F.count(F.lit(1)).alias("n")]).collect()}
    assert set(found) == {r[0] for r in rows} and sum(r["n"] for r in found.values()) == len(rows)
    for name, (column, fraction) in WANTED.items():
        for key, got in found.items():
            values = [r[1 if column == "a" else 2] for r in rows if r[0] == key and r[1 if column == "a" else 2] is not None]
            assert got[name] == (pytest.approx(np.percentile(values, fraction * 100), abs=1e-9) if values else None)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_percentiles_of_small_groups_move_rows_once(mixed, monkeypatch):
    """Neither a row per measure nor slices are written."""
    df, _ = mixed
    written = []
    monkeypatch.setattr(percentiles, "stage_table", lambda found, name: written.append(name) or stage_table(found, name))
    plan = plan_of(percentile_summary(df, ["k"], WANTED, [F.avg("b").alias("mean")]))
    assert (written, plan.count("Exchange"), plan.count("Generate")) == ([], 1, 0)


@pytest.fixture(scope="module")
def sold(spark, cfg):
    """Half of the sales are of one item; some have no item."""
    rng = random.Random(11)
    rows = []
    for i in range(400):
        item = "hot" if i % 2 else rng.choice(["1", "2", "3", "4", None])
        rows.append(
            sale(
                Item_Code=item, Store_Name=rng.choice(["a", "b", None]), Quantity=rng.randint(1, 9), Total_Sales=rng.randint(5, 60),
                RRP=rng.choice([8, 10, 12]), Date_Of_Sale=date(2025, 1, 1) + timedelta(days=rng.randrange(30)),
            )
        )
    return stage_table(staging.stage_sales(sales_frame(spark, rows), cfg), "sold")


def test_promotions(sold, cfg, monkeypatch):
    """The baselines found where the rows lie are those of the written tables."""
    daily = stage_table(promo.daily_sku_sales(sold), "daily")
    classified = promo.promo_classification(daily, promo.sku_baselines(daily, cfg), cfg)
    runs = rows_of(promo.promo_runs(classified))
    for most, parts in ((10**6, 1), (100, 2), (0, 2)):
        monkeypatch.setattr(skew, "WHOLE_ROWS", most)
        found = promo.classified_parts(sold, cfg)
        assert len(found) == parts
        together = promo.of_parts(found)
        assert together.columns == classified.columns
        shown = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in classified.dtypes]
        assert rows_of(together.select(*shown)) == rows_of(classified.select(*shown))
        assert rows_of(promo.of_parts(found, promo.promo_runs)) == runs


def test_promotions_move_rows_once(sold, cfg):
    """One exchange from the staged sales to the promotions mart, and one to its runs."""
    (part,) = promo.classified_parts(sold, cfg)
    for made in (promo.build_promo_mart(sold, cfg), promo.promo_runs(part)):
        plan = plan_of(made)
        assert (plan.count("Exchange"), plan.count("Join")) == (1, 0)


def test_promotions_are_compiled(spark, sold, cfg):
    """No method of the mart's stages is too long for the Java runtime to compile; longer stages run operator by operator."""
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        (part,) = promo.classified_parts(sold, cfg)
        code = [debug.codegenString(df._jdf.queryExecution().executedPlan()) for df in (part, promo.build_promo_mart(sold, cfg))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(size) for text in code for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert len(sizes) >= 6 and 0 < max(sizes) <= 8000
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_written_tables_are_packed(mixed):
    files = mixed[0].inputFiles()
    assert files and all(".zstd." in file for file in files)


def test_price_levels(sold, monkeypatch):
    mart = stage_table(pricing.build_price_mart(sold), "prices")
    plans, found = [], []
    for most in (10**6, 2, 0):
        monkeypatch.setattr(skew, "WHOLE_ROWS", most)
        summary = pricing.pricing_summary(mart)
        plans.append(plan_of(summary))
        found.append(rows_of(summary))
    assert found[0] == found[1] == found[2] and {r[0] for r in found[0]} == set(pricing.LEVEL_ORDER)
    # One exchange of the mart's rows and one of the totals; rows are expanded after the first.
    assert plans[0].count("Exchange") == 2
    assert plans[0].index("Generate explode") < plans[0].index("Exchange hashpartitioning(item_code")


def test_base_sales_join_the_lines_twice(spark):
    """Without broadcasts the lines pass two exchanges, whatever joins there are."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(sales_rows(spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    above, depth = [], None
    for line in reversed(plan.split("\n")):
        at = next((i for i, c in enumerate(line) if c.isalnum()), 0)
        if depth is None and "FileScan" in line and "l_extendedprice" in line:
            depth = at
        elif depth is not None and at < depth:
            above.append(line)
            depth = at
    assert len([line for line in above if "Exchange hashpartitioning" in line]) == 2
