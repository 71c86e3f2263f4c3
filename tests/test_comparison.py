"""Table differences, nearest sites and regression against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from shelfline import stage_table
from shelfline.operators import nearest, regression, table_diff as diff
from shelfline.operators.nearest import nearest_site
from shelfline.operators.table_diff import table_diff


def differences(a, b):
    a, b = Counter(a), Counter(b)
    rows = [("a_minus_b", *r, n) for r, n in (a - b).items()] + [("b_minus_a", *r, n) for r, n in (b - a).items()]
    return sorted(rows, key=str)


def random_rows(rng, n):
    return [(rng.choice([None, 1, 2, 3]), rng.choice([None, "", "a", "b"]), rng.choice([None, 0.5, float(rng.randrange(50))])) for _ in range(n)]


SCHEMA = "k int, s string, v double"


@pytest.mark.parametrize("buckets", [1 << 16, 4])
def test_difference_counts_copies_and_nulls(spark, monkeypatch, buckets):
    monkeypatch.setattr(diff, "BUCKETS", buckets)
    rng = random.Random(buckets)
    ours = random_rows(rng, 400)
    theirs = ours[20:] + random_rows(rng, 30) + [(None, None, None)] * 3 + [(None, "a", 1.0), (1, None, 1.0)]
    a, b = (spark.createDataFrame(rows, SCHEMA).repartition(n) for rows, n in ((ours, 3), (theirs, 2)))
    assert rows_of(table_diff(a, b)) == differences(ours, theirs)
    assert rows_of(table_diff(a, b, ["s"])) == differences([r[1:2] for r in ours], [r[1:2] for r in theirs])
    assert rows_of(table_diff(a, a.limit(0))) == differences(ours, [])


def test_nulls_in_other_places_are_a_difference(spark):
    a, b = (spark.createDataFrame([r], "x int, y int") for r in ((1, None), (None, 1)))
    assert table_diff(a, b).count() == 2


def test_equal_tables_shuffle_no_rows(spark, monkeypatch):
    rows = random_rows(random.Random(1), 500)
    a, b = (stage_table(spark.createDataFrame(r, SCHEMA).repartition(n), "same") for r, n in ((rows, 3), (rows[::-1], 5)))
    found = table_diff(a, b)
    assert found.columns == ["side", "k", "s", "v", "surplus"] and found.isEmpty()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def haversine(one, two):
    (a, b), (c, d) = np.radians(one), np.radians(two)
    half = np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2
    return 2 * 3961 * np.arcsin(np.sqrt(min(1.0, half))) * 1.60934


def check_nearest(spark, points, sites, **options):
    p = spark.createDataFrame(points, "p long, latitude double, longitude double")
    s = spark.createDataFrame(sites, "s long, latitude double, longitude double")
    found = nearest_site(p, "p", s, "s", **options)
    got = {r["p"]: (r["s"], r["distance"]) for r in found.collect()}
    good = [x for x in sites if x[1] is not None and abs(x[1]) <= 90]
    for i, lat, lon in points:
        if lat is None or lon is None:
            assert i not in got
            continue
        best = min((round(haversine((lat, lon), x[1:]), 6), x[0]) for x in good)
        assert got[i][1] == pytest.approx(best[0], abs=2e-6)
        assert haversine((lat, lon), next(x[1:] for x in good if x[0] == got[i][0])) == pytest.approx(best[0], abs=2e-6)


@pytest.mark.parametrize("cell_places", [10_000, 5])
def test_nearest_sites_equal_full_comparison(spark, monkeypatch, cell_places):
    monkeypatch.setattr(nearest, "CELL_PLACES", cell_places)
    rng = random.Random(cell_places)
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(150)]
    points += [(200 + i, -1.3 + rng.random() / 50, 36.8 + rng.random() / 50) for i in range(80)]
    points += [(400, 90.0, 0.0), (401, -90.0, 77.0), (402, 0.0, 180.0), (403, 0.0, -180.0), (404, None, 5.0), (405, 5.0, None), (406, 0.0, 0.0), (406 + 1, 0.0, 0.0)]
    sites = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(60)] + [(90, 0.0, 179.99), (91, 0.0, -179.99), (92, None, 1.0), (93, 100.0, 1.0)]
    sites += [(5000 - i, -1.3, 36.8) for i in range(20)]
    check_nearest(spark, points, sites, first_edge=0.1)


def test_one_site_serves_the_whole_globe_and_none_nobody(spark):
    check_nearest(spark, [(1, 10.0, 20.0), (2, -10.0, -160.0), (3, 10.0, 20.0)], [(7, 10.0, 20.0)], first_edge=0.5)
    none = spark.createDataFrame([], "s long, latitude double, longitude double")
    points = spark.createDataFrame([(1, 1.0, 1.0)], "p long, latitude double, longitude double")
    found = nearest_site(points, "p", none, "s")
    assert found.columns == ["p", "s", "distance"] and found.count() == 0


def test_nearest_site_plans_no_nested_loop(spark):
    points = stage_table(spark.range(500).selectExpr("id as p", "id % 170 - 85.0D as latitude", "id % 350 - 175.0D as longitude"), "points")
    found = nearest_site(points, "p", points.withColumnRenamed("p", "s"), "s")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert found.filter("distance > 0").count() == 0


def test_regression_equals_numpy(spark):
    rng = random.Random(8)
    rows = [(g, x, round(3 * x - 7 + rng.gauss(0, 9), 2)) for g in ("a", "b", None) for x in (round(rng.uniform(-40, 90), 2) for _ in range(70))]
    rows += [("flat", 1.0, 2.0), ("flat", 1.0, 5.0), ("level", 1.0, 4.0), ("level", 2.0, 4.0), ("one", 3.0, 3.0), ("gaps", None, 1.0), ("gaps", 2.0, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(3)
    sums = regression.moments(df, ["g"], "x", "y")
    found = {r["g"]: r for r in regression.solved(sums).collect()}
    assert "gaps" not in found
    for g in ("a", "b", None):
        x, y = (np.array([r[i] for r in rows if r[0] == g]) for i in (1, 2))
        slope, intercept = np.polyfit(x, y, 1)
        assert (found[g]["n"], found[g]["slope"], found[g]["intercept"]) == (70, pytest.approx(slope), pytest.approx(intercept))
        assert found[g]["r2"] == pytest.approx(np.corrcoef(x, y)[0, 1] ** 2)
    assert tuple(found["flat"])[1:] == (2, None, None, None) and tuple(found["one"])[1:] == (1, None, None, None)
    assert tuple(found["level"])[1:] == (2, 0.0, 4.0, 1.0)
    # The moments of the whole are the sums of those of the groups.
    whole = regression.moments(df, [], "x", "y").first()
    assert regression.merged(sums.withColumn("all", F.lit(1)), ["all"]).drop("all").first() == whole
