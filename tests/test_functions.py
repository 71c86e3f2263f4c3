"""Column functions against known values."""

import math
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from shelfline.functions import numeric, text

# Keys of three columns, one column, with NULLs: fixed values any implementation must give.
KEYS = [
    (("a", "b", "c"), "0cc175b9c0f1b6a831c399e269772661", "7b193b3d33184464106f41ddf733783b"),
    (("a", None, "c"), "0cc175b9c0f1b6a831c399e269772661", "4f32a73dc87b7bbb7a654d8898d58c7e"),
    ((None, None, "c"), "f14cc5cdce0420f4a5a6b6d9d7b85f39", "d9c538b129f1a3ad6ecfe55345c32a05"),
    ((None, None, None), "f14cc5cdce0420f4a5a6b6d9d7b85f39", "2fa5491950d66d153d23cfbcfea4e164"),
]


def column_of(spark, values, dtype, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("x"))).collect()]


@pytest.mark.parametrize("values,single,three", KEYS)
def test_surrogate_key(spark, values, single, three):
    df = spark.createDataFrame([values], "a string, b string, c string")
    row = df.select(
        text.surrogate_key(F.col("a")).alias("one"), text.surrogate_key(*map(F.col, "abc")).alias("all")
    ).first()
    assert (row["one"], row["all"]) == (single, three)


def test_surrogate_key_blank_option_differs_from_null(spark):
    df = spark.createDataFrame([(None, ""), ("", None)], "a string, b string")
    strict = {r[0] for r in df.select(text.surrogate_key(F.col("a"), F.col("b"))).collect()}
    blank = {r[0] for r in df.select(text.surrogate_key(F.col("a"), F.col("b"), null_as_empty=True)).collect()}
    assert (len(strict), len(blank)) == (2, 1)


def test_half_up_agrees_with_decimal_rounding(spark):
    values = [0.0, -0.0, 0.005, -0.005, 1.005, 2.675, -2.675, 10.125, 1234567.895, -99.994999, 33.333333, 1e-12,
              -1e-12, 15.555, 300.0, 123456789.125]
    found = column_of(spark, values, "double", numeric.half_up)
    for value, got in zip(values, found):
        stable = Decimal(repr(value)).quantize(Decimal("1e-8"), ROUND_HALF_UP)
        assert got == float(stable.quantize(Decimal("0.01"), ROUND_HALF_UP)), value
        assert math.copysign(1, got) > 0 or got != 0
    assert column_of(spark, [None], "double", numeric.half_up) == [None]
    assert column_of(spark, [0.1 + 0.2, 2.00005], "double", lambda c: numeric.half_up(c, 4)) == [0.3, 2.0001]


def test_half_up_absorbs_summation_noise(spark):
    noisy = 0.125 - 1e-13
    assert column_of(spark, [noisy], "double", numeric.half_up) == [0.13]


def test_guarded_arithmetic(spark):
    values = [None, 0, 7, -4]
    rows = [(a, b, c) for a in values for b in values for c in values]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    found = df.select(a, b, c, numeric.safe_add(a, b, c), numeric.safe_subtract(a, b, c), numeric.safe_divide(a, b)).collect()
    assert len(found) == len(rows)
    for x, y, z, added, subtracted, divided in found:
        assert added == (x or 0) + (y or 0) + (z or 0)
        assert subtracted == (x or 0) - (y or 0) - (z or 0)
        assert divided == (x / y if x is not None and y else None)


def test_bucket_of(spark):
    values = [-3.0, 9.99, 10.0, 14.9, 15.0, 22.5, 29.99, 30.0, 85.0]
    found = column_of(spark, values, "double", lambda c: numeric.bucket_of(c, 10, 30, 4))
    assert found == [0, 0, 1, 1, 2, 3, 4, 5, 5]


def test_haversine(spark):
    """A quarter of a great circle, one degree of longitude at the equator and at 60 degrees, and opposite points."""
    places = [(0.0, 0.0, 90.0, 0.0, math.pi / 2), (0.0, 10.0, 0.0, 11.0, math.pi / 180), (60.0, 0.0, 60.0, 1.0, None), (30.0, 20.0, -30.0, -160.0, math.pi)]
    df = spark.createDataFrame(places, "a double, b double, c double, d double, angle double")
    for unit, radius in (("mi", 3961), ("km", 3961 * 1.60934)):
        distance = numeric.haversine(*map(F.col, "abcd"), unit=unit)
        got = [r[0] for r in df.select(distance).collect()]
        for value, (*_, angle) in zip(got, places, strict=True):
            if angle is not None:
                assert value == pytest.approx(angle * radius)
        # At 60 degrees a degree of longitude is half as long, as good as.
        assert got[2] == pytest.approx(got[1] / 2, rel=1e-4)
    with pytest.raises(ValueError):
        numeric.haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0.0), "ft")


def test_finite_or_null(spark):
    found = column_of(spark, [1.5, float("nan"), float("inf"), float("-inf"), None], "double", numeric.finite_or_null)
    assert found == [1.5, None, None, None, None]


def test_white_space_and_case(spark):
    values = ["  North \t\r\n Mall  ", "a  b", None]
    assert column_of(spark, values, "string", text.store_label) == ["north mall", "a b", None]
    assert column_of(spark, values[:1], "string", text.supplier_label) == ["NORTH MALL"]


def test_focus_pattern_reads_the_raw_value(spark):
    values = ["The Acme Co", "AC ME", None]
    assert column_of(spark, values, "string", lambda c: text.is_focus_supplier(c, "%ACME%")) == [1, 0, 0]


def test_slug(spark):
    names = ["Fish & Chips - Large", "2nd  Aisle!", "plain"]
    wanted = ["fish__chips_large", "_2nd_aisle", "plain"]
    assert [text.slug(n) for n in names] == wanted
    assert column_of(spark, names, "string", text.slug_column) == wanted
    assert text.column_name(" Sub-Department ") == "Sub_Department"


def test_url_host(spark):
    cases = {
        "shop.example.org?page=2": "shop.example.org",
        "http://till.example/receipt?n=81": "till.example",
        "https://a-b.example.net/2031": "a-b.example.net",
        "android-app://goods.example.app/": "goods.example.app",
        "": "",
    }
    assert column_of(spark, list(cases), "string", text.url_host) == list(cases.values())


def test_url_path(spark):
    cases = {
        "https://shop.example.org/aisle/7/tea": "aisle/7/tea",
        "http://till.example?n=81": "",
        "http://till.example": "",
        "goods.example/x/y?q=/z": "x/y",
    }
    assert column_of(spark, list(cases), "string", text.url_path) == list(cases.values())
    assert column_of(spark, [None], "string", text.url_path) == [None]


def test_url_parameter(spark):
    urls = ["http://till.example?day=mon&goods=tea", "http://till.example/x", "till.example?goods=&x=1"]
    assert column_of(spark, urls, "string", lambda c: text.url_parameter(c, "goods")) == ["tea", None, None]
    assert column_of(spark, urls, "string", lambda c: text.url_parameter(c, "day")) == ["mon", None, None]


def test_half_up_of_large_and_special_values(spark):
    values = [3333333333.125, -3333333333.125, 1e15, float("inf"), 90071993.125]
    assert column_of(spark, values, "double", numeric.half_up) == [3333333333.13, -3333333333.13, 1e15, float("inf"), 90071993.13]
    (found,) = column_of(spark, [float("nan")], "double", numeric.half_up)
    assert found != found
    with pytest.raises(ValueError):
        numeric.half_up(F.lit(1.0), 8)
