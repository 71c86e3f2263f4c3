"""Texts that are plain already skip the costly way and give the same values as those that are not."""

from datetime import date

from pyspark.sql import functions as F, types as T

from shelfline.functions.numeric import below, stable
from shelfline.functions.text import collapse_spaces
from shelfline.sources import ingest


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_blanks(spark):
    texts = ["a b", "a  b", "a\tb", "a  b", "a\r\nb", " a", "a ", "é b", "", None, "a\x1cb", "a\x85b"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    long_way = F.regexp_replace("t", r"(?U)\s+", " ")
    found = rows.select(collapse_spaces(F.col("t")).alias("found"), long_way.alias("wanted"))
    assert all(r["found"] == r["wanted"] for r in found.collect())
    assert "CASE WHEN RLIKE" in plan_of(found)


def test_numbers_and_dates(spark):
    rows = spark.createDataFrame(
        [("0012.50", "1", "2025-01-31"), ("-3", "1e2", "2025-02-30"), (" 7.1 ", "n/a", "2025-01-31T05:00:00"), ("unknown", "+2.0", "12:30"), (None, None, None)],
        "Quantity string, RRP string, Date_Of_Sale string",
    )
    assert ingest.number_types(rows) == {"Quantity": ingest.MONEY, "RRP": ingest.MONEY}
    judged = ingest.with_reject_reason(rows)
    found = {(str(r["Quantity"]), str(r["RRP"]), r["Date_Of_Sale"], r["reject_reason"]) for r in judged.collect()}
    day = date(2025, 1, 31)
    assert found == {
        ("12.50", "1.00", day, None), ("-3.00", "100.00", None, "invalid date"), ("7.10", "None", day, None),
        ("None", "2.00", None, "invalid date"), ("None", "None", None, "invalid date"),
    }
    # A bare day is no longer read as a timestamp, and a word is not cast.
    assert plan_of(judged).count("[0-9]{2}-[0-9]{2}$") > 0


def test_types_of_long_numbers(spark):
    def types(*texts):
        return ingest.number_types(spark.createDataFrame([(t,) for t in texts], "Quantity string"))["Quantity"]

    assert types("1234567890123456.12", "-0.5") == ingest.MONEY
    assert types("12345678901234567") == T.DecimalType(28, 2)
    # A plain number's digits count beside those of another one's decimals.
    assert types("1234567890123456", "0." + "1" * 12) == T.DecimalType(28, 12)
    assert types("1234567890123456", "0." + "1" * 13) == T.DecimalType(38, 13)
    assert types("0000000000000001", "0." + "1" * 18) == T.DecimalType(28, 18)


def test_below(spark):
    values = [5.0, 4.999999999, 4.99999999, 4.9999999951, 4.9999999949, 5.000000001, 0.0, -0.0, -1e12, 1e12, float("nan"), float("inf"), float("-inf"), None]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    found = rows.select("v", below(F.col("v"), 5).alias("found"), (stable(F.col("v")) < 5.0).alias("wanted")).collect()
    assert len({r["found"] for r in found}) == 3 and all(r["found"] == r["wanted"] for r in found)
