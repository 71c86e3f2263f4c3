"""Checks measured in one scan, observed while writing, and their verdicts."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from shelfline import stage_table
from shelfline.operators import check_summary as summary, checks


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, "a", 5.0, datetime(2024, 1, 1)), (2, " ", None, datetime(2024, 1, 3)), (2, None, 9.0, None), (None, "c", -1.0, datetime(2023, 5, 1))]
    return stage_table(spark.createDataFrame(rows, "id int, name string, v double, ts timestamp_ntz"), "checked")


def all_checks():
    return [
        summary.not_null("id"),
        summary.not_null("name").limits(error_if="> 5"),
        summary.accepted_values("name", ["a"]).limits(error_if="< 1", warn_if="< 0"),
        summary.not_accepted_values("name", ["c", "d"]),
        summary.accepted_range("v", 0, 5, inclusive=False),
        summary.not_empty_string("name"),
        summary.expression_is_true("v_above_id", "v > id"),
        summary.values_equal("id", "v"),
        summary.at_least_one("v"),
        summary.not_constant("id"),
        summary.not_null_proportion("ts", 0.8),
        summary.recency("ts", datetime(2024, 1, 2)),
    ]


WANTED = {
    "not_null_id": (1, 0.25, "error"), "not_null_name": (1, 0.25, "warn"), "accepted_values_name": (2, 0.5, "pass"),
    "not_accepted_values_name": (1, 0.25, "error"), "accepted_range_v": (3, 0.75, "error"), "not_empty_string_name": (1, 0.25, "error"),
    "v_above_id": (0, 0.0, "pass"), "values_equal_id": (2, 0.5, "error"), "at_least_one_v": (0, 3.0, "pass"), "not_constant_id": (0, None, "pass"),
    "not_null_proportion_ts": (1, 0.75, "error"), "recency_ts": (0, 86400.0, "pass"),
}


def as_dict(df):
    return {r["check_name"]: tuple(r)[1:] for r in df.collect()}


def test_one_row_per_check_from_one_scan(table):
    found = summary.check_summary(table, all_checks())
    assert ", ".join(f"{n} {t}" for n, t in found.dtypes) == summary.SCHEMA
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert as_dict(found) == WANTED


def test_failures_equal_the_failing_rows(table):
    pairs = [
        (summary.not_null("id"), checks.not_null(table, "id")),
        (summary.accepted_range("v", 0, 5), checks.accepted_range(table, "v", 0, 5)),
        (summary.not_empty_string("name"), checks.not_empty_string(table, "name")),
        (summary.expression_is_true("e", "v > id"), checks.expression_is_true(table, "v > id")),
        (summary.values_equal("id", "v"), checks.values_equal(table, "id", "v")),
        (summary.at_least_one("v"), checks.at_least_one(table, "v")),
        (summary.not_constant("id"), checks.not_constant(table, "id")),
        (summary.not_null_proportion("ts", 0.8), checks.not_null_proportion(table, "ts", 0.8)),
        (summary.recency("ts", datetime(2025, 1, 1)), checks.recency(table, "ts", datetime(2025, 1, 1))),
    ]
    for check, failing in pairs:
        assert as_dict(summary.check_summary(table, [check]))[check.name][0] == failing.count()


def test_the_same_numbers_are_observed_while_writing(spark, table):
    watched, numbers = summary.observed(table, all_checks())
    stage_table(watched, "watched")
    assert as_dict(summary.verdicts(spark, all_checks(), numbers)) == WANTED
    with pytest.raises(summary.ChecksFailed) as failed:
        summary.require(all_checks(), numbers)
    assert failed.value.failed == [(n, v[0]) for n, v in WANTED.items() if v[2] == "error"]
    with pytest.raises(ValueError, match="unique_id"):
        summary.observed(table, [summary.unique("id")])


def test_checks_with_other_tables_and_distinct_counts(spark, table):
    three = spark.range(3)
    count = three.select(F.count(F.lit(1))).scalar()
    wanted = [summary.unique("id"), summary.unique("id", "name"), summary.fewer_rows_than(count), summary.equal_rowcount(count)]
    assert as_dict(summary.check_summary(table, wanted)) == {
        "unique_id": (1, 2.0, "error"), "unique_id_name": (0, 4.0, "pass"), "fewer_rows_than": (1, 4.0, "error"), "equal_rowcount": (1, 4.0, "error"),
    }
    uneven = checks.equality(table, table.filter("id = 1"), ["id"])
    assert as_dict(summary.measured("same", uneven, measure=F.count_if(F.col("side") == "a_minus_b"))) == {"same": (2, 2.0, "error")}
    assert as_dict(summary.measured("same", uneven, failures=F.sum("id"), error_if="> 2", warn_if=">= 2")) == {"same": (2, None, "warn")}


def test_empty_tables_and_wrong_checks(table):
    found = as_dict(summary.check_summary(table.filter("false"), all_checks()))
    assert {n for n, (failures, _, _) in found.items() if failures} == {"at_least_one_v"}
    assert found["not_null_id"] == (0, None, "pass")
    assert rows_of(summary.check_summary(table.filter("false"), [summary.recency("ts", datetime(2024, 1, 2))]), "failures") == [(0,)]
    for wrong in ([], [summary.not_null("id")] * 2):
        with pytest.raises(ValueError):
            summary.check_summary(table, wrong)
    for limit in ("0", "> x", "=> 1", "> 1 or true"):
        with pytest.raises(ValueError):
            summary.not_null("id").limits(error_if=limit)
