"""Table checks on small tables with known failures."""

from datetime import datetime

import pytest

from helpers import rows_of
from shelfline.operators import checks, slices

DAY = [datetime(2021, 1, d) for d in range(1, 32)]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_not_null_unique_and_values(spark):
    df = frame(spark, [(1, "a"), (1, "b"), (None, ""), (None, "  "), (2, None)], "id int, s string")
    assert checks.not_null(df, "id").count() == 2
    assert rows_of(checks.unique(df, "id")) == [(1, 2)]
    assert rows_of(checks.accepted_values(df, "id", [1])) == [(2, 1)]
    assert rows_of(checks.not_accepted_values(df, "id", [1, 7])) == [(1,)]
    assert checks.not_empty_string(df, "s").count() == 2
    assert checks.not_empty_string(df, "s", trim=False).count() == 1
    assert checks.passed(checks.not_null(df.filter("id = 1"), "id"))


def test_accepted_range_lets_nulls_pass(spark):
    df = frame(spark, [(1,), (5,), (10,), (None,)], "v int")
    assert rows_of(checks.accepted_range(df, "v", 1, 9)) == [(10,)]
    assert rows_of(checks.accepted_range(df, "v", 1, 10, inclusive=False)) == [(1,), (10,)]
    assert rows_of(checks.accepted_range(df, "v", maximum=4)) == [(10,), (5,)]
    with pytest.raises(ValueError):
        checks.accepted_range(df, "v")


def test_at_least_one(spark):
    df = frame(spark, [("a", None), ("a", 1), ("b", None)], "g string, v int")
    assert rows_of(checks.at_least_one(df, "v", ["g"])) == [("b", 0)]
    assert checks.at_least_one(df, "v").count() == 0
    assert checks.at_least_one(df.filter("g = 'b'"), "v").count() == 1


def test_not_constant(spark):
    df = frame(spark, [("a", 1), ("a", 1), ("b", 1), ("b", 2), ("c", None), ("d", 1), ("d", None)], "g string, v int")
    assert rows_of(checks.not_constant(df, "v", ["g"])) == [("a", 1), ("d", 1)]
    assert checks.not_constant(df, "v").count() == 0


def test_not_null_proportion(spark):
    df = frame(spark, [(1, 1)] * 5 + [(None, 1)] * 4 + [(None, None)], "p5 int, p9 int")
    assert checks.not_null_proportion(df, "p5", 0.5).count() == 0
    assert checks.not_null_proportion(df, "p9", 0.9).count() == 0
    assert rows_of(checks.not_null_proportion(df, "p5", 0.6)) == [(0.5,)]
    assert checks.not_null_proportion(df, "p9", 0.1, 0.8).count() == 1


def test_row_counts(spark):
    a = frame(spark, [("x",), ("x",), ("y",)], "g string")
    b = frame(spark, [("x",), ("z",), ("z",)], "g string")
    assert checks.equal_rowcount(a, b).count() == 0
    assert rows_of(checks.equal_rowcount(a, b, ["g"])) == [("x", 2, 1, 1)]
    assert rows_of(checks.fewer_rows_than(a, b)) == [(3, 3, 1)]
    assert rows_of(checks.fewer_rows_than(a, b, ["g"])) == [("x", 2, 1, 1)]
    assert checks.fewer_rows_than(a.limit(1), b).count() == 0


def test_cardinality_equality(spark):
    a = frame(spark, [(1,), (1,), (2,), (None,)], "v int")
    b = frame(spark, [(1,), (2,), (3,), (None,)], "w int")
    assert rows_of(checks.cardinality_equality(a, "v", b, "w")) == [(1, 1), (1, 2), (3, 1)]
    assert checks.cardinality_equality(a, "v", a, "v").count() == 0


def test_equality(spark):
    a = frame(spark, [(1, "x"), (1, "x"), (2, None)], "i int, s string")
    b = frame(spark, [(1, "x"), (2, None), (3, "z")], "i int, s string")
    assert rows_of(checks.equality(a, b)) == [("b_minus_a", 3, "z")]
    assert rows_of(checks.equality(a, b, strict=True)) == [("a_minus_b", 1, "x"), ("b_minus_a", 3, "z")]
    assert checks.equality(a, b.filter("i < 3"), ["i"]).count() == 0


def test_expressions(spark):
    df = frame(spark, [(0, 1), (1, 0), (2, 2), (None, 1)], "a int, b int")
    assert rows_of(checks.expression_is_true(df, "a + b = 1")) == [(2, 2)]
    assert rows_of(checks.expression_is_true(df, "< 2", column="a")) == [(2, 2)]
    assert rows_of(checks.values_equal(df, "a", "b")) == [(0, 1), (1, 0)]


def test_recency(spark):
    df = frame(spark, [("a", DAY[0]), ("a", DAY[9]), ("b", DAY[3])], "g string, ts timestamp_ntz")
    late = datetime(2021, 1, 4, 12)
    assert rows_of(checks.recency(df, "ts", late, group_by=["g"]), "g") == [("b",)]
    assert checks.recency(df, "ts", late, ignore_time=True, group_by=["g"]).count() == 0
    assert checks.recency(df, "ts", late).count() == 0


def test_relationships_where(spark):
    child = frame(spark, [(1,), (2,), (2,), (None,), (4,)], "id int")
    parent = frame(spark, [(1,), (4,)], "id int")
    assert rows_of(checks.relationships_where(child, "id", parent, "id")) == [(2,), (2,)]
    assert checks.relationships_where(child, "id", parent, "id", child_where="id <> 2").count() == 0
    assert checks.relationships_where(child, "id", parent, "id", parent_where="id <> 4").count() == 3


@pytest.mark.parametrize("slice_rows", [10**6, 1])
def test_sequential_values(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(slices, "SLICE_ROWS", slice_rows)
    df = frame(spark, [("a", 2), ("a", 4), ("a", 6), ("b", 8), ("b", 11)], "g string, v int")
    assert rows_of(checks.sequential_values(df, "v", 2, group_by=["g"])) == [("b", 11, 8)]
    assert rows_of(checks.sequential_values(df, "v", 2)) == [(11, 8)]
    stamps = frame(spark, [(datetime(2021, 1, 1, h),) for h in (0, 1, 2, 4)], "ts timestamp_ntz")
    found = checks.sequential_values(stamps, "ts", 1, datepart="hour")
    assert rows_of(found) == [(datetime(2021, 1, 1, 4), datetime(2021, 1, 1, 2))]
    same = frame(spark, [("a", 2)] * 3 + [("a", 4)] * 2 + [("a", None)] * 2, "g string, v int")
    assert rows_of(checks.sequential_values(same, "v", 2, group_by=["g"])) == [("a", 2, 2), ("a", 2, 2), ("a", 4, 4)]
    assert checks.sequential_values(same, "v", 0, group_by=["g"]).count() == 1


@pytest.mark.parametrize("slice_rows", [10**6, 1])
def test_mutually_exclusive_ranges(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(slices, "SLICE_ROWS", slice_rows)

    def failing(rows, **options):
        df = frame(spark, rows, "sub int, lo int, hi int")
        return rows_of(checks.mutually_exclusive_ranges(df, "lo", "hi", "sub", **options))

    no_gaps = [(1, 0, 1), (1, 1, 2), (1, 2, 4)]
    assert failing(no_gaps, gaps="not_allowed") == failing(no_gaps) == []
    assert len(failing(no_gaps, gaps="required")) == 2
    gaps = [(1, 0, 2), (1, 3, 4), (2, 1, 5), (2, 4, 6)]
    assert failing(gaps) == [(2, 1, 5, 4)]
    assert failing(gaps, gaps="not_allowed") == [(1, 0, 2, 3), (2, 1, 5, 4)]
    zero = [(3, 0, 2), (3, 2, 2), (3, 2, 4), (3, 5, 5)]
    assert failing(zero, zero_length_allowed=True) == []
    assert failing(zero) == [(3, 2, 2, 2), (3, 5, 5, None)]
    # A range that occurs twice conflicts with its own copy; so does one of a group without a name.
    assert failing([(1, 0, 2), (1, 0, 2), (1, 2, 3)]) == [(1, 0, 2, 0)]
    assert failing([(None, 0, 2), (None, 1, 3)]) == [(None, 0, 2, 1)]
    assert failing([(1, 3, 1), (1, None, 4), (1, 2, None)]) == [(1, 2, None, 3), (1, 3, 1, None), (1, None, 4, None)]
    with pytest.raises(ValueError):
        failing(zero, gaps="maybe")


def test_columns_and_combinations(spark):
    df = frame(spark, [(1, "a"), (1, "a"), (1, None), (1, None)], "Month int, product string")
    assert rows_of(checks.unique_combination(df, ["Month", "product"])) == [(1, "a", 2), (1, None, 2)]
    assert checks.columns_match_set(spark, df, ["MONTH", "product"]).count() == 0
    found = checks.columns_match_set(spark, df, ["month", "price"])
    assert rows_of(found) == [("price", "missing"), ("product", "unexpected")]
