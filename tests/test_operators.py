"""Whole-table operators, also where groups count as hot."""

import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from shelfline import stage_table
from shelfline.operators import relational, series, slices
from shelfline.operators.ordering import with_neighbour, with_rank
from shelfline.operators.percentiles import percentile_summary
from shelfline.session import scratch_root

WANTED = {"a25": ("a", 0.25), "a50": ("a", 0.5), "b99": ("b", 0.99)}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows under one key, a NULL key, repeated and missing values."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else rng.choice(["x", "y", None, "z", "solo"][: 4 if i else 5])
        rows.append((key, rng.choice([None, 1.0, 2.5, round(rng.uniform(0, 9), 2)]), rng.gauss(0, 50), i))
    rows.append(("single", 4.0, None, 3000))
    return stage_table(spark.createDataFrame(rows, "k string, a double, b double, i int"), "skewed"), rows


@pytest.fixture(params=[10**6, 100, 7])
def slice_rows(request, monkeypatch):
    monkeypatch.setattr(slices, "SLICE_ROWS", request.param)
    return request.param


def test_percentiles_match_numpy(skewed, slice_rows):
    df, rows = skewed
    found = percentile_summary(df, ["k"], WANTED, [F.count(F.lit(1)).alias("n"), F.avg("b").alias("mean")])
    result = {r["k"]: r for r in found.collect()}
    assert set(result) == {r[0] for r in rows}
    for key, got in result.items():
        mine = [r for r in rows if r[0] == key]
        for name, (column, fraction) in WANTED.items():
            values = [r[1 if column == "a" else 2] for r in mine if r[1 if column == "a" else 2] is not None]
            wanted = np.percentile(values, fraction * 100) if values else None
            assert got[name] == (None if wanted is None else pytest.approx(wanted, abs=1e-9))
        assert got["n"] == len(mine)


def test_percentiles_of_the_whole_table(skewed, slice_rows):
    df, rows = skewed
    got = percentile_summary(df, [], WANTED, [F.max("b").alias("top")]).collect()
    assert len(got) == 1 and set(got[0].asDict()) == {*WANTED, "top"}
    assert got[0]["b99"] == pytest.approx(np.percentile([r[2] for r in rows if r[2] is not None], 99), abs=1e-9)
    assert set(percentile_summary(df, [], WANTED, []).columns) == set(WANTED)


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, a double, b double")
    assert percentile_summary(empty, ["k"], WANTED, []).count() == 0
    assert percentile_summary(empty, [], WANTED, []).first()["a50"] is None


def test_a_group_of_all_rows_is_spread_over_slices(spark, monkeypatch):
    """One key, one NULL key, few values with very many copies, and rows equal in all but the last column."""
    monkeypatch.setattr(slices, "SLICE_ROWS", 500)
    df = stage_table(spark.range(20_000).selectExpr("'k' as k", "cast(null as int) as g", "cast(id % 7 as int) as few", "id as many"), "one-group")
    few = slices.in_slices(slices.counted(df, ["k", "few"]), [F.col("k"), F.col("few")], "few")
    assert rows_of(few, "few", "copies") == [(i, 2858 if i < 1 else 2857) for i in range(7)]
    many = slices.in_slices(slices.counted(df, ["g", "few", "many"]), [F.col(c).asc_nulls_last() for c in ("g", "few", "many")], "many")
    sizes = [r["count"] for r in many.groupBy("slice").count().collect()]
    assert len(sizes) >= 30 and max(sizes) <= 3 * 500
    begins = stage_table(slices.starts(many, ["g"]), "starts")
    assert begins.count() == len(sizes)
    placed = slices.with_before(many, begins, ["g"], [F.col("few"), F.col("many")])
    assert [r["before"] for r in placed.orderBy("few", "many").select("before").collect()] == list(range(20_000))


def test_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(slices, "_COPIES", 10)
    df = spark.createDataFrame([("a", 25), ("b", 1), ("c", 0), (None, 10)], "v string, n int")
    assert rows_of(slices.repeated(df, F.col("n")).groupBy("v").count()) == sorted([("a", 25), ("b", 1), (None, 10)], key=str)


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("following", [True, False])
def test_neighbours_equal_brute_force(skewed, slice_rows, keys, following):
    df, rows = skewed
    found = rows_of(with_neighbour(df, keys, ["a", "i"], ["i"], following), "i", "neighbour.i")
    groups = {}
    for r in rows:
        groups.setdefault(r[0] if keys else None, []).append((r[1] is None, r[1] or 0, r[3]))
    wanted = []
    for members in groups.values():
        ordered = [m[2] for m in sorted(members)]
        step = 1 if following else -1
        for place, i in enumerate(ordered):
            other = place + step
            wanted.append((i, ordered[other] if 0 <= other < len(ordered) else None))
    assert found == sorted(wanted, key=str)


def test_rank(skewed, slice_rows):
    df, rows = skewed
    ranked = with_rank(df, "a", "place")
    assert dict(ranked.dtypes)["place"] == "bigint"
    found = dict(rows_of(ranked, "i", "place"))
    values = [r[1] for r in rows if r[1] is not None]
    for _, a, _, i in rows:
        assert found[i] == (1 + sum(v > a for v in values) if a is not None else len(values) + 1)


def test_staged_tables_live_under_the_checkpoint_folder(spark, skewed):
    assert all(scratch_root(spark) in f for f in skewed[0].inputFiles())


def test_union_relations(spark):
    stalls = spark.createDataFrame([(11, "north gate", 4.5), (12, "pier", None)], "stall int, place string, rent double")
    carts = spark.createDataFrame([(11, 2, 9.25)], "stall int, wheels int, rent double")
    both = relational.union_relations({"stalls": stalls, "carts": carts})
    assert both.columns == ["source_relation", "stall", "place", "rent", "wheels"]
    assert rows_of(both) == [("carts", 11, None, 9.25, 2), ("stalls", 11, "north gate", 4.5, None), ("stalls", 12, "pier", None, None)]
    excluded = relational.union_relations({"a": stalls, "b": carts}, exclude=["PLACE"], source_column=None, where="stall = 11")
    assert rows_of(excluded) == [(11, 4.5, None), (11, 9.25, 2)]
    included = relational.union_relations({"a": stalls, "b": carts}, include=["Stall"], column_override={"stall": "string"})
    assert included.dtypes == [("source_relation", "string"), ("stall", "string")]
    with pytest.raises(ValueError):
        relational.union_relations({"a": stalls}, include=["stall"], exclude=["place"])
    with pytest.raises(ValueError):
        relational.union_relations({"a": stalls}, include=["nothing"])


def test_deduplicate_keeps_null_keys(spark):
    prices = [("A7", 2.0, 5), ("A7", 3.5, 9), ("A7", 1.0, 1), (None, 4.0, 2), (None, 6.0, 7)]
    df = spark.createDataFrame(prices, "item string, price double, day int")
    assert rows_of(relational.deduplicate(df, ["item"], [F.col("day").desc()])) == [("A7", 3.5, 9), (None, 6.0, 7)]


def test_pivot(spark):
    sold = [("mon", "tea"), ("mon", "rye bread"), ("mon", "baker's mix"), ("tue", "tea"), ("tue", "tea")]
    df = spark.createDataFrame(sold, "day string, goods string")
    values = relational.column_value_list(df, "goods", 10, where="goods <> 'baker''s mix'")
    assert values == ["tea", "rye bread"]
    assert rows_of(relational.pivot(df, ["day"], "goods", ["tea", "rye bread", "baker's mix"])) == [("mon", 1, 1, 1), ("tue", 2, 0, 0)]
    named = relational.pivot(df, ["day"], "goods", ["rye bread"], prefix="N ", suffix="!", as_identifier=True)
    assert named.columns == ["day", "n_rye_bread"]
    distinct = relational.pivot(df, [], "day", ["mon"], aggregate=F.count_distinct, then_value=F.col("goods"), else_value=None)
    assert rows_of(distinct) == [(3,)]


def test_unpivot_keeps_nulls_and_spells_out_booleans(spark):
    df = spark.createDataFrame([(1, "open", None, True), (2, None, "a", False)],
                               "id int, status string, segment string, updated boolean")
    found = relational.unpivot(df, exclude=["ID"], remove=["segment"], field_name="prop", value_name="val")
    assert rows_of(found) == [(1, "status", "open"), (1, "updated", "true"), (2, "status", None), (2, "updated", "false")]


def test_column_values(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "field string")
    assert [tuple(r) for r in relational.column_values(df, "field", max_records=2).collect()] == [("b", 2), ("a", 1)]
    assert relational.column_value_list(None, "field", 5, default=["x"]) == ["x"]
    assert relational.column_value_list(df, "field", 5, default=["x"], where="field = 'zz'") == ["x"]
    with pytest.raises(ValueError):
        relational.column_value_list(None, "field", 5)


def test_select_except_and_group_by_first(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 2)], "g1 string, g2 string, value int")
    assert relational.select_except(df, ["VALUE"], "p_", "_s", alias="t").columns == ["p_g1_s", "p_g2_s"]
    with pytest.raises(ValueError):
        relational.select_except(df, df.columns)
    assert rows_of(relational.group_by_first(df, 2, F.sum("value").alias("v"))) == [("a", "x", 3)]
    with pytest.raises(ValueError):
        relational.group_by_first(df, 4)


def test_blank_to_null(spark):
    df = spark.createDataFrame([("", 1), ("a", 2), (None, None)], "s string, n int")
    assert rows_of(relational.blank_to_null(df)) == [("a", 2), (None, 1), (None, None)]
    assert rows_of(relational.null_profile(df), "column_name", "row_count", "null_count") == [("n", 3, 1), ("s", 3, 2)]


def test_scalar_or_default(spark):
    df = spark.range(3)
    assert df.filter(F.col("id") > relational.scalar_or_default(df.agg(F.avg("id")), 9.0)).count() == 1
    none = relational.scalar_or_default(df.filter("id > 5"), 7)
    assert spark.range(1).select(none).first()[0] == 7


def test_union_by_pattern(spark):
    for week in (31, 32, 33):
        spark.createDataFrame([(week, 2.5 * week)], "week int, takings double").createOrReplaceTempView(f"till_week_{week}")
    found = relational.union_by_pattern(spark, "TILL_Week%", exclude="%3")
    assert rows_of(found) == [("till_week_31", 31, 77.5), ("till_week_32", 32, 80.0)]
    assert list(relational.relations_with_prefix(spark, "till_week_3")) == [f"till_week_{w}" for w in (31, 32, 33)]


def test_relations_of_several_databases(spark):
    """Two databases with tables and a view, and one that does not match."""
    for schema in ("shop_north", "shop_south", "depot"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    try:
        for i, name in enumerate(("shop_north.till_1", "shop_north.till_2", "shop_south.till_1", "depot.till_1", "shop_north.stock")):
            spark.range(i, i + 1).write.mode("overwrite").saveAsTable(name)
        spark.sql("CREATE OR REPLACE VIEW shop_north.till_view AS SELECT id + 100 AS id FROM shop_north.till_1")
        spark.range(1).createOrReplaceTempView("till_temporary")
        found = relational.relations_like(spark, "TILL%", database="shop%")
        assert list(found) == ["shop_north.till_1", "shop_north.till_2", "shop_north.till_view", "shop_south.till_1"]
        assert found["shop_north.till_view"] == "VIEW"
        assert list(relational.relations_with_prefix(spark, "till", "%2", "shop_north", ["table"])) == ["shop_north.till_1"]
        union = relational.union_by_pattern(spark, "till%", database="SHOP%", types=["TABLE"])
        assert rows_of(union) == [("shop_north.till_1", 0), ("shop_north.till_2", 1), ("shop_south.till_1", 2)]
        assert "till_temporary" in relational.relations_like(spark, "till%")
        with pytest.raises(ValueError, match="no relation"):
            relational.union_by_pattern(spark, "till%", database="nowhere")
    finally:
        for schema in ("shop_north", "shop_south", "depot"):
            spark.sql(f"DROP DATABASE IF EXISTS {schema} CASCADE")


def test_generate_series(spark):
    assert rows_of(series.generate_series(spark, 10)) == sorted([(i,) for i in range(1, 11)], key=str)
    with pytest.raises(ValueError):
        series.generate_series(spark, 0)


@pytest.mark.parametrize(
    "part,start,end,wanted",
    [
        ("day", date(2018, 1, 1), date(2018, 1, 10), [datetime(2018, 1, d) for d in range(1, 10)]),
        ("hour", datetime(2020, 2, 28, 22), datetime(2020, 2, 29, 0, 30),
         [datetime(2020, 2, 28, 22), datetime(2020, 2, 28, 23), datetime(2020, 2, 29)]),
        ("month", date(2020, 1, 31), date(2020, 4, 1), [datetime(2020, 1, 31), datetime(2020, 2, 29), datetime(2020, 3, 31)]),
        ("quarter", date(2020, 1, 1), date(2020, 7, 1), [datetime(2020, 1, 1), datetime(2020, 4, 1)]),
        ("year", date(2019, 5, 5), date(2021, 5, 6), [datetime(y, 5, 5) for y in (2019, 2020, 2021)]),
        ("week", date(2020, 1, 1), date(2020, 1, 9), [datetime(2020, 1, 1), datetime(2020, 1, 8)]),
    ],
)
def test_date_spine(spark, part, start, end, wanted):
    assert [r[0] for r in series.date_spine(spark, part, start, end).orderBy(1).collect()] == wanted


def test_date_spine_rejects_bad_arguments(spark):
    with pytest.raises(ValueError):
        series.date_spine(spark, "day", date(2020, 1, 2), date(2020, 1, 2))
    with pytest.raises(ValueError):
        series.date_spine(spark, "fortnight", date(2020, 1, 1), date(2020, 1, 2))


def test_gap_filled(spark):
    start = datetime(2024, 1, 1)
    df = spark.createDataFrame([(start + timedelta(hours=5), 2.0), (start + timedelta(days=2), 1.0)],
                               "ts timestamp_ntz, v double")
    found = series.gap_filled(df, "ts", "day", {"n": F.count(F.lit(1)), "v": F.sum("v")}, start, start + timedelta(days=4))
    assert [(r["n"], r["v"]) for r in found.orderBy("date_day").collect()] == [(1, 2.0), (0, 0.0), (1, 1.0), (0, 0.0)]


def test_union_relations_widens_types_and_matches_without_case(spark):
    one = spark.createDataFrame([(1, 2)], "Id int, amount int")
    two = spark.createDataFrame([(5_000_000_000, 2.75)], "id bigint, AMOUNT double")
    both = relational.union_relations({"one": one, "two": two}, source_column=None)
    assert both.dtypes == [("Id", "bigint"), ("amount", "double")]
    assert rows_of(both) == [(1, 2.0), (5_000_000_000, 2.75)]


def test_column_value_list_has_no_limit_of_its_own(spark, monkeypatch):
    df = spark.range(12).select(F.col("id").cast("string").alias("v"))
    assert len(relational.column_value_list(df, "v")) == 12
    monkeypatch.setattr(relational, "MOST_VALUES", 11)
    with pytest.raises(ValueError):
        relational.column_value_list(df, "v")
