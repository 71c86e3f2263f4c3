"""CSV loading, cleaning, layers and JSON."""

import hashlib
import json
import math
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import first, rows_of, sale, sales_frame
from shelfline.operators.check_summary import ChecksFailed, not_null
from shelfline.plans import staging
from shelfline.sources import ingest, sinks
from shelfline.sources.schema import SALES_SCHEMA

HEADER = ["Store Name", "Item-Code", "Item_Barcode", "Description", "Category", "Department", "Sub-Department",
          "Section", "Quantity", "Total Sales", "RRP", "Supplier", "Date Of Sale"]
GOOD = ["North", "10", "000123", '"Tea, ""green"""', "Foods", "Drinks", "Hot", "Tea", "2", "20.50", "11", "Acme", "2025-09-22"]


def write(tmp_path, *lines, header=HEADER):
    (tmp_path / "sales.csv").write_text("\n".join(",".join(line) for line in [header, *lines]) + "\n")
    return str(tmp_path / "sales.csv")


def changed(position, value):
    return [value if i == position else v for i, v in enumerate(GOOD)]


def test_read_sales(spark, tmp_path):
    path = write(tmp_path, GOOD, changed(2, ""), changed(3, '"two\nlines"'))
    df = ingest.read_sales(spark, path, multi_line=True)
    assert df.schema == SALES_SCHEMA
    row = df.filter("Item_Barcode = '000123' and Description like 'Tea%'").first()
    assert (row["Description"], float(row["Total_Sales"]), row["Date_Of_Sale"]) == ('Tea, "green"', 20.5, date(2025, 9, 22))
    assert df.filter("Item_Barcode is null").count() == 1
    assert df.filter("Description = 'two\\nlines'").count() == 1


def test_columns_are_matched_by_name(spark, tmp_path):
    swapped = [1, 0, *range(2, 13)]
    path = write(tmp_path, [GOOD[i] for i in swapped], header=[HEADER[i] for i in swapped])
    assert rows_of(ingest.read_sales(spark, path), "Store_Name", "Item_Code") == [("North", "10")]


@pytest.mark.parametrize("position,value", [(8, "two"), (12, "yesterday"), (12, "10:30"), (8, "0.4550000000000000001"), (10, "1e-20"), (9, "123456789012345678901")])
def test_strict_load_refuses_unreadable_values(spark, tmp_path, position, value):
    with pytest.raises(Exception, match="cannot read"):
        ingest.read_sales(spark, write(tmp_path, GOOD, changed(position, value))).collect()


def test_missing_file_and_columns(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        ingest.read_sales(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match="RRP"):
        ingest.read_sales(spark, write(tmp_path, GOOD[:10] + GOOD[11:], header=HEADER[:10] + HEADER[11:]))


def test_load_replaces_the_table(spark, tmp_path):
    table = str(tmp_path / "table")
    assert ingest.load_sales(spark, write(tmp_path, GOOD, GOOD), table) == 2
    assert ingest.load_sales(spark, write(tmp_path, GOOD), table) == 1


def test_validate_load(spark):
    good = sales_frame(spark, [sale()])
    assert first(ingest.validate_load(good)) == {"row_count": 1, "required_columns_present": 6, "validation": "passed"}
    assert first(ingest.validate_load(good.filter("false")))["validation"] == "failed"
    assert first(ingest.validate_load(good.drop("Supplier")))["validation"] == "failed"
    assert ingest.require_valid_load(good) == 1
    for bad in (good.filter("false"), good.drop("Supplier")):
        with pytest.raises(ValueError):
            ingest.require_valid_load(bad)


def test_cleaning_and_rejects(spark, tmp_path):
    path = write(
        tmp_path, changed(0, '"  North\r\n  Mall "'), changed(12, "soon"), changed(8, "many"), changed(3, ""),
        changed(10, "cheap"), changed(9, ""),
    )
    clean = ingest.clean_text_columns(ingest.read_csv_text(spark, path, multi_line=True))
    kept, rejected = ingest.coerce_and_drop_invalid(clean)
    assert rows_of(kept, "Store_Name", "RRP") == [("North Mall", 11.0), ("North", None)]
    assert rejected.count() == 4
    assert rows_of(ingest.reject_counts(clean)) == [
        ("invalid date", 1), ("missing Description", 1), ("missing Quantity", 1), ("missing Total_Sales", 1),
    ]


def test_dates_in_several_formats(spark, tmp_path):
    formats = ["d/M/yyyy", "dd-MMM-yyyy"]
    days = ["24/09/2025", "4/9/2025", "24-Sep-2025", "2025-09-24 10:30:00"]
    path = write(tmp_path, *[changed(12, d) for d in days])
    found = ingest.read_sales(spark, path, date_formats=formats).select("Date_Of_Sale").collect()
    assert [r[0] for r in found] == [date(2025, 9, 24), date(2025, 9, 4), date(2025, 9, 24), date(2025, 9, 24)]
    rejected = ingest.reject_counts(ingest.clean_text_columns(ingest.read_csv_text(spark, path)), formats[:1])
    assert rows_of(rejected) == [("invalid date", 1)]


def test_numbers_keep_their_decimals(spark, tmp_path):
    path = write(tmp_path, GOOD, changed(8, "0.455"), changed(8, "875.5"), changed(10, "11.999"), changed(9, "1e3"), changed(8, ""))
    df = ingest.read_sales(spark, path)
    assert [df.schema[c].dataType.simpleString() for c in ("Quantity", "Total_Sales", "RRP")] == ["decimal(28,3)", "decimal(18,2)", "decimal(28,3)"]
    assert sorted(r[0] for r in df.filter("Quantity is not null").select("Quantity").collect()) == [Decimal(x) for x in ("0.455", "2", "2", "2", "875.5")]
    ingest.load_sales(spark, path, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).schema == df.schema
    wide = write(tmp_path, changed(8, "12345678901234567890.123456789012345678"), changed(8, "0.1"))
    assert ingest.read_sales(spark, wide).agg(F.max("Quantity")).first()[0] == Decimal("12345678901234567890.123456789012345678")


def test_more_decimals_in_a_file_change_no_key(spark, tmp_path, cfg):
    def keys(*lines):
        rows = staging.stage_sales(ingest.read_sales(spark, write(tmp_path, *lines)), cfg)
        return {float(r["quantity"]): r["sales_record_id"] for r in rows.collect()}

    plain = keys(changed(8, "875.5"), changed(8, "-3"), changed(8, "0"))
    finer = keys(changed(8, "875.5"), changed(8, "-3"), changed(8, "0"), changed(8, "0.455"), changed(8, "100.1000"))
    assert all(finer[q] == key for q, key in plain.items()) and len(set(finer.values())) == 5
    parts = "-".join(["North", "10", "2025-09-22", "0.455", "20.50"])
    assert finer[0.455] == hashlib.md5(parts.encode()).hexdigest()


def test_cleaning_without_dates_and_with_too_many_decimals(spark, tmp_path):
    path = write(tmp_path, GOOD[:12], changed(8, "0.455")[:12], changed(10, "0.1234567890123456789")[:12], header=HEADER[:12])
    clean = ingest.clean_text_columns(ingest.read_csv_text(spark, path))
    kept = ingest.coerce_and_drop_invalid(clean)[0]
    assert sorted(str(r[0]) for r in kept.select("Quantity").collect()) == ["0.455", "2.000"]
    assert rows_of(ingest.reject_counts(clean)) == [("inexact RRP", 1)]


def test_a_failing_build_leaves_the_old_table(spark, tmp_path):
    layers = sinks.Layers(str(tmp_path))
    df = spark.createDataFrame([(1,), (2,)], "id int")
    assert layers.write(df, sinks.MARTS, "t", stamp="built_at").columns == ["id"]
    assert layers.read(spark, sinks.MARTS, "t").where("built_at is not null").count() == 2
    with pytest.raises(Exception, match="no good"):
        layers.write(df.select(F.raise_error(F.lit("no good")).alias("id")), sinks.MARTS, "t")
    assert layers.read(spark, sinks.MARTS, "t").count() == 2
    # A table can be replaced by what was computed from it.
    assert layers.write(layers.read(spark, sinks.MARTS, "t").where("id = 1").select("id"), sinks.MARTS, "t").count() == 1


@pytest.mark.parametrize("step", ["write", "manifest", "rename"])
def test_a_build_that_dies_at_any_step_leaves_the_old_table(spark, tmp_path, monkeypatch, step):
    layers = sinks.Layers(str(tmp_path))
    df = spark.createDataFrame([(1, 0), (2, 1)], "id int, is_focus int")
    old = layers.write(df, sinks.MARTS, "t", partition_by=["is_focus"])

    class Killed(BaseException):
        pass

    def die(*_):
        raise Killed

    if step == "write":  # the rows are there, nothing names them
        monkeypatch.setattr(sinks, "_commit", die)
    elif step == "manifest":  # the manifest is begun, but not moved
        real = sinks._hadoop_path

        def begun(session, path):
            if f"{sinks.MANIFEST}." in path:
                found, files = real(session, path)
                files.create(found, True).close()
                raise Killed
            return real(session, path)

        monkeypatch.setattr(sinks, "_hadoop_path", begun)
    else:  # the manifest is moved, the old version not yet removed
        monkeypatch.setattr(sinks, "_delete", die)
        layers.write(df.filter("id = 1"), sinks.MARTS, "t", partition_by=["is_focus"])
    with pytest.raises(Killed):
        layers.write(df.filter("id < 0"), sinks.MARTS, "t", partition_by=["is_focus"])
    monkeypatch.undo()
    assert layers.read(spark, sinks.MARTS, "t").count() == {"write": 2, "manifest": 2, "rename": 0}[step]
    assert rows_of(old) == [(1, 0), (2, 1)]
    # The next build goes on as if nothing had happened, also with other columns.
    again = layers.write(spark.createDataFrame([("x", 3)], "name string, id long"), sinks.MARTS, "t")
    assert rows_of(again) == [("x", 3)] and layers.read(spark, sinks.MARTS, "t").columns == ["name", "id"]


def test_readers_keep_their_version_for_one_more_write(spark, tmp_path):
    layers = sinks.Layers(str(tmp_path))
    opened = layers.write(spark.range(3).toDF("id"), sinks.MARTS, "t")
    layers.write(spark.range(5).toDF("id"), sinks.MARTS, "t")
    assert opened.count() == 3 and layers.read(spark, sinks.MARTS, "t").count() == 5
    layers.write(spark.range(6).toDF("id"), sinks.MARTS, "t")
    layers.write(spark.range(7).toDF("id"), sinks.MARTS, "t")
    assert len(list((tmp_path / "retail_marts" / "t").glob("v-*"))) == 2
    with pytest.raises(FileNotFoundError):
        layers.read(spark, sinks.MARTS, "never_built")


def test_checks_decide_whether_a_write_is_committed(spark, tmp_path):
    layers = sinks.Layers(str(tmp_path))
    wanted = [not_null("id"), not_null("name").limits(error_if="> 1")]
    good = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    layers.write(good, sinks.MARTS, "t", checks=wanted)
    with pytest.raises(ChecksFailed) as failed:
        layers.write(good.unionAll(spark.createDataFrame([(None, None)], good.schema)), sinks.MARTS, "t", checks=wanted)
    assert failed.value.failed == [("not_null_id", 1), ("not_null_name", 2)]
    assert rows_of(layers.read(spark, sinks.MARTS, "t")) == [(1, "a"), (2, None)]
    assert len(list((tmp_path / "retail_marts" / "t").glob("v-*"))) == 1


def test_source_checks_stop_a_build(spark):
    for column in ("Store_Name", "Item_Code"):
        with pytest.raises(ChecksFailed, match=f"not_null_{column} \\(1\\)"):
            ingest.require_valid_load(sales_frame(spark, [sale(), sale(**{column: None})]))
    assert ingest.require_valid_load(sales_frame(spark, [sale(), sale(Item_Code=None)]), []) == 2


def test_load_profile(spark):
    rows = [sale(), sale(Supplier=None, Store_Name="B", Total_Sales=5, Date_Of_Sale=date(2025, 9, 28)), sale(Total_Sales=None)]
    assert first(ingest.load_profile(sales_frame(spark, rows))) == {
        "total_rows": 3, "first_date": date(2025, 9, 22), "last_date": date(2025, 9, 28), "unique_stores": 2,
        "unique_suppliers": 1, "total_sales": 25.0,
    }
    assert first(ingest.load_profile(sales_frame(spark, [])))["total_rows"] == 0


def test_csv_round_trip_keeps_outer_blanks(spark, tmp_path):
    df = sales_frame(spark, [sale(Store_Name="  a ", Item_Barcode="   ", Description='say "hi", twice'), sale(RRP=None)])
    sinks.write_csv(df, str(tmp_path / "csv"))
    assert rows_of(ingest.read_sales(spark, str(tmp_path / "csv"))) == rows_of(df)


def test_layers(spark, tmp_path):
    layers = sinks.Layers(str(tmp_path))
    df = spark.createDataFrame([(1, "b", 0), (2, "a", 1)], "id int, name string, is_focus int")
    back = layers.write(df, sinks.MARTS, "t", partition_by=["is_focus"], sort_by=["name"])
    assert back.columns == df.columns and rows_of(back) == rows_of(df)
    version = layers.current(spark, sinks.MARTS, "t")["version"]
    assert (tmp_path / "retail_marts" / "t" / version / "is_focus=1").is_dir()
    layers.write(df.limit(1), sinks.MARTS, "t")
    assert layers.read(spark, sinks.MARTS, "t").count() == 1
    assert layers.publish_view(df, sinks.STAGING, "v").count() == spark.table("retail_staging_v").count() == 2


def test_json_has_no_unreadable_numbers(spark, tmp_path):
    df = spark.createDataFrame([(1.5,), (math.nan,), (math.inf,)], "x double").withColumn("f", F.col("x").cast("float"))
    sinks.write_json(df, str(tmp_path / "out"))
    lines = [json.loads(x) for f in sorted((tmp_path / "out").glob("*.json")) for x in f.read_text().splitlines()]
    assert sorted((r["x"], r["f"]) for r in lines if r["x"] is not None) == [(1.5, 1.5)]
    assert len(lines) == 3
