"""CSV to the typed sales table: strict load, or cleaning with a reject list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfline.functions.numeric import MONEY
from shelfline.functions.text import column_name, tidy
from shelfline.operators.check_summary import Check, ChecksFailed, check_summary, not_null
from shelfline.sources.schema import (
    CRITICAL_COLUMNS,
    DATE_COLUMN,
    KEY_COLUMNS,
    NUMERIC_COLUMNS,
    REQUIRED_COLUMNS,
    SALES_SCHEMA,
    TEXT_COLUMNS,
)


def read_csv_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns as text under cleaned-up header names.

    Files are split over tasks. ``multi_line`` lets quoted fields hold line breaks
    (without it such a row stops the load); a file is then read by one task, so keep
    files at block size.
    """
    header = spark.read.option("header", True).csv(path).columns
    names = [column_name(c) for c in header]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"header names repeat after clean-up: {repeated}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        # Every file of the folder must carry the header that was just read.
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .option("escape", '"')
    )
    return reader.csv(path).toDF(*names)


def _parsed_date(name: str, date_formats: Sequence[str]) -> Column:
    """The date of an ISO date or timestamp, or else by the first format that fits; a bare time is no date."""
    text = F.trim(F.col(name).cast("string"))
    # A bare day, as most are, is read without the detour over a timestamp.
    day = F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text.try_cast("date"))
    iso = F.when(text.rlike("^[0-9]{4}-"), text.try_cast("timestamp"))
    return F.coalesce(day, F.coalesce(iso, *[F.try_to_timestamp(text, F.lit(f)) for f in date_formats]).cast("date"))


#: What any number is read as to find out the type its column needs.
_WIDEST = T.DecimalType(38, 18)
#: Numbers that decimal(18,2) holds as they are written, as nearly all do.
_PLAIN = r"^[+-]?[0-9]{1,16}(\.[0-9]{1,2})?$"


def _with_digit(text: Column) -> Column:
    """NULL for text that cannot be a number: a failing cast costs far more than the look at it."""
    return F.when(text.rlike("[0-9]"), text)


def number_types(df: DataFrame) -> dict[str, T.DecimalType]:
    """The type that holds every number of each numeric column exactly, found by one aggregate over the text.

    Columns of at most two decimals are decimal(18,2); others get as many decimals as they need, up to 18, and 28 digits
    or, with more, 38. Text that is no number, or none that 38 digits with 18 decimals hold, does not count.
    """
    names = [c for c in NUMERIC_COLUMNS if c in df.columns]
    if not names:
        return {}
    found = []
    for c in names:
        text = F.trim(F.col(c))
        plain = text.rlike(_PLAIN)
        odd = F.abs(F.when(~plain, _with_digit(text)).try_cast(_WIDEST)).cast("string")
        decimals = F.length(F.rtrim(F.split_part(odd, F.lit("."), F.lit(2)), F.lit("0")))
        whole = F.length(F.split_part(odd, F.lit("."), F.lit(1)))
        largest = F.max(F.abs(F.when(plain, text).try_cast(MONEY)))
        plain_whole = F.length(F.split_part(largest.cast("string"), F.lit("."), F.lit(1)))
        found += [F.max(decimals).alias(f"decimals_{c}"), F.greatest(F.max(whole), plain_whole).alias(f"whole_{c}")]
    most = df.agg(*found).first()
    types = {}
    for c in names:
        scale, whole = most[f"decimals_{c}"] or 0, most[f"whole_{c}"] or 0
        if scale <= MONEY.scale and whole <= MONEY.precision - MONEY.scale:
            types[c] = MONEY
        else:
            scale = max(scale, MONEY.scale)
            types[c] = T.DecimalType(28 if whole + scale <= 28 else 38, scale)
    return types


def _parsed(name: str, date_formats: Sequence[str] = (), numbers: dict[str, T.DecimalType] | None = None) -> Column:
    """Typed value, NULL where the text does not parse or does not fit the column exactly."""
    dtype = SALES_SCHEMA[name].dataType
    if isinstance(dtype, T.StringType):
        return F.col(name)
    if isinstance(dtype, T.DateType):
        return _parsed_date(name, date_formats)
    return F.when(~_inexact(name), _with_digit(F.trim(F.col(name))).try_cast((numbers or {}).get(name, dtype)))


def _inexact(name: str) -> Column:
    """Whether a number has more than 18 decimals that are not zero; false where the text is no number."""
    text = F.trim(F.col(name))
    value = F.when(~text.rlike(_PLAIN), _with_digit(text)).try_cast(_WIDEST)
    beyond = F.regexp_extract(text, r"\.[0-9]{18}([0-9]+)$", 1).rlike("[1-9]")
    small = text.rlike("[eE]") & (text.try_cast("double") != value.cast("double"))
    return F.coalesce(value.isNotNull() & (beyond | small), F.lit(False))


def _strict(name: str, date_formats: Sequence[str], numbers: dict[str, T.DecimalType]) -> Column:
    """Typed value; text that does not parse, or would have to be rounded, stops the load."""
    complaint = F.concat(F.lit(f"{name}: cannot read "), F.col(name))
    value = _parsed(name, date_formats, numbers)
    return F.when(F.col(name).isNotNull() & value.isNull(), F.raise_error(complaint)).otherwise(value)


def read_sales(spark: SparkSession, path: str, multi_line: bool = False, date_formats: Sequence[str] = ()) -> DataFrame:
    """The sales table of a CSV file or folder; columns are matched by name.

    ``date_formats`` are tried in order for dates that are not in ISO form. The file is read twice: the first time
    to find the number of decimals that keeps all its numbers unchanged, which the table's schema then has.
    """
    text = read_csv_text(spark, path, multi_line)
    missing = [f.name for f in SALES_SCHEMA if f.name not in text.columns]
    if missing:
        raise ValueError(f"CSV has no column {', '.join(missing)}")
    numbers = number_types(text)
    return text.select(*[_strict(f.name, date_formats, numbers).alias(f.name) for f in SALES_SCHEMA])


def load_sales(
    spark: SparkSession, csv_path: str, table_path: str, multi_line: bool = False, date_formats: Sequence[str] = ()
) -> int:
    """Replace the base table with the content of the CSV; returns its row count."""
    read_sales(spark, csv_path, multi_line, date_formats).write.mode("overwrite").parquet(table_path)
    return spark.read.parquet(table_path).count()


def validate_load(sales: DataFrame) -> DataFrame:
    """One row: row count, required columns present, verdict."""
    present = len(set(REQUIRED_COLUMNS) & set(sales.columns))
    return sales.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(present).alias("required_columns_present"),
        F.when((F.col("row_count") > 0) & F.lit(present == len(REQUIRED_COLUMNS)), "passed")
        .otherwise("failed")
        .alias("validation"),
    )


def source_checks() -> list[Check]:
    """Checks that a loaded table must pass before anything is built from it."""
    return [not_null(c) for c in KEY_COLUMNS]


def require_valid_load(sales: DataFrame, wanted: Sequence[Check] | None = None) -> int:
    """Raise when the table is empty, lacks a required column or fails a source check; returns its row count.

    The rows are counted and checked in one scan.
    """
    missing = sorted(set(REQUIRED_COLUMNS) - set(sales.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    gate = list(source_checks() if wanted is None else wanted)
    rows_of_table = Check("rows", F.lit(0), F.count(F.lit(1)))
    found = check_summary(sales, [rows_of_table, *gate]).collect()
    rows = next(int(r["measure"]) for r in found if r["check_name"] == "rows")
    if rows == 0:
        raise ValueError("the sales table is empty")
    if failed := [(r["check_name"], r["failures"]) for r in found if r["verdict"] == "error"]:
        raise ChecksFailed(failed)
    return rows


def clean_text_columns(df: DataFrame) -> DataFrame:
    """Header names cleaned up; line breaks and runs of blanks removed from text fields."""
    named = df.toDF(*[column_name(c) for c in df.columns])
    return named.withColumns({c: tidy(F.col(c)) for c in TEXT_COLUMNS if c in named.columns})


def with_reject_reason(df: DataFrame, date_formats: Sequence[str] = ()) -> DataFrame:
    """Typed columns plus ``reject_reason``, NULL for rows worth keeping.

    A number that does not parse counts as missing, as a missing one does; numbers keep all their decimals (see
    ``number_types``), and one of more than 18 rejects its row. Without a date column no row is rejected for its date.
    """
    types = number_types(df)
    numbers = list(types)
    has_date = DATE_COLUMN in df.columns
    reasons = [(_parsed(DATE_COLUMN, date_formats).isNull(), "invalid date")] if has_date else []
    reasons += [(_inexact(c), f"inexact {c}") for c in numbers]
    reasons += [((_parsed(c, numbers=types) if c in numbers else F.col(c)).isNull(), f"missing {c}") for c in CRITICAL_COLUMNS if c in df.columns]
    reason = F.coalesce(*[F.when(wrong, text) for wrong, text in reasons], F.lit(None).cast("string"))
    typed = {c: _parsed(c, date_formats, types) for c in [*numbers, *([DATE_COLUMN] if has_date else [])]}
    return df.withColumns({"reject_reason": reason} | typed)


def coerce_and_drop_invalid(df: DataFrame, date_formats: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows kept, rows rejected with their reason)."""
    judged = with_reject_reason(df, date_formats)
    return (
        judged.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
        judged.filter(F.col("reject_reason").isNotNull()),
    )


def reject_counts(df: DataFrame, date_formats: Sequence[str] = ()) -> DataFrame:
    """Number of rows removed per reason."""
    _, rejected = coerce_and_drop_invalid(df, date_formats)
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows_removed"))


def load_profile(sales: DataFrame) -> DataFrame:
    """Rows, date range, stores, suppliers and total sales in one line.

    The rows are first reduced to store x supplier, so the distinct counts run
    over that small result instead of expanding every sale.
    """
    pairs = sales.groupBy("Store_Name", "Supplier").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("Date_Of_Sale").alias("first_date"),
        F.max("Date_Of_Sale").alias("last_date"),
        F.sum("Total_Sales").alias("sales"),
    )
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        F.count_distinct("Store_Name").alias("unique_stores"),
        F.count_distinct("Supplier").alias("unique_suppliers"),
        F.sum("sales").alias("total_sales"),
    )
