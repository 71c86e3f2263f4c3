"""Table checks: each returns the failing rows, so an empty result is a pass."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfline.operators.ordering import with_neighbour
from shelfline.operators.series import timestamp_literal


def passed(failing: DataFrame) -> bool:
    return failing.isEmpty()


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated values; NULLs are not compared."""
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Combinations that occur more than once."""
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter(F.col("n_records") > 1)


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list with their row counts; a NULL passes."""
    return df.filter(~F.col(column).isin(values)).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def not_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Forbidden values that occur."""
    return df.filter(F.col(column).isin(values)).select(column).distinct()


def outside_range(
    column: str, minimum: Column | float | None = None, maximum: Column | float | None = None, inclusive: bool = True
) -> Column:
    """Whether the value lies outside the range; NULL for a NULL value."""
    if minimum is None and maximum is None:
        raise ValueError("give a minimum or a maximum")
    value, outside = F.col(column), F.lit(False)
    if minimum is not None:
        outside = outside | ((value < minimum) if inclusive else (value <= minimum))
    if maximum is not None:
        outside = outside | ((value > maximum) if inclusive else (value >= maximum))
    return outside


def accepted_range(
    df: DataFrame, column: str, minimum: Column | float | None = None, maximum: Column | float | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Rows outside the range; a NULL passes."""
    return df.filter(outside_range(column, minimum, maximum, inclusive))


def at_least_one(df: DataFrame, column: str, group_by: list[str] | None = None) -> DataFrame:
    """Groups in which the column is NULL throughout."""
    filled = df.groupBy(*(group_by or [])).agg(F.count(column).alias("filled_rows"))
    return filled.filter(F.col("filled_rows") == 0)


def not_constant(df: DataFrame, column: str, group_by: list[str] | None = None) -> DataFrame:
    """Groups with exactly one value.

    Two values that differ are all it takes, so the minimum and the maximum
    replace a distinct count.
    """
    ends = df.groupBy(*(group_by or [])).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    return ends.filter(F.col("low") == F.col("high")).select(*(group_by or []), F.lit(1).alias("distinct_values"))


def not_empty_string(df: DataFrame, column: str, trim: bool = True) -> DataFrame:
    value = F.trim(F.col(column)) if trim else F.col(column)
    return df.filter(value == "")


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: list[str] | None = None
) -> DataFrame:
    """Groups whose share of filled rows lies outside the bounds."""
    share = df.groupBy(*(group_by or [])).agg(
        F.try_divide(F.count(column).cast("double"), F.count(F.lit(1))).alias("not_null_proportion")
    )
    value = F.col("not_null_proportion")
    return share.filter((value < at_least) | (value > at_most))


def recency(
    df: DataFrame, field: str, oldest: datetime, ignore_time: bool = False, group_by: list[str] | None = None
) -> DataFrame:
    """Groups whose newest row is older than ``oldest`` (now minus the allowed interval)."""
    newest, threshold = F.max(field), timestamp_literal(oldest)
    if ignore_time:
        newest, threshold = newest.cast("date"), threshold.cast("date")
    latest = df.groupBy(*(group_by or [])).agg(newest.alias("most_recent"))
    return latest.withColumn("threshold", threshold).filter(F.col("most_recent") < F.col("threshold"))


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    """Rows where the SQL expression is false; with ``column`` it continues that column's name."""
    condition = F.expr(f"`{column}` {expression}" if column else expression)
    return df.filter(~condition)


def values_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows where the two columns differ; NULL on either side passes."""
    return df.filter(F.col(actual) != F.col(expected))


def cardinality_equality(df: DataFrame, column: str, other: DataFrame, field: str) -> DataFrame:
    """Values whose row count differs between two columns, with the count on the side that has it."""
    tagged = df.select(F.col(column).alias("value"), F.lit(1).alias("ours"), F.lit(0).alias("theirs")).unionAll(
        other.select(F.col(field), F.lit(0), F.lit(1))
    )
    counts = tagged.groupBy("value").agg(F.sum("ours").alias("ours"), F.sum("theirs").alias("theirs"))
    sides = F.array(F.col("ours"), F.col("theirs"))
    return (
        counts.filter(F.col("ours") != F.col("theirs"))
        .select("value", F.explode(sides).alias("num_rows"))
        .filter(F.col("num_rows") > 0)
    )


def _paired_counts(df: DataFrame, other: DataFrame, group_by: list[str], names: tuple[str, str]) -> DataFrame:
    """Row counts per group side by side, NULL where a side lacks the group."""
    ours = df.groupBy(*group_by).agg(F.count(F.lit(1)).alias(names[0]))
    theirs = other.groupBy(*group_by).agg(F.count(F.lit(1)).alias(names[1]))
    if not group_by:
        return ours.withColumn(names[1], theirs.scalar())
    return ours.join(theirs, group_by, "full_outer")


def equal_rowcount(df: DataFrame, other: DataFrame, group_by: list[str] | None = None) -> DataFrame:
    """Groups with different row counts; a group only one side has is not compared."""
    counts = _paired_counts(df, other, group_by or [], ("count_a", "count_b"))
    difference = F.abs(F.col("count_a") - F.col("count_b"))
    return counts.withColumn("diff_count", difference).filter(F.col("diff_count") != 0)


def fewer_rows_than(df: DataFrame, other: DataFrame, group_by: list[str] | None = None) -> DataFrame:
    """Groups that do not have strictly fewer rows than in ``other``."""
    counts = _paired_counts(df, other, group_by or [], ("count_our_model", "count_comparison_model"))
    ours, theirs = F.col("count_our_model"), F.col("count_comparison_model")
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, 1).otherwise(0)
    return counts.withColumn("row_count_delta", delta.cast("bigint")).filter(F.col("row_count_delta") > 0)


def equality(
    df: DataFrame, other: DataFrame, columns: list[str] | None = None, strict: bool = False
) -> DataFrame:
    """Rows of one side the other lacks, labelled with the side that has them.

    One aggregation over both tables compares them; ``strict`` also compares how
    often a row occurs and repeats it by the surplus.
    """
    names = columns or df.columns
    both = df.select(*names, F.lit(1).alias("__a"), F.lit(0).alias("__b")).unionAll(
        other.select(*names, F.lit(0), F.lit(1))
    )
    counts = both.groupBy(*names).agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
    side = F.when(F.col("__a") > F.col("__b"), "a_minus_b").otherwise("b_minus_a").alias("side")
    if not strict:
        return counts.filter((F.col("__a") == 0) | (F.col("__b") == 0)).select(side, *names)
    surplus = F.abs(F.col("__a") - F.col("__b")).cast("int")
    return counts.filter(surplus > 0).select(side, *names, F.explode(F.array_repeat(F.lit(1), surplus))).drop("col")


def relationships_where(
    child: DataFrame, column: str, parent: DataFrame, field: str, child_where: str = "true", parent_where: str = "true"
) -> DataFrame:
    """Child values without a parent."""
    ids = child.filter(child_where).filter(F.col(column).isNotNull()).select(F.col(column).alias("from_id"))
    parents = parent.filter(parent_where).select(F.col(field).alias("to_id"))
    return ids.join(parents, F.col("from_id") == F.col("to_id"), "left_anti")


def sequential_values(
    df: DataFrame, column: str, interval: int = 1, datepart: str | None = None, group_by: list[str] | None = None
) -> DataFrame:
    """Rows whose value is not the previous one plus the interval; the first row passes."""
    keys = group_by or []
    narrow = df.select(*keys, column)
    found = with_neighbour(narrow, keys, [column], [column], following=False)
    previous = F.col("neighbour").getField(column)
    value, expected = F.col(column), previous + interval
    if datepart:
        value = value.cast("timestamp_ntz")
        expected = F.timestamp_add(datepart.upper(), F.lit(interval), previous.cast("timestamp_ntz"))
    return found.filter(value != expected).select(*keys, column, previous.alias(f"previous_{column}"))


def mutually_exclusive_ranges(
    df: DataFrame, lower: str, upper: str, partition_by: str | None = None, gaps: str = "allowed",
    zero_length_allowed: bool = False,
) -> DataFrame:
    """Ranges that are empty, reversed, or in conflict with the next one."""
    if gaps not in ("allowed", "not_allowed", "required"):
        raise ValueError("gaps must be 'allowed', 'not_allowed' or 'required'")
    keys = [partition_by] if partition_by else []
    narrow = df.select(*keys, F.col(lower).alias("lower_bound"), F.col(upper).alias("upper_bound"))
    found = with_neighbour(narrow, keys, ["lower_bound", "upper_bound"], ["lower_bound"])
    low, high = F.col("lower_bound"), F.col("upper_bound")
    following = F.col("neighbour.lower_bound")
    well_formed = (low <= high) if zero_length_allowed else (low < high)
    in_step = {"allowed": high <= following, "not_allowed": high == following, "required": high < following}[gaps]
    last = F.col("neighbour").isNull()
    holds = F.coalesce(well_formed, F.lit(False)) & F.coalesce(in_step, last, F.lit(False))
    return found.filter(~holds).select(*keys, "lower_bound", "upper_bound", following.alias("next_lower_bound"))


def columns_match_set(spark: SparkSession, df: DataFrame, expected: list[str]) -> DataFrame:
    """Column names only one side has."""
    actual = {c.lower() for c in df.columns}
    wanted = {c.lower() for c in expected}
    rows = [(c, "unexpected") for c in sorted(actual - wanted)] + [(c, "missing") for c in sorted(wanted - actual)]
    return spark.createDataFrame(rows, "column_name string, problem string")
