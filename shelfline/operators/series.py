"""Number series, date spines and gap filling."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_MONTHS = {"month": 1, "quarter": 3, "year": 12}
_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """1 .. ``upper_bound``, generated in parallel."""
    if upper_bound <= 0:
        raise ValueError("upper_bound must be positive")
    return spark.range(1, upper_bound + 1).select(F.col("id").alias("generated_number"))


def timestamp_literal(value: date | datetime) -> Column:
    """A wall-clock literal that no time zone setting shifts."""
    return F.lit(value.isoformat()).cast("timestamp_ntz")


def _advance(start: Column, datepart: str, steps: Column) -> Column:
    if datepart in _MONTHS:
        return start + F.make_ym_interval(F.lit(0), (steps * _MONTHS[datepart]).cast("int"))
    return start + F.make_dt_interval(secs=(steps * _SECONDS[datepart]).cast("decimal(18,6)"))


def date_spine(spark: SparkSession, datepart: str, start: date | datetime, end: date | datetime) -> DataFrame:
    """One row per ``datepart`` from ``start`` (included) to ``end`` (excluded)."""
    if datepart not in _MONTHS and datepart not in _SECONDS:
        raise ValueError(f"unknown datepart {datepart!r}")
    if end <= start:
        raise ValueError("end must lie after start")
    if datepart in _MONTHS:
        months = (end.year - start.year) * 12 + end.month - start.month
        steps = months // _MONTHS[datepart] + 1
    else:
        steps = int((end - start).total_seconds() // _SECONDS[datepart]) + 1
    first = timestamp_literal(start)
    name = f"date_{datepart}"
    spine = spark.range(steps).select(_advance(first, datepart, F.col("id")).alias(name))
    return spine.filter(F.col(name) < timestamp_literal(end))


def gap_filled(
    df: DataFrame, at: str, datepart: str, aggregates: dict[str, Column], start: date | datetime, end: date | datetime
) -> DataFrame:
    """Aggregates per ``datepart``; periods without rows are present with zeros."""
    name = f"date_{datepart}"
    per_period = df.groupBy(F.date_trunc(datepart, at).cast("timestamp_ntz").alias(name)).agg(
        *[value.alias(column) for column, value in aggregates.items()]
    )
    spine = date_spine(df.sparkSession, datepart, start, end)
    return spine.join(per_period, name, "left").fillna(0, subset=list(aggregates))
