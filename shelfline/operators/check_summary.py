"""Many checks of a table measured in one scan, with limits for a warning and an error.

A check is a pair of aggregates: the number of its failures and, where it has one, a measure
(a share, a count). ``check_summary`` puts all checks of a table into one aggregation;
``observed`` takes the same numbers while the table is written for something else. Checks
that need rows beside each other (order, other tables) are measured from their failing rows.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from shelfline.operators import checks
from shelfline.operators.series import timestamp_literal

_LIMIT = re.compile(r"\s*(<=|>=|!=|=|<|>)\s*(-?\d+)\s*$")
_COMPARE = {"<=": operator.le, ">=": operator.ge, "!=": operator.ne, "=": operator.eq, "<": operator.lt, ">": operator.gt}
SCHEMA = "check_name string, failures bigint, measure double, verdict string"


def _exceeds(limit: str, value):
    """Whether the number of failures, a column or an int, lies in ``limit`` (like "> 0")."""
    found = _LIMIT.match(limit)
    if not found:
        raise ValueError(f"a limit is a comparison with a whole number, not {limit!r}")
    return _COMPARE[found[1]](value, int(found[2]))


@dataclass(frozen=True)
class Check:
    """``failures`` and ``measure`` are aggregates over the checked table."""

    name: str
    failures: Column
    measure: Column | None = None
    error_if: str = "!= 0"
    warn_if: str = "!= 0"
    #: False for aggregates that Spark cannot observe (distinct counts).
    observable: bool = True

    def __post_init__(self) -> None:
        for limit in (self.error_if, self.warn_if):
            _exceeds(limit, 0)

    def limits(self, error_if: str | None = None, warn_if: str | None = None) -> Check:
        """The check with other limits; an error outranks a warning."""
        return replace(self, error_if=error_if or self.error_if, warn_if=warn_if or self.warn_if)

    def aggregates(self, number: int) -> list[Column]:
        measure = F.max(F.lit(None)) if self.measure is None else self.measure
        return [F.coalesce(self.failures, F.lit(0)).cast("bigint").alias(f"failures_{number}"), measure.cast("double").alias(f"measure_{number}")]

    def verdict(self, failures: Column) -> Column:
        return F.when(_exceeds(self.error_if, failures), "error").when(_exceeds(self.warn_if, failures), "warn").otherwise("pass")


# ---------------------------------------------------------------- checks in one aggregation


def rows_failing(name: str, condition: Column) -> Check:
    """Rows for which the condition is true; the measure is their share."""
    failures = F.count_if(condition)
    return Check(name, failures, F.try_divide(failures.cast("double"), F.count(F.lit(1))))


def not_null(column: str) -> Check:
    return rows_failing(f"not_null_{column}", F.col(column).isNull())


def accepted_values(column: str, values: list) -> Check:
    return rows_failing(f"accepted_values_{column}", ~F.col(column).isin(values))


def not_accepted_values(column: str, values: list) -> Check:
    return rows_failing(f"not_accepted_values_{column}", F.col(column).isin(values))


def accepted_range(column: str, minimum: Column | float | None = None, maximum: Column | float | None = None, inclusive: bool = True) -> Check:
    return rows_failing(f"accepted_range_{column}", checks.outside_range(column, minimum, maximum, inclusive))


def not_empty_string(column: str, trim: bool = True) -> Check:
    return rows_failing(f"not_empty_string_{column}", (F.trim(F.col(column)) if trim else F.col(column)) == "")


def expression_is_true(name: str, expression: str) -> Check:
    return rows_failing(name, ~F.expr(expression))


def values_equal(actual: str, expected: str) -> Check:
    return rows_failing(f"values_equal_{actual}", F.col(actual) != F.col(expected))


def at_least_one(column: str) -> Check:
    """One failure if the column is NULL throughout; the measure is the number of filled rows."""
    filled = F.count(column)
    return Check(f"at_least_one_{column}", F.when(filled == 0, 1).otherwise(0), filled)


def not_constant(column: str) -> Check:
    """One failure if all filled rows hold one value."""
    return Check(f"not_constant_{column}", F.when(F.min(column) == F.max(column), 1).otherwise(0))


def not_null_proportion(column: str, at_least: float, at_most: float = 1.0) -> Check:
    share = F.try_divide(F.count(column).cast("double"), F.count(F.lit(1)))
    return Check(f"not_null_proportion_{column}", F.when((share < at_least) | (share > at_most), 1).otherwise(0), share)


def recency(field: str, oldest: datetime) -> Check:
    """One failure if the newest row is older than ``oldest``; the measure is how many seconds it is newer."""
    newest, limit = F.max(field).cast("timestamp_ntz"), timestamp_literal(oldest).cast("timestamp_ntz")
    return Check(f"recency_{field}", F.when(newest < limit, 1).otherwise(0), F.timestamp_diff("SECOND", limit, newest))


def unique(*columns: str) -> Check:
    """Rows beyond the first of their combination (rows with a NULL in a single column are not compared); the measure is the number of combinations."""
    value = F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)
    return Check(f"unique_{'_'.join(columns)}", F.count(value) - F.count_distinct(value), F.count_distinct(value), observable=False)


def fewer_rows_than(other_rows: Column) -> Check:
    """``other_rows``: a scalar, such as ``other.select(F.count("*")).scalar()``. Equal counts are one failure, as in the row check."""
    surplus = F.count(F.lit(1)) - F.max(other_rows)
    return Check("fewer_rows_than", F.when(surplus == 0, 1).when(surplus > 0, surplus).otherwise(0), F.count(F.lit(1)), observable=False)


def equal_rowcount(other_rows: Column) -> Check:
    return Check("equal_rowcount", F.abs(F.count(F.lit(1)) - F.max(other_rows)), F.count(F.lit(1)), observable=False)


# ---------------------------------------------------------------- summaries


def _named(wanted: list[Check]) -> None:
    names = [c.name for c in wanted]
    if not names or len(set(names)) < len(names):
        raise ValueError(f"checks need distinct names: {names}")


def check_summary(df: DataFrame, wanted: list[Check]) -> DataFrame:
    """One row per check: ``check_name``, ``failures``, ``measure``, ``verdict`` (pass, warn or error). ``df`` is scanned once.

    An empty table has no failing rows; checks of the whole table judge it by their definition.
    """
    _named(wanted)
    numbers = df.agg(*[a for i, c in enumerate(wanted) for a in c.aggregates(i)])
    rows = [
        F.struct(
            F.lit(c.name).alias("check_name"), F.col(f"failures_{i}").alias("failures"), F.col(f"measure_{i}").alias("measure"),
            c.verdict(F.col(f"failures_{i}")).alias("verdict"),
        )
        for i, c in enumerate(wanted)
    ]
    return numbers.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def measured(name: str, failing: DataFrame, failures: Column | None = None, measure: Column | None = None, error_if: str = "!= 0", warn_if: str = "!= 0") -> DataFrame:
    """The summary row of a check that returns failing rows, such as those of ``checks``; ``failures`` replaces their count."""
    count = F.count(F.lit(1)) if failures is None else failures
    return check_summary(failing, [Check(name, count, measure, error_if, warn_if)])


def observed(df: DataFrame, wanted: list[Check]) -> tuple[DataFrame, Observation]:
    """``df`` with the numbers of the checks collected by whatever job reads it next; ``verdicts`` turns them into rows."""
    _named(wanted)
    if unfit := [c.name for c in wanted if not c.observable]:
        raise ValueError(f"distinct counts and other tables cannot be observed: {unfit}")
    observation = Observation()
    return df.observe(observation, *[a for i, c in enumerate(wanted) for a in c.aggregates(i)]), observation


def verdicts(spark: SparkSession, wanted: list[Check], observation: Observation) -> DataFrame:
    """The rows of ``check_summary``, from numbers observed in a job that has ended."""
    return spark.createDataFrame(_judged(wanted, observation), SCHEMA)


class ChecksFailed(ValueError):
    """A table that has errors; ``failed`` holds (name, failures) of each."""

    def __init__(self, failed: Iterable[tuple[str, int]]) -> None:
        self.failed = list(failed)
        super().__init__("checks failed: " + ", ".join(f"{name} ({n})" for name, n in self.failed))


def require(wanted: list[Check], observation: Observation) -> None:
    """Raise if an observed check is an error."""
    if failed := [(name, failures) for name, failures, _, verdict in _judged(wanted, observation) if verdict == "error"]:
        raise ChecksFailed(failed)


def _judged(wanted: list[Check], observation: Observation) -> list[tuple[str, int, float | None, str]]:
    found, out = observation.get, []
    for i, check in enumerate(wanted):
        n = found[f"failures_{i}"]
        verdict = "error" if _exceeds(check.error_if, n) else "warn" if _exceeds(check.warn_if, n) else "pass"
        out.append((check.name, n, found[f"measure_{i}"], verdict))
    return out
