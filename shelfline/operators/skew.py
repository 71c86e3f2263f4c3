"""Joins of groups whose keys may be NULL, and groups too large for one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from shelfline.session import stage_table

#: Most rows of a group that one task takes whole; larger groups are spread over tasks.
WHOLE_ROWS = 100_000


def keyed_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equality join on ``keys`` in which NULL matches NULL; keeps the left keys."""
    renamed = {k: f"__right_{k}" for k in keys}
    matches = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(other)) for k, other in renamed.items()])
    joined = left.join(right.withColumnsRenamed(renamed), matches, how)
    return joined.drop(*renamed.values())


def large_groups(df: DataFrame, keys: list[str], most: int | None = None) -> DataFrame | None:
    """The keys of groups of more than ``most`` rows (``WHOLE_ROWS``), written; None if there are none.

    Rows are counted before the shuffle, and there are fewer such groups than rows / ``most``.
    """
    most = WHOLE_ROWS if most is None else most
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows")).filter(F.col("group_rows") > most)
    found = stage_table(counts.select(*keys), "large-groups")
    return None if found.isEmpty() else found


def whole_and_spread(df: DataFrame, keys: list[str], large: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of groups that fit a task, dealt out by ``keys``; rows of the ``large`` groups where they are, None without any).

    What follows on the first and works by ``keys``, or by more columns, needs no other shuffle.
    """
    if large is None:
        return df.repartition(*keys), None
    return keyed_join(df, large, keys, "left_anti").repartition(*keys), keyed_join(df, large, keys, "left_semi")
