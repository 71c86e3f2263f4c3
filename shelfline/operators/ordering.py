"""Neighbouring rows and ranks in a group's total order, for groups of any size.

Equal rows are collapsed to one with a count and the distinct rows dealt out in slices of
the total order. Inside a slice the neighbour is a window function; the row at a slice's
end takes the edge row of the nearest slice that has rows of its group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.operators.skew import keyed_join
from shelfline.operators.slices import counted, in_slices, repeated, starts, with_before
from shelfline.session import stage_table


def distinct_with_neighbour(
    df: DataFrame, keys: list[str], order: list[str], carry: list[str], following: bool = True
) -> DataFrame:
    """The distinct rows of ``df`` with ``copies`` and ``neighbour``: a struct of the ``carry`` columns
    of the next (or previous) other row of the group by ``order`` ascending, NULLs last; NULL where there is none.

    Rows equal in ``order`` follow each other by their other columns.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    full = [F.col(c).asc_nulls_last() for c in (*order, *rest)]
    sliced = in_slices(counted(df, df.columns), [*[F.col(c).asc_nulls_last() for c in keys], *full], "neighbour")
    here = Window.partitionBy(*keys, "slice").orderBy(*full)
    step = F.lead if following else F.lag
    inside = sliced.withColumn("neighbour", step(F.struct(*carry)).over(here))

    # One row per group and slice; NULLs last, as in the order.
    sort_key = F.struct(*[part for c in (*order, *rest) for part in (F.col(c).isNull(), F.col(c))])
    edge = F.min_by if following else F.max_by
    edges = sliced.groupBy(*keys, "slice").agg(edge(F.struct(*carry), sort_key).alias("edge"))
    along = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("slice")
    beyond = edges.select(*keys, "slice", step("edge").over(along).alias("edge"))
    if not keys:
        # One row per slice; written, so that their window is no part of the plan over all rows.
        beyond = stage_table(beyond, "slice-edges")
    joined = keyed_join(inside, beyond, [*keys, "slice"])
    return joined.select(*df.columns, "copies", F.coalesce("neighbour", "edge").alias("neighbour"))


def with_neighbour(
    df: DataFrame, keys: list[str], order: list[str], carry: list[str], following: bool = True
) -> DataFrame:
    """Adds ``neighbour`` to every row, copies included: a copy's neighbour is the next copy, the last one's the next other row."""
    found = distinct_with_neighbour(df, keys, order, carry, following)
    columns = [*df.columns, "neighbour"]
    edges = found.select(*columns)
    copies = repeated(found.withColumn("neighbour", F.struct(*carry)).select(*columns, "copies"), F.col("copies") - 1)
    return edges.unionByName(copies.select(*columns))


def with_rank(df: DataFrame, column: str, name: str) -> DataFrame:
    """Adds the rank of ``column`` over all rows as a bigint, the largest first and NULLs last.

    ``df`` should be a table.
    """
    falling = [F.col(column).desc_nulls_last()]
    sliced = in_slices(counted(df.select(column), [column]), falling, "rank")
    beginnings = stage_table(starts(sliced, []), "rank-starts")
    ranks = with_before(sliced, beginnings, [], falling).select(column, (F.col("before") + 1).alias(name))
    return keyed_join(df, ranks, [column])
