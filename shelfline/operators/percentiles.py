"""Exact interpolated percentiles, for groups of any size.

Groups of up to ``WHOLE_ROWS`` rows meet in one task after a single shuffle of the measures.
Larger ones, and the whole table, go by distributed selection: the values of a group are counted,
dealt out in slices of the total order (group, measure, value) and the counts summed per slice. The
sums tell which slice holds a wanted rank; only those slices are ranked. No task holds more of a
group than that many rows or a slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.operators.skew import keyed_join, large_groups, whole_and_spread
from shelfline.operators.slices import counted, in_slices, starts, with_before
from shelfline.session import stage_table


def percentile_summary(
    df: DataFrame, keys: list[str], percentiles: dict[str, tuple[str, float]], aggregates: list[Column]
) -> DataFrame:
    """Group by ``keys``: one column per percentile and per extra aggregate.

    ``percentiles`` maps output name to (numeric column, fraction). ``df`` is
    scanned twice and should be a table. A group whose values are all NULL has NULL
    percentiles; without keys there is always one row.
    """
    if not keys:
        return _spread(df, keys, percentiles, aggregates)
    large = large_groups(df, keys)
    whole, spread = whole_and_spread(df, keys, large)
    columns, found = percentile_columns(percentiles)
    grouped = whole.groupBy(*keys).agg(*aggregates, *[c.alias(held) for held, c in columns.items()])
    summary = grouped.withColumns(found).drop(*columns)
    return summary if spread is None else summary.unionByName(_spread(spread, keys, percentiles, aggregates))


def percentile_columns(percentiles: dict[str, tuple[str, float]]) -> tuple[dict[str, Column], dict[str, Column]]:
    """For groups that fit a task: aggregates that find all fractions of a column at once, and the percentiles taken from them."""
    fractions = {column: sorted({f for c, f in percentiles.values() if c == column}) for column, _ in percentiles.values()}
    held = {
        f"percentiles_of_{column}": F.percentile(F.col(column).cast("double"), F.array(*[F.lit(f) for f in wanted]))
        for column, wanted in fractions.items()
    }
    found = {name: F.get(f"percentiles_of_{c}", F.lit(fractions[c].index(f))) for name, (c, f) in percentiles.items()}
    return held, found


def _spread(
    df: DataFrame, keys: list[str], percentiles: dict[str, tuple[str, float]], aggregates: list[Column]
) -> DataFrame:
    """The same by selection."""
    grouped = df.groupBy(*keys).agg(*(aggregates or [F.count(F.lit(1)).alias("group_rows")]))
    found = _selected(df, keys, percentiles)
    if keys:
        joined = keyed_join(grouped, found, keys, "left")
        return joined if aggregates else joined.drop("group_rows")
    one = found.select(F.struct("*").alias("found")).scalar()
    return (grouped if aggregates else grouped.drop("group_rows")).select("*", *[one.getField(name).alias(name) for name in percentiles])


def _selected(df: DataFrame, keys: list[str], percentiles: dict[str, tuple[str, float]]) -> DataFrame:
    columns = sorted({column for column, _ in percentiles.values()})
    fractions = sorted({fraction for _, fraction in percentiles.values()})
    group = [*keys, "measure"]

    values = F.explode(
        F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in columns])
    )
    long = df.select(*keys, values.alias("m")).select(*keys, "m.measure", "m.value").filter(F.col("value").isNotNull())
    sliced = in_slices(counted(long, [*group, "value"]), [F.col(c).asc_nulls_last() for c in (*group, "value")], "percentile")
    ranks = {f: F.lit(f) * (F.col("total") - 1) for f in fractions}

    holds_any = F.lit(False)
    for rank in ranks.values():
        for wanted in (F.floor(rank), F.ceil(rank)):
            holds_any = holds_any | ((wanted >= F.col("start")) & (wanted < F.col("start") + F.col("size")))
    chosen = stage_table(starts(sliced, group).filter(holds_any), "percentile-slices")
    ranked = with_before(sliced, chosen, group, [F.col("value")])

    def value_at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("before")) & (rank < F.col("before") + F.col("copies")), F.col("value")))

    low_high = [
        column
        for i, rank in enumerate(ranks.values())
        for column in (value_at(F.floor(rank)).alias(f"low_{i}"), value_at(F.ceil(rank)).alias(f"high_{i}"))
    ]
    found = ranked.groupBy(*group).agg(F.max("total").alias("total"), *low_high)

    def interpolated(i: int, rank: Column) -> Column:
        low, high = F.col(f"low_{i}"), F.col(f"high_{i}")
        between = (F.ceil(rank) - rank) * low + (rank - F.floor(rank)) * high
        return F.when(low == high, low).otherwise(between)

    per_measure = found.select(*group, *[interpolated(i, r).alias(f"p_{i}") for i, r in enumerate(ranks.values())])
    return per_measure.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("measure") == column, F.col(f"p_{fractions.index(fraction)}"))).alias(name)
            for name, (column, fraction) in percentiles.items()
        ]
    )
