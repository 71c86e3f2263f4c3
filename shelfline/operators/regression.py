"""Straight-line regression per group from moments that can be merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.functions.numeric import half_up

MOMENTS = ["n", "sum_x", "sum_y", "sum_xx", "sum_xy", "sum_yy"]


def moments(df: DataFrame, keys: list[str], x: str, y: str, scale: int = 2) -> DataFrame:
    """Exact sums of ``x``, ``y`` and their products per group, over rows that have both; values count to ``scale`` decimals.

    Decimal sums do not depend on the order of rows, and sums of groups are the sums of the group above them.
    """
    a, b = (half_up(F.col(c).cast("double"), scale).cast(f"decimal(16,{scale})") for c in (x, y))
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*keys, a.alias("__x"), b.alias("__y"))
    values = [F.lit(1).cast("bigint"), F.col("__x"), F.col("__y"), F.col("__x") * F.col("__x"), F.col("__x") * F.col("__y"), F.col("__y") * F.col("__y")]
    return both.groupBy(*keys).agg(*[F.sum(v).alias(name) for v, name in zip(values, MOMENTS, strict=True)])


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The moments of coarser groups."""
    return parts.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in MOMENTS])


def _spread(product: str, one: str, two: str) -> Column:
    """n times the sum of products of deviations from the means."""
    return F.col("n").cast("double") * F.col(product).cast("double") - F.col(one).cast("double") * F.col(two).cast("double")


def solved(sums: DataFrame) -> DataFrame:
    """Replaces the moments by ``n``, ``slope``, ``intercept`` and ``r2``.

    Without two different ``x`` all three are NULL; if ``y`` is constant, ``r2`` is 1, as SQL has it.
    """
    xx, yy, xy = _spread("sum_xx", "sum_x", "sum_x"), _spread("sum_yy", "sum_y", "sum_y"), _spread("sum_xy", "sum_x", "sum_y")
    n = F.col("n").cast("double")
    slope = F.try_divide(xy, xx)
    keys = [c for c in sums.columns if c not in MOMENTS]
    return sums.select(
        *keys, "n", slope.alias("slope"),
        ((F.col("sum_y").cast("double") - slope * F.col("sum_x").cast("double")) / n).alias("intercept"),
        F.when(xx == 0, F.lit(None)).when(yy == 0, 1.0).otherwise(F.try_divide(xy * xy, xx * yy)).alias("r2"),
    )
