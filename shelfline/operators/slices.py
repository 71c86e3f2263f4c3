"""Total orders over groups of any size: range partitions as slices, and what stands before them.

Rows that must be looked at in order are first collapsed to distinct rows with a count,
then dealt out by range of the full key. A slice is one such range; equal rows never
part and no group needs to fit into a slice, so a group that holds all rows is spread
over all slices. What a slice must know of the slices before it is one row per group
and slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from shelfline.operators.skew import keyed_join
from shelfline.session import stage_table

#: Rows that one slice holds on average, where the session's shuffle partitions would give larger ones.
SLICE_ROWS = 1_000_000
#: Copies of one row that a task writes out before the next task takes over.
_COPIES = 100_000


def in_slices(distinct: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows of ``distinct`` with ``slice``, a number that never falls along ``order``; written.

    ``order`` should be a total order: rows equal in it stay in one slice.
    """
    spark = distinct.sparkSession
    written = Observation()
    table = stage_table(distinct.observe(written, F.count(F.lit(1)).alias("rows")), f"{name}-rows")
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-written.get["rows"] // SLICE_ROWS))
    return stage_table(table.repartitionByRange(slices, *order).withColumn("slice", F.spark_partition_id()), f"{name}-slices")


def starts(sliced: DataFrame, keys: list[str], copies: str = "copies") -> DataFrame:
    """For every group and slice with rows of it: ``size``, the copies inside, ``start``, those in slices before, and ``total``, those of the group.

    A window holds at most one row per slice.
    """
    group = Window.partitionBy(*(keys or [F.lit(0)]))
    sizes = sliced.groupBy(*keys, "slice").agg(F.sum(copies).alias("size"))
    before = F.sum("size").over(group.orderBy("slice")) - F.col("size")
    return sizes.withColumn("start", before).withColumn("total", F.sum("size").over(group))


def with_before(sliced: DataFrame, beginnings: DataFrame, keys: list[str], order: list[Column], copies: str = "copies") -> DataFrame:
    """Adds ``before``, the copies of the group's rows that come before the row, and ``total``. Rows of slices not in ``beginnings`` are left out.

    ``beginnings`` are rows of ``starts`` and should be a table.
    """
    inside = Window.partitionBy(*keys, "slice").orderBy(*order)
    return (
        keyed_join(sliced, beginnings.select(*keys, "slice", "start", "total"), [*keys, "slice"])
        .withColumn("before", F.col("start") + F.sum(copies).over(inside) - F.col(copies))
        .drop("start")
    )


def counted(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows of ``columns`` with ``copies``, the number of times they occur; counted before the shuffle."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))


def repeated(df: DataFrame, copies: Column) -> DataFrame:
    """Every row as often as ``copies`` says; a row of very many copies is written by several tasks."""
    columns = df.columns
    blocks = df.withColumn("copies_left", copies).filter(F.col("copies_left") > 0)
    blocks = blocks.withColumn("block", F.explode(F.sequence(F.lit(0), ((F.col("copies_left") - 1) / _COPIES).cast("long"))))
    size = F.least(F.lit(_COPIES), F.col("copies_left") - F.col("block") * _COPIES)
    dealt = blocks.withColumn("size", size.cast("int")).repartition(*columns, "block")
    return dealt.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("size")))).select(*columns)
