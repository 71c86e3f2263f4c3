"""Row-by-row difference of two tables of which most rows are equal.

Each table is reduced to one digest per bucket of row hashes: how many rows, and two sums of
hashes, which do not depend on the order of rows and see every copy. Only rows of buckets whose
digests differ are shuffled and counted; equal tables shuffle digests alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.session import stage_table

#: A digest takes 3 numbers, so a table's digests stay below 4 MB at any size.
BUCKETS = 1 << 16


def row_hash(columns: list[str], seed: int) -> Column:
    """64 bits of the row. NULLs count: Spark's hash leaves them out, so their places are hashed too."""
    places = F.concat_ws("", *[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(seed), *columns, places)


def _bucket(columns: list[str]) -> Column:
    return F.pmod(row_hash(columns, 0), F.lit(BUCKETS)).cast("int")


def bucket_digests(df: DataFrame, columns: list[str]) -> DataFrame:
    """``bucket``, ``copies``, ``sum_1``, ``sum_2``; counted before the shuffle, at most ``BUCKETS`` rows."""
    sums = [F.sum(row_hash(columns, seed).cast("decimal(20,0)")).alias(f"sum_{seed}") for seed in (1, 2)]
    return df.groupBy(_bucket(columns).alias("bucket")).agg(F.count(F.lit(1)).alias("copies"), *sums)


def differing_buckets(df: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    """Buckets whose rows are not the same rows equally often; written, at most ``BUCKETS`` rows."""
    ours, theirs = bucket_digests(df, columns), bucket_digests(other, columns)
    same = F.lit(True)
    for name in ("copies", "sum_1", "sum_2"):
        same = same & F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
    both = ours.alias("a").join(theirs.alias("b"), F.col("a.bucket") == F.col("b.bucket"), "full_outer")
    return stage_table(both.filter(~same).select(F.coalesce("a.bucket", "b.bucket").alias("bucket")), "differing-buckets")


def table_diff(df: DataFrame, other: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``side`` (a_minus_b or b_minus_a), the columns, and ``surplus``: how many more copies of the row that side has.

    NULL equals NULL. Rows that are equal under Spark's grouping are equal here, so NaN equals NaN and -0.0 equals 0.0.
    """
    names = columns or df.columns
    if len(set(names)) < len(names):
        raise ValueError("columns must have distinct names")
    theirs = other.select(*names)
    buckets = differing_buckets(df.select(*names), theirs, names)
    side = F.when(F.col("__a") > F.col("__b"), "a_minus_b").otherwise("b_minus_a").alias("side")
    if buckets.isEmpty():
        empty = df.select(*names).unionAll(theirs).limit(0)
        return empty.select(F.lit("").alias("side"), *names, F.lit(0).cast("bigint").alias("surplus"))

    def suspects(rows: DataFrame, a: int, b: int) -> DataFrame:
        marked = rows.withColumn("__bucket", _bucket(names)).join(F.broadcast(buckets), F.col("__bucket") == F.col("bucket"), "left_semi")
        return marked.select(*names, F.lit(a).alias("__a"), F.lit(b).alias("__b"))

    both = suspects(df.select(*names), 1, 0).unionAll(suspects(theirs, 0, 1))
    counts = both.groupBy(*names).agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
    return counts.filter(F.col("__a") != F.col("__b")).select(side, *names, F.abs(F.col("__a") - F.col("__b")).alias("surplus"))
