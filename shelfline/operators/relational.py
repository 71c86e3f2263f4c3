"""Union by name, deduplication, pivoting and other whole-table operators."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from shelfline.functions.text import slug

SOURCE_COLUMN = "source_relation"
#: Most values that may become columns or tables of their own.
MOST_VALUES = 5000


def union_relations(
    relations: dict[str, DataFrame],
    column_override: dict[str, str] | None = None,
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    source_column: str | None = SOURCE_COLUMN,
    where: str | None = None,
) -> DataFrame:
    """UNION ALL over the superset of columns, in first-seen order.

    Columns are matched without case, under their first spelling. A column absent
    from a relation is NULL there; types that differ are widened to the one Spark's
    UNION takes for them. ``where`` filters each relation on its own columns, before
    the union.
    """
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    if not relations:
        raise ValueError("no relations to union")
    override = {c.lower(): t for c, t in (column_override or {}).items()}
    included = {c.lower() for c in include or []}
    excluded = {c.lower() for c in exclude or []}

    def wanted(name: str) -> bool:
        return name.lower() not in excluded and (not included or name.lower() in included)

    names: dict[str, str] = {}
    types: dict[str, T.DataType | str] = {}
    for df in relations.values():
        for field in df.schema:
            key = field.name.lower()
            if not wanted(field.name):
                continue
            known = types.get(key, field.dataType)
            names.setdefault(key, field.name)
            types[key] = override[key] if key in override else _wider(df.sparkSession, known, field.dataType)
    if not types:
        raise ValueError("no columns left to union")

    def aligned(name: str, df: DataFrame) -> DataFrame:
        rows = df.filter(where) if where else df
        source = [F.lit(name).alias(source_column)] if source_column else []
        present = {c.lower() for c in df.columns}
        values = [(F.col(c) if c in present else F.lit(None)).cast(dtype).alias(names[c]) for c, dtype in types.items()]
        return rows.select(*source, *values)

    return reduce(DataFrame.unionAll, [aligned(name, df) for name, df in relations.items()])


def _wider(spark: SparkSession, one: T.DataType, two: T.DataType) -> T.DataType:
    """The type that holds values of both, as UNION decides it."""
    if one == two:
        return one
    empty = spark.range(0)
    return empty.select(F.lit(None).cast(one)).union(empty.select(F.lit(None).cast(two))).schema[0].dataType


def deduplicate(df: DataFrame, partition_by: list[str], order_by: list[Column]) -> DataFrame:
    """The first row of every key; rows with NULL keys form groups too.

    Each task keeps one row per key before the shuffle, so a key that repeats
    very often costs no more than any other.
    """
    first = F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order_by))
    return df.withColumn("__place", first).filter(F.col("__place") == 1).drop("__place")


def pivot(
    df: DataFrame,
    group_by: list[str],
    column: str,
    values: list,
    aggregate: Callable[[Column], Column] = F.sum,
    compare: Callable[[Column, Column], Column] = Column.__eq__,
    then_value: Column | int = 1,
    else_value: Column | int | None = 0,
    prefix: str = "",
    suffix: str = "",
    as_identifier: bool = False,
) -> DataFrame:
    """Conditional aggregates: one output column per listed value.

    For a distinct aggregate pass e.g. ``F.sum_distinct`` or ``F.count_distinct``.
    """

    def cell(value) -> Column:
        matched = F.when(compare(F.col(column), F.lit(value)), then_value).otherwise(else_value)
        name = f"{prefix}{value}{suffix}"
        return aggregate(matched).alias(slug(name) if as_identifier else name)

    return df.groupBy(*group_by).agg(*[cell(v) for v in values])


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: list[str] | None = None,
    remove: list[str] | None = None,
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to rows; ``exclude`` stays as columns, ``remove`` disappears, NULL values stay."""
    kept = {c.lower() for c in exclude or []}
    dropped = {c.lower() for c in remove or []}
    ids = [c for c in df.columns if c.lower() in kept and c.lower() not in dropped]
    melted = [c for c in df.columns if c.lower() not in kept | dropped]
    values = df.select(*ids, *[F.col(c).cast(cast_to).alias(c) for c in melted])
    return values.unpivot(ids, melted, field_name, value_name)


def column_values(
    df: DataFrame, column: str, order_by: list[Column] | None = None, max_records: int | None = None,
    where: str | None = None,
) -> DataFrame:
    """Distinct values, the most frequent first."""
    rows = df.filter(where) if where else df
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranked = counted.orderBy(*(order_by or [F.col("n").desc(), F.col("value").asc_nulls_last()]))
    return ranked.limit(max_records) if max_records is not None else ranked


def column_value_list(
    df: DataFrame | None, column: str, max_records: int | None = None, default: list | None = None, where: str | None = None
) -> list:
    """All values (or the ``max_records`` most frequent) as a list, to name the columns of a pivot.

    More than ``MOST_VALUES`` are refused, never cut off.
    """
    if df is None:
        if default is None:
            raise ValueError("the relation does not exist and no default was given")
        return default
    bound = MOST_VALUES + 1 if max_records is None else max_records
    found = [row["value"] for row in column_values(df, column, max_records=bound, where=where).collect()]
    if max_records is None and len(found) > MOST_VALUES:
        raise ValueError(f"{column} has more than {MOST_VALUES} values")
    return found or (default or [])


def select_except(
    df: DataFrame, drop: list[str] | None = None, prefix: str = "", suffix: str = "", alias: str | None = None
) -> DataFrame:
    """All columns but some (names compared without case), optionally renamed."""
    dropped = {c.lower() for c in drop or []}
    kept = [c for c in df.columns if c.lower() not in dropped]
    if not kept:
        raise ValueError("no columns left")
    source = df.alias(alias) if alias else df
    return source.select(*[F.col(f"{alias}.{c}" if alias else c).alias(f"{prefix}{c}{suffix}") for c in kept])


def group_by_first(df: DataFrame, n: int, *aggregates: Column) -> DataFrame:
    """Group by the first ``n`` columns."""
    if not 0 < n <= len(df.columns):
        raise ValueError(f"n must be between 1 and {len(df.columns)}")
    return df.groupBy(*df.columns[:n]).agg(*aggregates)


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty strings become NULL in every text column."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in text})


def null_profile(df: DataFrame) -> DataFrame:
    """Rows, NULLs and NULL share per column, after empty strings became NULL."""
    checked = blank_to_null(df)
    wide = checked.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(c) for c in checked.columns]
    )
    long = wide.unpivot("__rows", checked.columns, "column_name", "filled")
    missing = F.col("__rows") - F.col("filled")
    return long.select(
        "column_name",
        F.col("__rows").alias("row_count"),
        missing.alias("null_count"),
        F.try_divide(missing.cast("double"), F.col("__rows")).alias("null_share"),
    )


def scalar_or_default(df: DataFrame, default) -> Column:
    """First column of a single-row result as a value for another query; the default when there is no row."""
    first = df.columns[0]
    return F.coalesce(df.select(first).scalar(), F.lit(default))


def _like_to_regex(pattern: str) -> re.Pattern:
    """A LIKE pattern as a regular expression that ignores case."""
    wildcards = {"%": ".*", "_": "."}
    return re.compile("".join(wildcards.get(c, re.escape(c)) for c in pattern), re.IGNORECASE | re.DOTALL)


def relations_like(
    spark: SparkSession, pattern: str, exclude: str = "", database: str | None = None, types: list[str] | None = None
) -> dict[str, str]:
    """Name -> type of the tables and views whose name is LIKE the pattern, without case.

    ``database`` is a LIKE pattern over the databases of the current catalog; names of tables found that
    way are qualified and quoted as needed, so that they can be read from anywhere. Without it the current database and temporary views are
    searched. ``types`` (TABLE, EXTERNAL, VIEW, TEMPORARY ...) limits the result; MANAGED tables also count as TABLE.
    """
    wanted, unwanted = _like_to_regex(pattern), _like_to_regex(exclude)
    kinds = {t.upper() for t in types or []}
    kinds |= {"MANAGED"} if "TABLE" in kinds else set()

    def fits(name: str, kind: str) -> bool:
        return bool(wanted.fullmatch(name)) and not unwanted.fullmatch(name) and (not kinds or kind.upper() in kinds)

    if database is None:
        found = {t.name: t.tableType for t in spark.catalog.listTables() if fits(t.name, t.tableType)}
        return dict(sorted(found.items()))
    schemas = _like_to_regex(database)
    found = {}
    for schema in sorted(d.name for d in spark.catalog.listDatabases() if schemas.fullmatch(d.name)):
        # Temporary views belong to no database, though every one lists them.
        for t in spark.catalog.listTables(_quoted(schema)):
            if not t.isTemporary and fits(t.name, t.tableType):
                found[f"{_quoted(schema)}.{_quoted(t.name)}"] = t.tableType
    return dict(sorted(found.items()))


def _quoted(name: str) -> str:
    return name if re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", name) else "`" + name.replace("`", "``") + "`"


def relations_with_prefix(
    spark: SparkSession, prefix: str, exclude: str = "", database: str | None = None, types: list[str] | None = None
) -> dict[str, str]:
    """As ``relations_like``, for a beginning of the name."""
    return relations_like(spark, f"{prefix}%", exclude, database, types)


def union_by_pattern(
    spark: SparkSession, pattern: str, exclude: str = "", database: str | None = None, types: list[str] | None = None, **options
) -> DataFrame:
    """Union of all catalog relations whose name matches, in all databases that match; each row names its relation."""
    names = relations_like(spark, pattern, exclude, database, types)
    if not names:
        raise ValueError(f"no relation is like {pattern!r}" + (f" in databases like {database!r}" if database else ""))
    return union_relations({name: spark.table(name) for name in names}, **options)
