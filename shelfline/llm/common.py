"""Session preparation, table access and scratch tables shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfline.session import scratch_path

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches Python tasks get and let them import this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Intermediate tables of one operator call, each removed once its readers are done."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.name = name
        self._paths: dict[int, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and return a scan of it; this cuts the lineage."""
        path = scratch_path(self.spark, f"{self.name}-{name}")
        df.write.option("compression", "zstd").parquet(path)
        scan = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(scan)] = path
        return scan

    def drop(self, *scans: DataFrame) -> None:
        for scan in scans:
            path = self._paths.pop(id(scan), None)
            if path is None:
                continue
            target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


#: Hashes that bounded_sample orders by lie below this.
PLACES = 1 << 40


def bounded_sample(rows: DataFrame, hashed: Column, limit: int) -> DataFrame:
    """At most ``limit`` of the ``rows``, those with the smallest hashes; all of them if they are not more.

    ``rows`` should be narrow and cheap to scan (a table). They are counted first, so only little more than the rows wanted are ordered
    and no task holds more than these.
    """
    whole = rows.count()
    if whole <= limit:
        return rows
    place = F.pmod(hashed, F.lit(PLACES))
    wanted = limit + 8 * int(limit**0.5)
    return rows.where(place < int(PLACES * min(1.0, wanted / whole))).orderBy(place, *rows.columns).limit(limit)


#: Bits of the map that may_be_among broadcasts: 4 MB at any size of its tables.
MAP_BITS = 1 << 25
_MAP_PART = 1 << 15


def may_be_among(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``column`` (a bigint) may be in the one column of ``ids``: all that are, and few others while ``ids`` has far fewer than ``MAP_BITS`` rows.

    A bitmap of hashed ids goes to the executors, so that a join that follows need not shuffle the texts of rows it does not want.
    """

    def place(value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(MAP_BITS))

    def part(value: Column) -> Column:
        return F.floor(place(value) / _MAP_PART).cast("int")

    def bit(value: Column) -> Column:
        return F.pmod(place(value), F.lit(_MAP_PART))

    name = ids.columns[0]
    marked = ids.groupBy(part(F.col(name)).alias("__map_part")).agg(F.bitmap_construct_agg(bit(F.col(name))).alias("__map_bits"))
    own = bit(F.col(column))
    byte = F.conv(F.hex(F.substring("__map_bits", F.floor(own / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, F.pmod(own, F.lit(8)).cast("int")) == 1
    known = rows.where(F.col(column).isNotNull())
    return known.join(F.broadcast(marked), part(F.col(column)) == F.col("__map_part")).where(is_set).select(*rows.columns)


def map_arrow(df: DataFrame, function: Callable[[pa.RecordBatch], dict | None], schema: str) -> DataFrame:
    """Apply ``function`` to each Arrow batch; it returns columns by name or nothing."""
    names = [part.split()[0] for part in _split_schema(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := function(batch)) is not None:
                yield pa.RecordBatch.from_arrays([pa.array(out[n]) if not isinstance(out[n], pa.Array) else out[n] for n in names], names)

    return df.mapInArrow(run, schema)


def _split_schema(schema: str) -> list[str]:
    """Column definitions of a DDL string; commas inside angle brackets do not end one."""
    parts, depth, start = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            parts.append(schema[start:i].strip())
            start = i + 1
    return [*parts, schema[start:].strip()]


def held_out_column(doc_id: Column) -> Column:
    """True for documents no model may learn from: crc32 of the id's text modulo 4 is 2; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
