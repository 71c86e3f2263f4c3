"""Layered output tables, CSV and JSON records."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfline.functions.numeric import finite_or_null
from shelfline.operators.check_summary import Check, ChecksFailed, observed, require

# Names of the layers.
STAGING, MARTS, ANALYTICS = "retail_staging", "retail_marts", "retail_analytics"


MANIFEST = "_manifest"


@dataclass(frozen=True)
class Layers:
    """Tables under ``root/<layer>/<name>``, fully replaced by each write.

    A table is a folder of versions and a manifest that names the current one. A write fills
    a new version, writes a manifest beside the current one and renames it over that; the rename is the commit
    and the file system (HDFS, a local disk) does it as a whole. A build that dies at any step leaves the
    table as it was, and whoever has opened a version keeps reading it until the write after the next.
    """

    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def write(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        partition_by: list[str] | None = None,
        sort_by: list[str] | None = None,
        stamp: str | None = None,
        checks: list[Check] | None = None,
    ) -> DataFrame:
        """Write a table and return a scan of it (of the columns of ``df``).

        ``stamp`` names a column for the time of the build. ``checks`` are measured while the rows are
        written; with an error among them the table stays as it was and ``ChecksFailed`` is raised.

        The rebalance hint lets Spark split large partition values over several
        files and merge small ones; sorting inside files narrows the min/max
        ranges readers skip by.
        """
        spark, table = df.sparkSession, self.path(layer, name)
        keys = partition_by or []
        laid_out = df.hint("rebalance", *[F.col(k) for k in keys])
        if keys or sort_by:
            laid_out = laid_out.sortWithinPartitions(*keys, *(sort_by or []))
        if stamp:
            laid_out = laid_out.withColumn(stamp, F.current_timestamp())
        if checks:
            laid_out, numbers = observed(laid_out, checks)
        writer = laid_out.write
        if keys:
            writer = writer.partitionBy(*keys)
        version = f"v-{uuid.uuid4().hex}"
        writer.parquet(f"{table}/{version}")
        if checks:
            try:
                require(checks, numbers)
            except ChecksFailed:
                _delete(spark, f"{table}/{version}")
                raise
        before = self.current(spark, layer, name)
        _commit(spark, table, {"version": version, "before": before and before["version"], "schema": laid_out.schema.jsonValue()})
        if before and before["before"]:
            _delete(spark, f"{table}/{before['before']}")
        return self.read(spark, layer, name).select(*df.columns)

    def current(self, spark: SparkSession, layer: str, name: str) -> dict | None:
        """The manifest of a table; None if it was never committed."""
        text = _read_text(spark, f"{self.path(layer, name)}/{MANIFEST}")
        return None if text is None else json.loads(text)

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        manifest = self.current(spark, layer, name)
        if manifest is None:
            raise FileNotFoundError(f"no table at {self.path(layer, name)}")
        schema = T.StructType.fromJson(manifest["schema"])
        return spark.read.schema(schema).parquet(f"{self.path(layer, name)}/{manifest['version']}").select(*schema.names)

    def publish_view(self, df: DataFrame, layer: str, name: str) -> DataFrame:
        """A lazy layer: recomputed by whoever reads it."""
        df.createOrReplaceTempView(f"{layer}_{name}")
        return df.sparkSession.table(f"{layer}_{name}")


def _hadoop_path(spark: SparkSession, path: str):
    """The path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _commit(spark: SparkSession, table: str, manifest: dict) -> None:
    """Put the manifest in the place of the current one, with a single rename."""
    beside, files = _hadoop_path(spark, f"{table}/{MANIFEST}.{manifest['version']}")
    out = files.create(beside, True)
    out.write(json.dumps(manifest).encode())
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    over[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(beside), files.makeQualified(hadoop.Path(f"{table}/{MANIFEST}")), over)


def _delete(spark: SparkSession, path: str) -> None:
    found, files = _hadoop_path(spark, path)
    files.delete(found, True)


def _read_text(spark: SparkSession, path: str) -> str | None:
    found, files = _hadoop_path(spark, path)
    if not files.exists(found):
        return None
    stream = files.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def json_safe(df: DataFrame) -> DataFrame:
    """NULL for every NaN and infinity, so that the rows are valid JSON."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite_or_null(F.col(c)) for c in floating})


def write_json(df: DataFrame, path: str) -> None:
    json_safe(df).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that ``read_sales`` gives back unchanged, outer blanks included."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
