"""Session settings and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split over several tasks even where that costs the
    # following aggregation one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # The Java runtime never compiles a method of more bytes. Where the code of a whole
    # stage would hold one, the stage runs operator by operator, in compiled methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the plans rely on."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local session may fall back on a folder of this machine, because
    there the driver and the executors share it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="shelfline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder."""
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and return a scan of it.

    Used where a result feeds more than one branch. It cuts the lineage, a lost
    executor costs nothing already written, later readers get column pruning
    and filter pushdown, and Spark knows the real size when it picks joins.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)
