"""Sales rows derived from the TPC-H style tables, with deliberate defects.

Missing, blank, negative and inflated values are placed by the order and part
keys, so every quality rule and label has rows to work on.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.functions.numeric import MONEY, half_up
from shelfline.session import stage_table


# Column types of the given tables, so that opening one reads no file footer.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out to all cores when the files give fewer splits than there are cores.

    Files of any size worth a cluster give more, and then nothing is moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def sales_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sales row per line item.

    Only equality joins. Orders meet their customers and parts their suppliers first, so that
    the lines are joined twice only, whatever the size of the other tables: Spark broadcasts
    what is under the broadcast limit and shuffles the rest, where the adaptive skew join splits hot keys.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    supplier_count = suppliers.agg(F.count(F.lit(1)).alias("n")).scalar()

    stores = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "n_name")
    )
    # A line's owner follows from its part.
    owned = parts.withColumn("owner_key", F.col("p_partkey") % supplier_count)
    items = owned.join(suppliers, F.col("owner_key") == F.col("s_suppkey")).drop("owner_key", "s_suppkey")
    joined = (
        spread(lines)
        .join(stores, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(items, F.col("l_partkey") == F.col("p_partkey"))
    )

    order_key, part_key = F.col("l_orderkey"), F.col("l_partkey")
    list_price = F.col("l_extendedprice").cast("decimal(12,2)")
    units = F.col("l_quantity").cast(MONEY)
    paid = F.round(list_price * (1 - F.col("l_discount").cast("decimal(4,2)")), 2).cast(MONEY)
    taxed = (list_price * (1 + F.col("l_tax").cast("decimal(4,2)"))).cast("double")
    shelf_price = half_up(taxed / F.col("l_quantity")).cast(MONEY)

    return joined.select(
        F.concat(F.lit("  "), F.replace("n_name", F.lit("_"), F.lit("  ")), F.lit(" ")).alias("Store_Name"),
        part_key.cast("string").alias("Item_Code"),
        F.when(part_key % 20 == 0, F.lit(None))
        .when(part_key % 20 == 1, F.lit("   "))
        .otherwise(F.lpad(part_key.cast("string"), 12, "0"))
        .alias("Item_Barcode"),
        F.col("p_name").alias("Description"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Department"),
        F.col("p_type").alias("Sub_Department"),
        F.concat(F.lit("Section "), F.col("p_size") % 5).alias("Section"),
        F.when(order_key % 97 == 0, F.lit(None))
        .when(order_key % 89 == 0, -units)
        .when(order_key % 113 == 0, (units * 20).cast(MONEY))
        .otherwise(units)
        .cast(MONEY)
        .alias("Quantity"),
        F.when(order_key % 101 == 0, -paid).otherwise(paid).alias("Total_Sales"),
        F.when(order_key % 31 != 0, shelf_price).alias("RRP"),
        F.col("s_name").alias("Supplier"),
        F.col("l_shipdate").cast("date").alias("Date_Of_Sale"),
    )


def state_of(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> tuple:
    """Name, length and time of every file of the tables, which change with their content."""
    found = []
    for name in names:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(folder, True)
        while files.hasNext():
            file = files.next()
            found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return tuple(sorted(found))


SALES_TABLES = ("lineitem", "orders", "customer", "nation", "part", "supplier")


@lru_cache(maxsize=8)
def _loaded(spark: SparkSession, application: str, sf_dir: str, state: tuple) -> DataFrame:
    return stage_table(sales_rows(spark, sf_dir), "retail-sales")


def sales_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base sales table, loaded once per application and content of its source files, and read by every later query."""
    return _loaded(spark, spark.sparkContext.applicationId, sf_dir, state_of(spark, sf_dir, SALES_TABLES))
