"""The given tables in the shape of the entities.

Nulls and duplicates that the given tables lack come from conditions on their own
columns, so every binding covers the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.session import limit_methods


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: bytes of parquet files that one task of a spread table stands for
SPREAD_BYTES = 8_000_000


def load_spread(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table whose rows need much CPU each.

    A table of fewer files than cores is read by too few tasks and is spread first, over
    at least a task for each ``SPREAD_BYTES`` of its files, so that no task grows with the
    table; a table of many files is taken as it comes, without an exchange.
    """
    limit_methods(spark)
    df = load(spark, sf_dir, table)
    cores = spark.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    files = spark.read.format("binaryFile").load(f"{sf_dir}/{table}.parquet")
    size = files.agg(F.sum("length")).first()[0] or 0
    return df.repartition(max(cores, -(-size // SPREAD_BYTES)))


def money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)")


def text(column: str) -> Column:
    return F.col(column).cast("string")


def whole(column: str) -> Column:
    return F.col(column).cast("bigint")


def piece_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as one-piece orders."""
    price = money("l_extendedprice")
    return load(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("srid"),
        text("l_partkey").alias("supplier_article"),
        F.col("l_partkey").alias("nm_id"),
        F.col("l_shipdate").alias("date_ts"),
        (F.col("l_returnflag") == "R").alias("is_cancel"),
        F.when(F.col("l_linestatus") == "O", price).alias("price_with_disc"),
        F.when(F.col("l_returnflag") == "N", price + 1).cast("decimal(12,2)").alias("finished_price"),
        (price + 2).cast("decimal(12,2)").alias("total_price"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the header of their order."""
    orders = load(spark, sf_dir, "orders")
    lines = load(spark, sf_dir, "lineitem")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left")
    return joined.select(
        text("l_orderkey").alias("posting_number"),
        F.col("l_orderkey").alias("order_key"),
        F.when(F.col("o_orderpriority") != "5-LOW", text("o_custkey")).alias("order_number"),
        F.when(F.col("o_orderstatus") == "P", "cancelled").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("created_at"),
        F.col("o_orderdate").alias("in_process_at"),
        F.when(F.col("l_returnflag") == "R", "").otherwise(text("l_partkey")).alias("product_offer_id"),
        F.col("l_suppkey").alias("product_sku"),
        whole("l_quantity").alias("product_quantity"),
        money("l_extendedprice").alias("product_price_amount"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag",
    )


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as status versions of a user."""
    return load(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("event_type").alias("status"), F.col("ts").alias("changed_at"), "value", "props"
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a feed with repeated keys."""
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", whole("l_quantity").alias("qty"),
        money("l_extendedprice").alias("price"),
    )


FEED_KEYS = ["l_orderkey", "l_linenumber"]
FEED_ARRIVAL = ["l_partkey", "l_suppkey", "qty", "price"]
