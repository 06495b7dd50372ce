"""The retail sources and sensor messages, derived from TPC-H-like tables.

Keys there start at 0, which is the natural id of the unknown members, so
every id is shifted by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Source customers plus their ``segment`` and ``balance``."""
    nation = _table(spark, folder, "nation")
    return (
        _table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            (F.col("c_custkey") + 1).alias("customer_id"),
            F.col("c_name").alias("name"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            F.col("n_name").alias("city"),
            F.lit("1995-01-01").cast("timestamp_ntz").alias("signup_date"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "part").select(
        (F.col("p_partkey") + 1).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
    )


def campaigns(spark: SparkSession, folder: str) -> DataFrame:
    """One campaign per event type, running from its first to its last event."""
    spans = (
        _table(spark, folder, "events")
        .groupBy("event_type")
        .agg(F.min("ts").alias("start_date"), F.max("ts").alias("end_date"))
    )
    # Event types are a handful of category names, so one partition numbers them.
    number = F.row_number().over(Window.orderBy("event_type"))
    return spans.select(
        number.cast("long").alias("campaign_id"),
        F.concat(F.col("event_type"), F.lit(" campaign")).alias("campaign_name"),
        "start_date",
        "end_date",
        F.col("event_type").alias("channel"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "orders").select(
        (F.col("o_orderkey") + 1).alias("transaction_id"),
        (F.col("o_custkey") + 1).alias("customer_id"),
        F.col("o_orderdate").alias("transaction_date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_amount"),
    )


def transaction_items(spark: SparkSession, folder: str) -> DataFrame:
    """Source items; the line number stands in for an item id, which nothing reads."""
    return _table(spark, folder, "lineitem").select(
        F.col("l_linenumber").cast("long").alias("transaction_item_id"),
        (F.col("l_orderkey") + 1).alias("transaction_id"),
        (F.col("l_partkey") + 1).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )


def staging(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five sources by staging table."""
    return {
        "stg_customers": customers(spark, folder).drop("segment", "balance"),
        "stg_products": products(spark, folder),
        "stg_marketing_campaigns": campaigns(spark, folder),
        "stg_transactions": transactions(spark, folder),
        "stg_transaction_items": transaction_items(spark, folder),
    }


def sensor_messages(events: DataFrame) -> DataFrame:
    """Events as sensor messages, JSON bytes in ``value``; batch or streaming.

    Error events become text that is not JSON, views carry a mistyped
    ``P_watt`` and purchases carry no ``date_time``.
    """
    city = F.col("user_id") % 5 + 1

    def message(watt, moment=None):
        fields = [] if moment is None else [moment.alias("date_time")]
        return F.to_json(F.struct(
            *fields,
            city.cast("int").alias("city_id"),
            F.concat(F.lit("City "), city.cast("string")).alias("city_name"),
            F.concat(F.lit("DEV-"), F.col("user_id").cast("string")).alias("device_name"),
            watt.alias("P_watt"),
            F.lit(200).alias("V_volt"),
            F.col("value").alias("I_amphere"),
        ))

    moment = F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T"))
    watt = (F.lit(250) + F.col("user_id") % 50).cast("int")
    text = (
        F.when(F.col("event_type") == "error", F.lit("garbage"))
        .when(F.col("event_type") == "view", message(F.lit("n/a"), moment))
        .when(F.col("event_type") == "purchase", message(watt))
        .otherwise(message(watt, moment))
    )
    return events.select(text.cast("binary").alias("value"))
