"""Sales questions over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURES = {"total_amount": "decimal(38,2)", "quantity": "bigint", "item_count": "bigint"}


def sales_by(fact: DataFrame, dimension: DataFrame, key: str, *attributes: str) -> DataFrame:
    """Sum the measures of the fact by attributes of one dimension.

    The fact is first summed per key, map-side before its only shuffle, so the
    dimension is joined to one row per used key and hot keys cost nothing.
    """
    per_key = fact.groupBy(key).agg(
        F.sum("total_amount").alias("total_amount"),
        F.sum(F.col("quantity").cast("bigint")).alias("quantity"),
        F.count(F.lit(1)).alias("item_count"),
    )
    totals = [F.sum(name).cast(kind).alias(name) for name, kind in MEASURES.items()]
    return per_key.join(dimension.select(key, *attributes), key).groupBy(*attributes).agg(*totals)


def sales_by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return sales_by(fact, dim_date, "date_key", "year_num", "month_of_year", "month_name")


def sales_by_category(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    return sales_by(fact, dim_product, "product_key", "category")


def sales_by_city(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return sales_by(fact, dim_customer, "customer_key", "city")
