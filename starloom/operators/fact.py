"""The sales fact: one row per item of a dated transaction."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.calendar import date_key, moment
from starloom.functions.coerce import strict_cast
from starloom.schemas import TABLES, UNKNOWN_KEY


def within_years(when: Column, first_year: int, last_year: int) -> Column:
    """From the first to the last midnight of the years; later on 31 December is out."""
    first = moment(datetime.datetime(first_year, 1, 1))
    last = moment(datetime.datetime(last_year, 12, 31))
    return (when >= first) & (when <= last)


def known_or_unknown(key: Column) -> Column:
    return F.coalesce(key, F.lit(UNKNOWN_KEY).cast("long"))


def total_amount(price: Column) -> Column:
    declared = TABLES["fact_sales"].columns["total_amount"].dataType
    return strict_cast(F.col("quantity") * price, declared, "total_amount")


def build_fact_sales(
    transactions: DataFrame,
    items: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    first_year: int,
    last_year: int,
) -> DataFrame:
    """Join transactions to their items and look up the dimension keys.

    Customers are looked up on the transactions, before the items multiply
    them.  Join strategies are left to Spark: a dimension is broadcast when
    its two columns are below the threshold, otherwise it is a sort-merge join
    whose hot keys (a popular customer, one giant transaction, NULL ids)
    adaptive execution splits.
    """
    customers = dim_customer.filter("is_current").select("customer_id_natural", "customer_key")
    products = dim_product.select("product_id_natural", "product_key")
    # Keys of a transaction are worked out here, once, and travel narrow.
    dated = (
        transactions.filter(within_years(F.col("transaction_date"), first_year, last_year))
        .join(customers, F.col("customer_id") == F.col("customer_id_natural"), "left")
        .select(
            "transaction_id",
            date_key(F.col("transaction_date")).alias("date_key"),
            known_or_unknown(F.col("customer_key")).alias("customer_key"),
        )
    )
    sold = items.select("transaction_id", "product_id", "quantity", "price")
    # Items come first: a merge join holds the rows of its second side per key, and there it is one.
    rows = sold.join(dated, "transaction_id").join(
        products, F.col("product_id") == F.col("product_id_natural"), "left"
    )
    values = {
        "date_key": F.col("date_key"),
        "customer_key": F.col("customer_key"),
        "product_key": known_or_unknown(F.col("product_key")),
        "campaign_key": F.lit(UNKNOWN_KEY),
        "transaction_id_natural": F.col("transaction_id"),
        "quantity": F.col("quantity"),
        "price_at_sale": F.col("price"),
    }
    return rows.select(*[
        (total_amount(F.col("price")) if column.name == "total_amount"
         else strict_cast(values[column.name], column.dataType, column.name)).alias(column.name)
        for column in TABLES["fact_sales"].columns
    ])
