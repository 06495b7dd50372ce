import datetime
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starloom.operators.fact import build_fact_sales
from starloom.schemas import TABLES

DAY = datetime.datetime(2025, 3, 4, 5, 6, 7)
FAILED = (PySparkException, Py4JJavaError)


def _frame(spark, table, rows):
    return spark.createDataFrame(rows, TABLES[table].columns)


def _fact(spark, transactions, items, customers=((1, 1, True),), products=((1, 1),)):
    dim_customer = spark.createDataFrame(
        list(customers), "customer_key bigint, customer_id_natural int, is_current boolean"
    )
    dim_product = spark.createDataFrame(list(products), "product_key bigint, product_id_natural int")
    return build_fact_sales(
        _frame(spark, "stg_transactions", [(*row, None) for row in transactions]),
        _frame(spark, "stg_transaction_items", [(None, *row) for row in items]),
        dim_customer, dim_product, 2020, 2030,
    )


def _item(transaction, product=1, quantity=2, price="1.50"):
    return (transaction, product, quantity, None if price is None else Decimal(price))


def test_row(spark):
    fact = _fact(spark, [(9, 1, DAY)], [_item(9)])
    assert fact.columns == TABLES["fact_sales"].columns.names
    assert [tuple(row) for row in fact.collect()] == [(20250304, 1, 1, 0, 9, 2, Decimal("1.50"), Decimal("3.00"))]
    assert [t for _, t in fact.dtypes] == [c.dataType.simpleString() for c in TABLES["fact_sales"].columns]


def test_unmatched_ids_point_to_the_unknown_member(spark):
    rows = _fact(
        spark,
        [(1, None, DAY), (2, 99, DAY), (3, 2, DAY), (4, 3, DAY), (5, 1, DAY)],
        [_item(1), _item(2), _item(3), _item(4), _item(5, product=8), _item(5, product=None)],
        customers=[(1, 1, True), (2, 2, False), (3, 3, None)],
    ).collect()
    assert sorted((r.transaction_id_natural, r.customer_key, r.product_key) for r in rows) == [
        (1, 0, 1), (2, 0, 1), (3, 0, 1), (4, 0, 1), (5, 1, 0), (5, 1, 0),
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Jakarta"])
def test_date_bounds_are_midnights(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        _check_date_bounds(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def _check_date_bounds(spark):
    moments = [
        datetime.datetime(2019, 12, 31, 23, 59, 59), datetime.datetime(2020, 1, 1),
        datetime.datetime(2030, 12, 31), datetime.datetime(2030, 12, 31, 0, 0, 1), None,
    ]
    rows = _fact(spark, [(i, 1, m) for i, m in enumerate(moments)], [_item(i) for i in range(5)]).collect()
    assert sorted((r.transaction_id_natural, r.date_key) for r in rows) == [(1, 20200101), (2, 20301231)]


def test_grain(spark):
    """Transactions without items and items without a transaction vanish, copies multiply."""
    rows = _fact(spark, [(1, 1, DAY), (2, 1, DAY), (3, 1, DAY), (3, 1, DAY)], [_item(1), _item(1), _item(3), _item(7)])
    assert sorted(r.transaction_id_natural for r in rows.collect()) == [1, 1, 3, 3]


def test_overflow_fails(spark):
    with pytest.raises(FAILED, match="does not fit int"):
        _fact(spark, [(2**31, 1, DAY)], [_item(2**31)]).collect()


def test_amount_beyond_its_column_fails(spark):
    with pytest.raises(FAILED):
        _fact(spark, [(1, 1, DAY)], [_item(1, quantity=2_000_000_000, price="9999999999999999.99")]).collect()


def test_null_price_is_kept_for_the_constraint_to_catch(spark):
    assert _fact(spark, [(1, 1, DAY)], [_item(1, price=None)]).collect()[0].total_amount is None


@pytest.mark.parametrize("customer", [1, None])
def test_hot_keys_are_split(spark, customer):
    """With shuffle joins only, one transaction and one (or no) customer with a third of the rows are split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        n = 60_000
        hot = F.when(F.col("id") % 3 == 0, 1)
        transactions = spark.range(n, numPartitions=8).select(
            F.col("id").alias("transaction_id"),
            F.when(F.col("id") % 3 == 0, customer).otherwise(F.col("id") % 997 + 2).alias("customer_id"),
            F.lit(DAY).cast("timestamp_ntz").alias("transaction_date"),
            F.lit(None).cast("decimal(18,2)").alias("total_amount"),
        )
        items = spark.range(2 * n, numPartitions=8).select(
            F.col("id").alias("transaction_item_id"),
            hot.otherwise(F.col("id") % n).alias("transaction_id"),
            (F.col("id") % 50 + 1).alias("product_id"),
            F.lit(1).alias("quantity"),
            F.lit(1).cast("decimal(18,2)").alias("price"),
        )
        customers = spark.range(1, 1000).select(
            F.col("id").alias("customer_key"),
            F.col("id").cast("int").alias("customer_id_natural"),
            F.lit(True).alias("is_current"),
        )
        products = spark.range(1, 51).select(
            F.col("id").alias("product_key"), F.col("id").cast("int").alias("product_id_natural")
        )
        fact = build_fact_sales(transactions, items, customers, products, 2020, 2030)
        assert len(fact.collect()) == 2 * n
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin(skew=true)") >= 2, plan
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
