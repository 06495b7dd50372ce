"""Operators against plain-Python models, on random small inputs."""

import datetime
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.functions.calendar import moment
from starloom.operators.dimensions import CUSTOMERS, load_dimension, new_dimension
from starloom.operators.fact import build_fact_sales
from starloom.schemas import TABLES
from starloom.streaming import sensors

START = datetime.datetime(2024, 1, 1)


@pytest.mark.parametrize("seed", range(4))
def test_upserts(spark, seed):
    pick = random.Random(seed)
    spread = pick.choice([30, 2**31])
    members = {0: [0, 0, "Unknown", None, None, None, START, None, True]}
    dimension = new_dimension(spark, CUSTOMERS, moment(START))
    for step in range(3):
        ids = {pick.randrange(1, spread) for _ in range(15)} | set(pick.sample(list(members), min(5, len(members))))
        loaded = START + datetime.timedelta(days=step)
        batch = [(i, f"n{step}-{i}", pick.choice([None, "e"]), pick.choice([None, "c"]), loaded) for i in ids]
        next_key = max(row[0] for row in members.values())
        for i, name, email, city, signed in sorted(batch):
            if i in members:
                members[i][2:5] = name, email, city
                members[i][7:] = None, True
            else:
                next_key += 1
                members[i] = [next_key, i, name, email, city, signed, loaded, None, True]
        frame = spark.createDataFrame(batch, TABLES["stg_customers"].columns).repartition(3)
        dimension = load_dimension(dimension, frame, CUSTOMERS, moment(loaded))
    assert sorted(map(tuple, dimension.collect())) == sorted(map(tuple, members.values()))


@pytest.mark.parametrize("seed", range(3))
def test_facts(spark, seed):
    pick = random.Random(seed)
    day = lambda: pick.choice([None, *(datetime.datetime(y, 12, 31, h) for y in (2019, 2020, 2030) for h in (0, 1))])
    some = lambda n: pick.choice([None, *range(n)])
    customers = [(k, i, pick.choice([True, False, None])) for k, i in enumerate(range(0, 8, 2))]
    products = [(k + 10, i) for k, i in enumerate(range(0, 8, 3))]
    transactions = [(some(12), some(9), day(), None) for _ in range(30)]
    items = [(n, some(14), some(9), pick.randint(1, 3), Decimal(pick.randint(1, 999)) / 100) for n in range(60)]

    current = {i: k for k, i, is_current in customers if is_current}
    known = {i: k for k, i in products}
    expected = Counter(
        (int(when.strftime("%Y%m%d")), current.get(customer, 0), known.get(product, 0), 0, sale, quantity, price,
         quantity * price)
        for sale, customer, when, _ in transactions
        for _, item_sale, product, quantity, price in items
        if sale is not None and sale == item_sale and when is not None
        and datetime.datetime(2020, 1, 1) <= when <= datetime.datetime(2030, 12, 31)
    )
    fact = build_fact_sales(
        spark.createDataFrame(transactions, TABLES["stg_transactions"].columns),
        spark.createDataFrame(items, TABLES["stg_transaction_items"].columns),
        spark.createDataFrame(customers, "customer_key bigint, customer_id_natural int, is_current boolean"),
        spark.createDataFrame(products, "product_key bigint, product_id_natural int"),
        2020, 2030,
    )
    assert Counter(map(tuple, fact.collect())) == expected


def test_minute_counts(spark):
    pick = random.Random(5)
    times = [START + datetime.timedelta(milliseconds=pick.randrange(600_000)) for _ in range(500)] + [None] * 7
    readings = spark.createDataFrame([(t and t.isoformat(),) for t in times], "t string").select(
        F.try_to_timestamp("t").alias("event_time")
    )
    expected = Counter(t.strftime("%Y-%m-%d %H:%M:00") for t in times if t)
    assert dict(map(tuple, sensors.minute_counts(readings).collect())) == expected
