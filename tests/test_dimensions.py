import datetime
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starloom.operators import dimensions
from starloom.operators.dimensions import CUSTOMERS, PRODUCTS, load_dimension, new_dimension
from starloom.operators.keys import assign_keys
from starloom.schemas import TABLES

FIRST = datetime.datetime(2024, 1, 1)
SECOND = datetime.datetime(2024, 2, 1)
SIGNED = datetime.datetime(2020, 5, 5)
FAILED = (PySparkException, Py4JJavaError)


def _at(moment):
    return F.lit(moment).cast("timestamp_ntz")


def _customers(spark, *rows):
    return spark.createDataFrame(list(rows), TABLES["stg_customers"].columns)


def _by_id(rows):
    return {row.customer_id_natural: row for row in rows.collect()}


def _loaded(spark, *rows):
    return load_dimension(new_dimension(spark, CUSTOMERS, _at(FIRST)), _customers(spark, *rows), CUSTOMERS, _at(FIRST))


def test_first_load_numbers_by_natural_id(spark):
    rows = _by_id(_loaded(
        spark, (30, "c", None, None, SIGNED), (10, "a", "a@x", "Malang", None), (20, "b", None, None, None)
    ))
    assert {key: row.customer_key for key, row in rows.items()} == {0: 0, 10: 1, 20: 2, 30: 3}
    assert tuple(rows[0]) == (0, 0, "Unknown", None, None, None, FIRST, None, True)
    assert tuple(rows[10]) == (1, 10, "a", "a@x", "Malang", None, FIRST, None, True)


def test_second_batch(spark):
    first = _loaded(spark, (1, "a", "a@x", "Malang", SIGNED), (2, "b", None, "Gresik", SIGNED))
    closed = first.withColumns({"is_current": F.lit(False), "row_end_date": _at(SIGNED)})
    batch = _customers(spark, (1, "A", None, "Gresik", SECOND), (3, "c", None, None, SECOND))
    rows = _by_id(load_dimension(closed, batch, CUSTOMERS, _at(SECOND)))
    assert tuple(rows[1]) == (1, 1, "A", None, "Gresik", SIGNED, FIRST, None, True)
    assert tuple(rows[2]) == (2, 2, "b", None, "Gresik", SIGNED, FIRST, SIGNED, False)
    assert tuple(rows[3]) == (3, 3, "c", None, None, SECOND, SECOND, None, True)
    assert len(rows) == 4


def test_rerun_changes_nothing(spark):
    batch = _customers(spark, (5, "e", None, None, SIGNED), (4, "d", None, None, SIGNED))
    once = load_dimension(new_dimension(spark, CUSTOMERS, _at(FIRST)), batch, CUSTOMERS, _at(FIRST))
    twice = load_dimension(once, batch, CUSTOMERS, _at(SECOND))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_natural_id_zero_overwrites_the_unknown_member(spark):
    rows = _by_id(_loaded(spark, (0, "Zero", None, "Malang", SIGNED)))
    assert list(rows) == [0]
    assert (rows[0].customer_key, rows[0].name, rows[0].city, rows[0].signup_date) == (0, "Zero", "Malang", None)


@pytest.mark.parametrize("known", [True, False])
def test_duplicate_natural_id_fails(spark, known):
    start = _loaded(spark, (7, "x", None, None, None)) if known else _loaded(spark)
    batch = _customers(spark, *[(7, f"x{i}", None, None, None) for i in range(2)])
    with pytest.raises(FAILED, match="occurs twice"):
        load_dimension(start, batch, CUSTOMERS, _at(SECOND)).collect()


def test_null_natural_id_fails(spark):
    with pytest.raises(FAILED, match="is NULL"):
        _loaded(spark, (None, "x", None, None, None), (1, "y", None, None, None)).collect()


def test_id_beyond_int_fails(spark):
    with pytest.raises(FAILED):
        _loaded(spark, (2**31, "x", None, None, None)).collect()


def test_product_and_campaign_columns(spark):
    staged = spark.createDataFrame([(1, "p", "c", None)], TABLES["stg_products"].columns)
    rows = load_dimension(new_dimension(spark, PRODUCTS, _at(FIRST)), staged, PRODUCTS, _at(FIRST))
    assert sorted(map(tuple, rows.collect())) == [(0, 0, "Unknown", None, None), (1, 1, "p", "c", None)]
    assert rows.columns == TABLES["dim_product"].columns.names


def test_keys_are_the_rank_over_scattered_ids(spark):
    ids = random.Random(7).sample(range(-(2**31), 2**31), 3000) + list(range(65_000, 66_000))
    ids = list(dict.fromkeys(ids))
    rows = spark.createDataFrame([(i,) for i in ids], "id int").repartition(7)
    keyed = assign_keys(rows, "key", "id", F.lit(100))
    assert dict(map(tuple, keyed.select("id", "key").collect())) == {
        value: 101 + rank for rank, value in enumerate(sorted(ids))
    }


def test_keys_need_int_ids(spark):
    with pytest.raises(TypeError):
        assign_keys(spark.range(3), "key", "id", F.lit(0))


def test_calendar(spark):
    days = dimensions.calendar_days(spark, 2020, 2030)
    assert days.columns == TABLES["dim_date"].columns.names
    rows = {row.full_date: row for row in days.collect()}
    assert len(rows) == 4018
    assert tuple(rows[datetime.date(2024, 12, 30)]) == (
        20241230, datetime.date(2024, 12, 30), 1, "Monday   ", 30, 365, 12, "December ", 4, 2024, False, False,
    )
    assert all(row.day_of_week == day.isoweekday() for day, row in rows.items())
    assert all(row.is_weekend == (day.isoweekday() > 5) for day, row in rows.items())
    assert rows[datetime.date(2021, 1, 1)].year_num == 2021 and rows[datetime.date(2024, 9, 1)].day_name == "Sunday   "


def test_insert_absent_keeps_existing_and_first_of_copies(spark):
    existing = spark.createDataFrame([(1, "old")], "id int, v string")
    rows = spark.createDataFrame([(1, "new"), (2, "b"), (2, "b")], "id int, v string")
    assert sorted(map(tuple, dimensions.insert_absent(existing, rows, "id").collect())) == [(1, "old"), (2, "b")]
