import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from starloom.operators.quality import ConstraintViolation
from starloom.plans import pipeline
from starloom.plans.store import TableStore, WriteConflict, _digest, _digest_text
from starloom.schemas import TABLES

LOADED = datetime.datetime(2025, 1, 1)
DWH = ("dim_customer", "dim_product", "dim_campaign", "dim_date", "fact_sales")


def _sources(spark, city="a"):
    moment = datetime.datetime(2025, 6, 1)
    rows = {
        "stg_customers": [(i, f"n{i}", None, city, moment) for i in (1, 2, 3)],
        "stg_products": [(i, f"p{i}", "k", Decimal(5)) for i in (1, 2)],
        "stg_marketing_campaigns": [(1, "c", moment, moment, "SEO")],
        "stg_transactions": [(i, i, moment, None) for i in (1, 2, 3)],
        "stg_transaction_items": [(i, i, 1, 2, Decimal(5)) for i in (1, 2, 3)],
    }
    return {name: spark.createDataFrame(values, TABLES[name].columns) for name, values in rows.items()}


@pytest.fixture(scope="module")
def source_rows(spark):
    return _sources(spark)


@pytest.fixture
def store(spark, tmp_path, source_rows):
    store = TableStore(spark, str(tmp_path / "warehouse"))
    pipeline.stage(store, source_rows)
    return store


def _transform(store, **options):
    return pipeline.transform(store, 2025, 2025, LOADED, **options)


def _written(counts):
    return {name for name, rows in counts.items() if rows.written}


def _cities(store):
    joined = store.read("fact_sales").join(store.read("dim_customer"), "customer_key")
    return sorted({row.city for row in joined.select("city").distinct().collect()})


def test_readers_see_either_star(spark, store, monkeypatch):
    _transform(store)
    old, seen, build = store.snapshot(), [], pipeline._build_fact

    def look(work, *rest):
        seen.append((_cities(store), _cities(store.snapshot()), work.read("dim_customer").select("city").distinct().count()))
        return build(work, *rest)

    monkeypatch.setattr(pipeline, "_build_fact", look)
    pipeline.stage(store, {"stg_customers": _sources(spark, "b")["stg_customers"]})
    assert _written(_transform(store)) == {"dim_customer", "fact_sales"}
    assert seen == [(["a"], ["a"], 2)]  # the new city and the unknown member's within the transaction alone
    assert _cities(old) == ["a"] and _cities(store) == _cities(store.snapshot()) == ["b"]
    with pytest.raises(TypeError, match="reading alone"):
        old.write("dim_date", old.read("dim_date"))


def test_a_failing_fact_leaves_the_whole_star(spark, store):
    _transform(store)
    before, release = {name: store.versions(name) for name in DWH}, store.snapshot()
    late = spark.createDataFrame([(1, 1, datetime.datetime(2026, 1, 1), None)], TABLES["stg_transactions"].columns)
    pipeline.stage(store, {"stg_customers": _sources(spark, "b")["stg_customers"], "stg_transactions": late})
    store.write("dim_campaign", store.read("dim_campaign").filter("campaign_key <> 0"))
    before["dim_campaign"] = store.versions("dim_campaign")
    with pytest.raises(ConstraintViolation, match="no unknown member"):
        _transform(store)
    assert {name: store.versions(name) for name in DWH} == before
    assert _cities(store) == _cities(release) == ["a"]


def test_the_later_of_two_writers_of_a_table_fails(store):
    pipeline.create_tables(store, LOADED)
    empty, member = store.read("dim_date"), store.read("dim_product")
    with pytest.raises(WriteConflict, match="dim_date"):
        with store.transaction() as work:
            work.write("dim_date", empty)
            work.write("dim_product", member)
            store.write("dim_date", empty)
    assert store.versions("dim_date")[-1] == 3 and store.versions("dim_product") == [1]
    with pytest.raises(WriteConflict, match="dim_customer"):  # the fact refers to it
        with store.transaction() as work:
            work.write("fact_sales", work.read("fact_sales"))
            store.write("dim_customer", store.read("dim_customer"))
    with store.transaction() as work:  # different tables do not meet
        work.write("dim_date", empty)
        store.write("dim_product", member)
    assert store.read("dim_date").count() == 0 and store.read("dim_product").count() == 1
    assert store.current("dim_date").versions[-1] == 4


def test_unchanged_input_costs_nothing(spark, store, source_rows):
    first = _transform(store)
    assert _written(first) == set(DWH)
    folders = {name: store._versions(name) for name in DWH}
    assert _transform(store) == first and not _written(_transform(store))
    pipeline.stage(store, {name: rows.orderBy(F.desc(rows.columns[0])).coalesce(1) for name, rows in source_rows.items()})
    again = _transform(store)
    assert again == first and not _written(again)
    assert {name: store._versions(name) for name in DWH} == folders
    # One item more leaves the dimensions; a dimension written in another way, or more years, are noticed.
    items = source_rows["stg_transaction_items"]
    pipeline.stage(store, {"stg_transaction_items": items.union(items.limit(1))})
    assert _written(_transform(store)) == {"fact_sales"}
    store.write("dim_customer", store.read("dim_customer").withColumn("is_current", F.col("customer_id_natural") != 2))
    assert _written(_transform(store)) == {"dim_customer", "fact_sales"}
    assert store.read("dim_customer").filter("NOT is_current").count() == 0
    assert _written(pipeline.transform(store, 2025, 2026, LOADED)) == {"dim_date", "fact_sales"}
    assert {"dim_date", "fact_sales"} <= _written(pipeline.transform(store, 2025, 2026, LOADED, rebuild=True))


@pytest.mark.parametrize("one, other, same", [
    ([(1, "a"), (2, "b")], [(2, "b"), (1, "a")], True),
    ([(1, None)], [(None, "1")], False),
    ([(None, None)], [(None, None), (None, None)], False),
    ([(1, "a"), (1, "a")], [(2, "b"), (2, "b")], False),
    ([(1, "a"), (2, "b")], [(1, "b"), (2, "a")], False),
    ([(1, "")], [(1, None)], False),
])
def test_digests_tell_sets_of_rows_apart(spark, one, other, same):
    found = [
        spark.createDataFrame(rows, "a int, b string").agg(F.count(F.lit(1)), *_digest(["a", "b"])).first()
        for rows in (one, other)
    ]
    assert (found[0] == found[1]) == same


def test_digests_are_summed_without_decimals(spark):
    """Parts of the hashes are summed as longs and give the sums of the whole hashes; nothing to sum is told apart."""
    rows = spark.range(500).selectExpr("CAST(id AS INT) AS a", "IF(id % 7 = 0, NULL, CAST(id AS STRING)) AS b")
    cells = [F.col("a"), F.col("a").isNull(), F.col("b"), F.col("b").isNull()]
    whole = [F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")) for seed in (0, 1)]
    for frame in (rows, rows.limit(0)):
        count = F.count(F.lit(1)).alias("rows")
        summed = frame.agg(count, *_digest(["a", "b"]))
        assert {kind for _, kind in summed.dtypes} == {"bigint"}
        assert _digest_text(summed.first().asDict()) == ":".join(map(str, frame.agg(count, *whole).first()))


def test_rows_are_dealt_anew_by_their_size(spark, monkeypatch, tmp_path):
    """The rows staged in another order go to no fixed number of tasks."""
    rows = {name: spark.createDataFrame([], TABLES[name].columns) for name in TABLES if name.startswith("stg_")}
    staged = []
    monkeypatch.setattr(entry.tpch, "staging", lambda spark, folder: rows)
    monkeypatch.setattr(entry, "_new_store", lambda spark, purpose: TableStore(spark, str(tmp_path)))
    monkeypatch.setattr(entry.pipeline, "stage", lambda store, sources: staged.append(sources))
    monkeypatch.setattr(entry.pipeline, "transform", lambda *_, **__: {"dim_date": pipeline.RowCount(0)})
    monkeypatch.setattr(TableStore, "read", lambda store, name: spark.createDataFrame([], TABLES[name].columns))
    entry.transform_unchanged(spark, "")
    plans = [frame._jdf.queryExecution().logical().toString() for frame in staged[1].values()]
    assert len(plans) == 5 and all("RepartitionByExpression" in plan and ", 7" not in plan for plan in plans)


def test_few_releases_stay(spark, store):
    for _ in range(12):
        store.write("stg_products", store.read("stg_products").limit(1).coalesce(1))
    assert len(store._numbers()) == 10 and store.versions("stg_products")[-1] == 13
