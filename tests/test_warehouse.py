import datetime
import functools
import random
import re
import time
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom.functions.calendar import moment
from starloom.operators import quality
from starloom.operators.dimensions import CUSTOMERS, PRODUCTS, load_dimension
from starloom.operators.quality import ConstraintViolation
from starloom.plans import pipeline, sizing
from starloom.plans.store import TableStore, file_bytes
from starloom.schemas import SOURCE_FILES, TABLES

LOADED = datetime.datetime(2025, 1, 1)


def _write_sources(folder, customers=40, products=10, campaigns=4, transactions=60):
    """Small CSV sources with the shapes and value ranges of the real ones."""
    pick = random.Random(3)
    names = {
        "customers.csv": ["customer_id,name,email,city,signup_date"] + [
            f'{i},"Nama, {i}",n{i}@example.com,Kota {i % 5},2024-0{i % 9 + 1}-11 10:20:30'
            for i in range(1, customers + 1)
        ],
        "products.csv": ["product_id,product_name,category,price"] + [
            f"{i},Barang {i},Kategori {i % 3},{i * 5000}" for i in range(1, products + 1)
        ],
        "marketing_campaigns.csv": ["campaign_id,campaign_name,start_date,end_date,channel"] + [
            f"{i},Sale {i},2025-01-0{i} 00:00:00,2025-02-0{i} 00:00:00,SEO" for i in range(1, campaigns + 1)
        ],
    }
    heads, items = ["transaction_id,customer_id,transaction_date,total_amount"], []
    for t in range(1, transactions + 1):
        lines = [(pick.randint(1, products), pick.randint(1, 3)) for _ in range(pick.randint(1, 6))]
        items += [(t, p, q, p * 5000) for p, q in lines]
        total = sum(p * 5000 * q for p, q in lines)
        heads.append(f"{t},{pick.randint(1, customers)},2025-0{t % 9 + 1}-10 12:00:00,{total}")
    names["transactions.csv"] = heads
    names["transaction_items.csv"] = ["transaction_item_id,transaction_id,product_id,quantity,price"] + [
        f"{n},{t},{p},{q},{price}" for n, (t, p, q, price) in enumerate(items, 1)
    ]
    for file, lines in names.items():
        (folder / file).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return len(items)


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "warehouse"))


def test_pipeline_from_csv_is_idempotent(spark, store, tmp_path):
    items = _write_sources(tmp_path)
    loaded = pipeline.stage_csv(store, str(tmp_path))
    assert loaded == {
        "stg_customers": 40, "stg_products": 10, "stg_marketing_campaigns": 4, "stg_transactions": 60,
        "stg_transaction_items": items,
    }
    first = pipeline.transform(store, load_time=LOADED)
    assert first == {
        "dim_customer": 41, "dim_product": 11, "dim_campaign": 5, "dim_date": 4018, "fact_sales": items,
    }
    before = {name: sorted(store.read(name).collect()) for name in first}
    assert pipeline.transform(store) == first
    assert {name: sorted(store.read(name).collect()) for name in first} == before

    fact = store.read("fact_sales")
    headers = {r.transaction_id: r.total_amount for r in store.read("stg_transactions").collect()}
    sums = {r[0]: r[1] for r in fact.groupBy("transaction_id_natural").sum("total_amount").collect()}
    assert sums == headers

    store.register()
    assert spark.sql("SELECT count(*) FROM dwh.dim_customer").collect()[0][0] == 41
    assert spark.sql("SELECT count(*) FROM staging.stg_customers").collect()[0][0] == 40
    _write_sources(tmp_path, customers=45)
    pipeline.stage_csv(store, str(tmp_path), {"stg_customers": SOURCE_FILES["stg_customers"]})
    pipeline.refresh_dimension(store, pipeline.DIMENSION_LOADS[0])
    store.register()
    assert spark.sql("SELECT max(customer_key) FROM dwh.dim_customer").collect()[0][0] == 45


def test_created_tables_hold_unknown_members_only(store):
    pipeline.create_tables(store, LOADED)
    assert {name: store.read(name).count() for name in TABLES} == {
        name: 1 if TABLES[name].unknown else 0 for name in TABLES
    }
    assert store.read("fact_sales").schema == TABLES["fact_sales"].columns
    pipeline.create_tables(store)
    assert all(store.versions(name) == [1] for name in TABLES)


def _customers(spark, *names):
    rows = [(i, name, None, None, None) for i, name in enumerate(names, 1)]
    return spark.createDataFrame(rows, TABLES["stg_customers"].columns)


@pytest.mark.parametrize("bad, rule", [(None, "name is NULL"), ("x" * 256, "name is longer than 255")])
def test_broken_rows_are_not_published(spark, store, bad, rule):
    pipeline.create_tables(store, LOADED)
    pipeline.stage(store, {"stg_customers": _customers(spark, "good", bad)})
    with pytest.raises(Exception, match=rule):
        pipeline.refresh_dimension(store, pipeline.DIMENSION_LOADS[0])
    assert store.read("dim_customer").count() == 1
    pipeline.stage(store, {"stg_customers": _customers(spark, "good", "better")})
    assert pipeline.refresh_dimension(store, pipeline.DIMENSION_LOADS[0]) == 3
    assert store.versions("dim_customer") == [1, 3]


def test_failed_job_leaves_the_table(spark, store):
    pipeline.create_tables(store, LOADED)
    twice = _customers(spark, "a").union(_customers(spark, "b"))
    pipeline.stage(store, {"stg_customers": twice})
    assert store.read("stg_customers").count() == 2
    with pytest.raises(Exception, match="occurs twice"):
        pipeline.refresh_dimension(store, pipeline.DIMENSION_LOADS[0])
    assert store.read("dim_customer").count() == 1


def test_fact_with_unknown_dates_is_not_published(spark, store):
    pipeline.create_tables(store, LOADED)
    moment = datetime.datetime(2025, 6, 1)
    pipeline.stage(store, {
        "stg_transactions": spark.createDataFrame([(1, 1, moment, None)], TABLES["stg_transactions"].columns),
        "stg_transaction_items": spark.createDataFrame(
            [(1, 1, 1, 1, Decimal(5))], TABLES["stg_transaction_items"].columns
        ),
    })
    with pytest.raises(ConstraintViolation, match="20250601"):
        pipeline.refresh_fact(store)
    assert store.read("fact_sales").count() == 0
    pipeline.refresh_calendar(store, 2025, 2025)
    assert pipeline.refresh_fact(store) == 1


def test_fact_without_unknown_member_is_not_published(spark, store):
    pipeline.create_tables(store, LOADED)
    store.write("dim_campaign", store.read("dim_campaign").filter("campaign_key <> 0"))
    with pytest.raises(ConstraintViolation, match="dim_campaign"):
        pipeline.refresh_fact(store)
    assert store.versions("fact_sales") == [1]


def test_calendar_grows_and_keeps_edits(store):
    pipeline.create_tables(store, LOADED)
    assert pipeline.refresh_calendar(store, 2024, 2024) == 366
    days = store.read("dim_date")
    store.write("dim_date", days.withColumn("is_holiday", days.date_key == 20241225))
    assert pipeline.refresh_calendar(store, 2023, 2025) == 365 + 366 + 365
    assert [r.date_key for r in store.read("dim_date").filter("is_holiday").collect()] == [20241225]


def test_old_versions_are_dropped_but_the_last_ones_stay(spark, store):
    frames = []
    for name in "abcd":
        store.write("stg_customers", _customers(spark, name))
        frames.append(store.read("stg_customers"))
    assert store.versions("stg_customers") == [3, 4]
    assert [frame.collect()[0].name for frame in frames[2:]] == ["c", "d"]


def test_reading_an_unwritten_table_fails(store):
    with pytest.raises(LookupError):
        store.read("dim_date")


PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_settings_follow_the_data_in_a_session_of_their_own(spark):
    own = sizing.sized(spark, 640 * 2**20)
    assert own.conf.get(PARTITIONS) == "10" and spark.conf.get(PARTITIONS, None) is None
    assert own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert sizing.sized(spark, 5).conf.get(PARTITIONS) == spark.conf.get("spark.sql.shuffle.partitions")
    assert sizing.size_settings(10**14, 200) == {
        PARTITIONS: "50000",
        "spark.sql.files.maxPartitionBytes": "1000000000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(64 * 2**20),
    }
    spark.conf.set(PARTITIONS, "3")
    try:
        assert sizing.sized(spark, 640 * 2**20).conf.get(PARTITIONS) == "3"
    finally:
        spark.conf.unset(PARTITIONS)


def test_every_query_is_built_in_the_size_of_its_folder(spark, monkeypatch):
    import __spark_entry__ as entry

    monkeypatch.setattr(entry, "file_bytes", lambda spark, folder: 640 * 2**20)
    seen = []
    for query in entry._QUERIES:
        @functools.wraps(query)
        def look(own, folder):
            seen.append(own.conf.get(PARTITIONS))

        entry._in_size(look)(spark, "/root/testdata/sf0.001")
    assert seen == ["10"] * len(entry._QUERIES)
    names = set(entry.queries()) & {query.__name__ for query in entry._QUERIES}
    assert len(names) == len(seen)
    frame = entry.queries()["duplicate_keys"](spark, "/root/testdata/sf0.001")
    assert frame.sparkSession.conf.get(PARTITIONS) == "10" and spark.conf.get(PARTITIONS, None) is None


def test_two_transforms_at_once_leave_the_session_as_it_was(spark, tmp_path):
    _write_sources(tmp_path)
    before = dict(spark.conf.getAll)
    stores = [TableStore(spark, str(tmp_path / name)) for name in "ab"]
    for store in stores:
        pipeline.stage_csv(store, str(tmp_path))
    with ThreadPoolExecutor(2) as pool:
        counts = list(pool.map(lambda store: pipeline.transform(store, load_time=LOADED), stores))
    assert counts[0] == counts[1] and dict(spark.conf.getAll) == before


def test_views_follow_the_tables(spark, store, tmp_path):
    for customers in (10, 20, 30, 40):
        _write_sources(tmp_path, customers=customers)
        pipeline.stage_csv(store, str(tmp_path))
        loaded = pipeline.transform(store, load_time=LOADED)
        if customers == 10:
            store.register()
        count = "SELECT (SELECT count(*) FROM staging.stg_customers), (SELECT count(*) FROM dwh.dim_customer), " \
            "(SELECT count(*) FROM dwh.fact_sales)"
        assert tuple(spark.sql(count).first()) == (customers, customers + 1, loaded["fact_sales"])
    assert spark.table("dwh.fact_sales").schema == TABLES["fact_sales"].columns
    other = TableStore(spark, str(tmp_path / "other"))
    pipeline.stage_csv(other, str(tmp_path), {"stg_customers": SOURCE_FILES["stg_customers"]})
    assert spark.sql("SELECT count(*) FROM staging.stg_customers").first()[0] == 40


def test_repeated_keys_are_not_published(spark, store):
    pipeline.create_tables(store, LOADED)
    member = store.read("dim_product")
    with pytest.raises(ConstraintViolation, match="product_key occurs twice"):
        store.write("dim_product", member.union(member))
    assert store.read("dim_product").count() == 1


def test_lost_dates_are_counted(store, tmp_path):
    (tmp_path / "marketing_campaigns.csv").write_text(
        "campaign_id,campaign_name,start_date,end_date,channel\n"
        "1.0,a,06/15/2025,20250616,x\n2,b,soon,,x\n3,c,soon,2025-06-15T10:00:00+07:00,x\n"
    )
    files = {"stg_marketing_campaigns": "marketing_campaigns.csv"}
    loaded = pipeline.stage_csv(store, str(tmp_path), files)["stg_marketing_campaigns"]
    assert loaded == 3 and loaded.lost_dates == {"start_date": 2}
    rows = {r.campaign_id: (r.start_date, r.end_date) for r in store.read("stg_marketing_campaigns").collect()}
    day = datetime.datetime
    assert rows == {1: (day(2025, 6, 15), day(2025, 6, 16)), 2: (None, None), 3: (None, day(2025, 6, 15, 3))}
    loaded = pipeline.stage_csv(store, str(tmp_path), files, date_formats=())["stg_marketing_campaigns"]
    assert loaded.lost_dates == {"start_date": 3, "end_date": 1}


def test_undeclared_columns_are_named(spark, store):
    rows = _customers(spark, "a").selectExpr("*", "1 AS shoe_size")
    with pytest.warns(UserWarning, match="shoe_size"):
        pipeline.stage(store, {"stg_customers": rows})
    assert store.read("stg_customers").columns == TABLES["stg_customers"].columns.names


def test_files_of_the_fact_hold_few_months(spark, store, tmp_path):
    from pyspark.sql import functions as F

    _write_sources(tmp_path, transactions=1000)
    pipeline.stage_csv(store, str(tmp_path))
    # Files this small are otherwise merged into one.
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    for name, value in (("adaptive.coalescePartitions.enabled", "false"), ("shuffle.partitions", "40")):
        spark.conf.set(f"spark.sql.{name}", value)
    try:
        pipeline.transform(store, load_time=LOADED)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    fact = store.read("fact_sales").select("date_key", F.input_file_name().alias("file"))
    months = fact.groupBy("file").agg(F.countDistinct(F.expr("date_key DIV 100")).alias("months"))
    march = fact.filter("date_key BETWEEN 20250301 AND 20250331").select("file").distinct()
    files = months.count()
    assert files >= 5 and months.agg(F.avg("months")).first()[0] < 2 and march.count() < files / 2
    one = store.read("fact_sales").filter("date_key BETWEEN 20250301 AND 20250331")
    assert "GreaterThanOrEqual(date_key,20250301)" in one._jdf.queryExecution().executedPlan().toString()


def test_sources_are_scanned_once_for_each_use(spark):
    import __spark_entry__ as entry

    def scans(name, column):
        frame = entry.queries()[name](spark, "/root/testdata/sf0.001")
        frame.collect()
        ran = frame._jdf.queryExecution().executedPlan().toString()
        ran = re.sub(r"== Initial Plan ==.*?(?=Subquery|$)", "", ran, flags=re.S)
        # Uses of one exchange or subquery are printed again, with the numbers of the first.
        return len(set(re.findall(rf"FileScan parquet \[{column}#\d+", ran)))

    # Of the batch: its rows, its ids, and its ids once more for the guard.
    assert 0 < scans("dim_customer_upsert", "c_custkey") <= 3
    assert scans("fact_sales", "c_custkey") == 0 and scans("fact_sales", "l_orderkey") == 1


def test_scratch_is_deleted_when_the_application_ends(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    script = (
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        f".config('spark.checkpoint.dir', 'file://{tmp_path}').getOrCreate()\n"
        "import __spark_entry__ as entry\n"
        "folder = entry._scratch(spark)\n"
        "spark.range(5).write.parquet(folder + '/t')\n"
        "import os; print(os.path.exists(folder.removeprefix('file://') + '/t'))\n"
        "spark.stop()\n"
    )
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=Path(__file__).parent.parent, capture_output=True, text=True, timeout=120
    )
    assert done.stdout.strip() == "True", done.stderr[-2000:]
    deadline = datetime.datetime.now() + datetime.timedelta(seconds=20)
    while list(tmp_path.glob("starloom-*")) and datetime.datetime.now() < deadline:
        pass
    assert list(tmp_path.glob("starloom-*")) == []


def test_reference_checks_shuffle_broken_rows_alone(spark):
    """Keys of any sign and spread, known ones often and next to unknown ones; no join by shuffle, however large the parent."""
    draw = random.Random(4)
    keys = [draw.choice([draw.randrange(-200, 200), draw.randrange(-(2**63), 2**63)]) for _ in range(400)]
    known = [*draw.sample(keys, 200), -(2**63), 2**63 - 1, -1, 64, None]
    used = [*keys, *keys, -1, 63, 127, None]
    parent = spark.createDataFrame([(key,) for key in known], "k long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = quality.orphans(spark.createDataFrame([(key,) for key in used], "id long"), "id", parent, "k")
        expected = Counter(key for key in used if key is not None and key not in set(known))
        assert {row.key: row.row_count for row in found.collect()} == expected
        assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_checks(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "bb"), (2, None), (None, "c"), (None, "c")], "id int, v string")
    assert [tuple(r) for r in quality.duplicate_keys(rows, "id").collect()] == [(1, 2)]
    assert dict(map(tuple, quality.null_counts(rows, ("id", "v")).collect())) == {"id": 2, "v": 1}
    assert dict(map(tuple, quality.length_counts(rows, {"v": 1}).collect())) == {"v": 1}
    wide = spark.createDataFrame([(2**31, -(2**15) - 1), (-(2**31), 2**15 - 1)], "a bigint, b bigint")
    assert dict(map(tuple, quality.range_counts(wide, {"a": "int", "b": "smallint"}).collect())) == {"a": 1, "b": 1}
    parent = spark.createDataFrame([(1,)], "k bigint")
    assert [tuple(r) for r in quality.orphans(rows, "id", parent, "k").collect()] == [("id", 2, 1)]
    customers = spark.createDataFrame(
        [(1, 1, None, "e", "x" * 101), (1, 2, "n", None, None), (None, 2, "m", None, None)],
        "customer_key bigint, customer_id_natural int, name string, email string, city string",
    )
    broken = quality.declared_violations(customers, TABLES["dim_customer"], {}).filter("violations > 0")
    assert sorted(map(tuple, broken.collect())) == [
        ("dim_customer", "city", "too long", 1), ("dim_customer", "customer_id_natural", "repeated", 1),
        ("dim_customer", "customer_key", "missing", 1), ("dim_customer", "customer_key", "repeated", 1),
        ("dim_customer", "name", "missing", 1),
    ]
    quality.require_clean(rows.filter("false"), "nothing")
    with pytest.raises(ConstraintViolation, match="rows"):
        quality.require_clean(rows, "rows")


@pytest.fixture
def many_files(spark):
    """Dimensions of several files, as large ones have."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "20"}
    kept = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in kept.items():
        spark.conf.set(name, value)


def _products(spark, ids, price=10):
    columns = TABLES["stg_products"].columns
    return spark.createDataFrame([(i, f"Barang {i}", "k", Decimal(price)) for i in ids], columns)


def _refresh_products(store, rows):
    pipeline.stage(store, {"stg_products": rows})
    return pipeline.refresh_dimension(store, PRODUCTS, LOADED)


def _bytes(store, paths):
    return sum(file_bytes(store.spark, f"{store.folder('dim_product')}/{path}") for path in paths)


def test_an_upsert_writes_only_the_files_it_changes(spark, store, many_files):
    assert _refresh_products(store, _products(spark, range(1, 10_001))) == 10_001
    before = {entry.path: entry for entry in store.files("dim_product")}
    assert len(before) == 20
    ranges = sorted((entry.low, entry.high) for entry in before.values())
    assert all(one[1] < two[0] for one, two in zip(ranges, ranges[1:]))

    # A whole batch again, of which one in a hundred changed, side by side, and two are new.
    changed = range(3000, 3100)
    batch = _products(spark, [i for i in range(1, 10_003) if i not in changed]).union(_products(spark, changed, 99))
    assert _refresh_products(store, batch) == 10_003
    after = {entry.path for entry in store.files("dim_product")}
    written = after - set(before)
    assert len(set(before) - after) <= 2
    assert _bytes(store, written) < 0.3 * _bytes(store, before)
    rows = {r.product_id_natural: r for r in store.read("dim_product").collect()}
    assert len(rows) == 10_003
    assert all(r.product_key == i and r.master_price == (0 if i == 0 else 99 if i in changed else 10) or i == 0 for i, r in rows.items())
    assert sum(entry.rows for entry in store.files("dim_product")) == 10_003


def test_a_batch_that_changes_nothing_writes_nothing(spark, store, many_files):
    batch = _products(spark, range(1, 101))
    assert _refresh_products(store, batch) == 101
    versions = store.versions("dim_product")
    assert _refresh_products(store, batch) == 101
    assert store.versions("dim_product") == versions


def test_rewritten_files_equal_whole_rewrites(spark, store, tmp_path, many_files):
    pick, whole = random.Random(5), TableStore(spark, str(tmp_path / "whole"))
    for number in range(4):
        ids = pick.sample(range(1, 400), 120)
        batch = _products(spark, ids, 10 + number)
        _refresh_products(store, batch)
        pipeline.stage(whole, {"stg_products": batch})
        current = pipeline._current(whole, "dim_product", LOADED)
        whole.write("dim_product", load_dimension(current, whole.read("stg_products"), PRODUCTS, moment(LOADED)))
        assert sorted(store.read("dim_product").collect()) == sorted(whole.read("dim_product").collect())


def test_customers_come_back_by_a_rewrite(spark, store, many_files):
    pipeline.stage(store, {"stg_customers": _customers(spark, *"abcdef")})
    pipeline.refresh_dimension(store, CUSTOMERS, LOADED)
    gone = store.read("dim_customer").withColumn("is_current", F.col("customer_id_natural") != 3)
    store.write("dim_customer", gone)
    pipeline.refresh_dimension(store, CUSTOMERS, LOADED)
    assert store.read("dim_customer").filter("NOT is_current").count() == 0
    assert len(store.files("dim_customer")) > 3


def test_files_of_old_versions_live_as_long_as_they_are_listed(spark, store, many_files):
    _refresh_products(store, _products(spark, range(1, 201)))
    store.register()
    for price in range(11, 16):
        _refresh_products(store, _products(spark, [5, 6], price))
        listed = {entry.path for entry in store.files("dim_product")}
        assert any(path.startswith("v0000000001/") for path in listed)
        assert spark.sql("SELECT count(*), max(master_price) FROM dwh.dim_product").first()[:] == (201, price)
        assert len(store.versions("dim_product")) <= 2
    left = {f"{file.parent.name}/{file.name}" for file in Path(store.folder("dim_product")).rglob("v*/*.parquet")}
    old = {entry.path for entry in store._listed(store._version_folder("dim_product", store.versions("dim_product")[0]))}
    assert left == listed | old
    _refresh_products(store, _products(spark, range(1, 201), 77))
    _refresh_products(store, _products(spark, range(1, 201), 78))
    assert store.read("dim_product").filter("master_price = 78").count() == 200
    assert len(list(Path(store.folder("dim_product")).glob("v*"))) <= 3


@pytest.mark.parametrize("ids, rule", [([3, 4, 4], "occurs twice in one batch: 4"), ([3, None], "is NULL")])
def test_broken_batches_change_nothing(spark, store, ids, rule):
    _refresh_products(store, _products(spark, range(1, 5)))
    with pytest.raises(ConstraintViolation, match=rule):
        _refresh_products(store, _products(spark, ids))
    assert store.versions("dim_product") == [1]


def test_a_failing_load_ends_its_siblings(spark, store):
    pipeline.stage(store, {"stg_customers": _customers(spark, "a")})
    slow = spark.range(0, 4, 1, 4).select(
        F.expr("reduce(sequence(0, 30000000), 0D, (s, i) -> s + sqrt(cast(i + id AS double)))").alias("n")
    ).selectExpr("cast(n AS bigint) AS product_id", "'x' AS product_name", "'y' AS category", "cast(1 AS decimal(18,2)) AS price")
    broken = _customers(spark, "b").withColumn("customer_id", F.raise_error(F.lit("broken source")).cast("bigint"))
    context, stopped = spark.sparkContext, []
    plain = type(context).cancelJobsWithTag
    started = time.monotonic()
    try:
        type(context).cancelJobsWithTag = lambda self, tag: (stopped.append(tag), plain(self, tag))[1]
        with pytest.raises(Exception, match="broken source"):
            pipeline.stage(store, {"stg_customers": broken, "stg_products": slow})
    finally:
        type(context).cancelJobsWithTag = plain
    assert stopped and time.monotonic() - started < 20
    assert store.versions("stg_customers") == [1] and not store.exists("stg_products")
