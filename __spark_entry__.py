
from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.calendar import moment
from starloom.functions.coerce import typed
from starloom.operators import dimensions, fact, quality
from starloom.plans import analytics, pipeline
from starloom.plans.scratch import dropped_at_exit, shared_folder
from starloom.plans.sizing import sized
from starloom.plans.store import TableStore, file_bytes
from starloom.schemas import SOURCE_FILES, TABLES
from starloom.sources import tpch
from starloom.streaming import sensors

# The calendar ends before the last orders, so the date filter has work to do.
FIRST_YEAR, LAST_YEAR = 1995, 2000
LOADED = datetime.datetime(2024, 1, 1)
RELOADED = datetime.datetime(2024, 2, 1)
CLOSED = datetime.datetime(2024, 1, 15)


def _as_text(rows: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as text, which both engines print alike."""
    return rows.withColumns({name: F.col(name).cast("string") for name in columns})


# --- warehouse -------------------------------------------------------------

_warehouses: dict[tuple[str, str], TableStore] = {}
_folders: dict[str, str] = {}


def _scratch(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = dropped_at_exit(spark, shared_folder(spark))
    return _folders[app]


def _new_store(spark: SparkSession, purpose: str) -> TableStore:
    stamp = datetime.datetime.now().strftime("%Y%m%d-%H%M%S-%f")
    return TableStore(spark, f"{_scratch(spark)}/{purpose}-{stamp}")


def warehouse(spark: SparkSession, sf_dir: str) -> TableStore:
    """The star of one data folder, loaded once per application by the pipeline."""
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _warehouses or not _warehouses[place].within(spark).exists("fact_sales"):
        store = _new_store(spark, "warehouse")
        pipeline.stage(store, tpch.staging(spark, sf_dir))
        pipeline.transform(store, FIRST_YEAR, LAST_YEAR, LOADED)
        _warehouses[place] = store
    return _warehouses[place].within(spark)


# --- staging ---------------------------------------------------------------


def stage_transactions(spark, sf_dir):
    return _as_text(warehouse(spark, sf_dir).read("stg_transactions"), "transaction_date")


def _through_csv(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """Write a source as CSV, load it into staging, return the staging table."""
    store = _new_store(spark, "csv")
    file = SOURCE_FILES[name]
    rows.write.csv(f"{store.root}/source/{file}", header=True, escape='"')
    pipeline.stage_csv(store, f"{store.root}/source", {name: file})
    return store.read(name)


def csv_transactions(spark, sf_dir):
    """Orders by way of CSV; pending ones carry a date that cannot be read."""
    dates = F.when(F.col("o_orderstatus") == "P", F.lit("soon")).otherwise(F.col("o_orderdate").cast("string"))
    source = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        (F.col("o_orderkey") + 1).alias("transaction_id"),
        (F.col("o_custkey") + 1).alias("customer_id"),
        dates.alias("transaction_date"),
        F.col("o_totalprice").alias("total_amount"),
    )
    return _as_text(_through_csv(spark, "stg_transactions", source), "transaction_date")


def csv_transaction_items(spark, sf_dir):
    return _through_csv(spark, "stg_transaction_items", tpch.transaction_items(spark, sf_dir))


def csv_products(spark, sf_dir):
    """Document texts as product names: quotes, commas and long cells in CSV."""
    source = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        (F.col("doc_id") + 1).alias("product_id"),
        F.regexp_replace("text", r"[\r\n]", " ").alias("product_name"),
        F.col("lang").alias("category"),
        F.col("n_chars").alias("price"),
    )
    return _through_csv(spark, "stg_products", source)


def _in_pieces(spark: SparkSession, name: str, pieces: int = 16) -> None:
    """Let this query's own session read a file of that size in about so many splits."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(1 << 16, file_bytes(spark, name) // pieces)))
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 16))


def csv_line_breaks(spark, sf_dir):
    """Document texts as product names, line breaks and all, in files that are read in many splits."""
    _in_pieces(spark, f"{sf_dir}/documents.parquet")
    source = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        (F.col("doc_id") + 1).alias("product_id"),
        # Each text thrice, with quotes, so that cells begin and end in different splits.
        F.concat("text", F.lit('\n"'), "text", F.lit('",\n\n'), "text").alias("product_name"),
        F.col("lang").alias("category"), F.col("n_chars").alias("price"),
    )
    return _through_csv(spark, "stg_products", source)


def csv_loose_quotes(spark, sf_dir):
    """Quotes inside cells that do not begin with one, and text behind a closing quote: the parser alone counts the cells."""
    number = F.col("p_partkey").cast("string")
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit('5" '), "p_name", F.lit(' 6"'))).when(
        F.col("p_partkey") % 3 == 1, F.concat(F.lit('"'), "p_name", F.lit(', "" "old'))
    ).otherwise(F.concat(F.lit('"'), "p_name", F.lit(',\n"')))
    lines = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.concat(number, F.lit(","), name, F.lit(","), "p_type", F.lit(","), F.col("p_retailprice").cast("string"))
        .alias("product_id,product_name,category,price")
    )
    store, file = _new_store(spark, "csv"), SOURCE_FILES["stg_products"]
    lines.write.csv(f"{store.root}/source/{file}", header=True, sep="\x01", quote="")
    pipeline.stage_csv(store, f"{store.root}/source", {"stg_products": file})
    return store.read("stg_products")


def csv_short_lines(spark, sf_dir):
    """Lines that end after a long quoted cell: the cells they lack are NULL."""
    name = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\r\n]", " ")
    lines = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.concat((F.col("doc_id") + 1).cast("string"), F.lit(',"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))
        .alias("product_id,product_name,category,price")
    )
    store, file = _new_store(spark, "csv"), SOURCE_FILES["stg_products"]
    lines.write.csv(f"{store.root}/source/{file}", header=True, sep="\x01", quote="")
    pipeline.stage_csv(store, f"{store.root}/source", {"stg_products": file})
    return store.read("stg_products")


def _written_dates(status) -> Column:
    """Order dates as exports write them: ISO, with an offset, by month names, with slashes, packed; or no dates."""
    when, number = F.col("o_orderdate").cast("timestamp_ntz"), F.col("o_orderkey") % 6
    shifted = F.date_format(when + F.expr("INTERVAL 7 HOURS"), "yyyy-MM-dd'T'HH:mm:ss")
    return (
        F.when((status == "O") & (number < 3), F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(status == "O", F.concat(shifted, F.lit("+07:00")))
        .when((status == "P") & (number < 2), F.date_format(when, "yyyy-MM-dd"))
        .when(status == "P", F.date_format(when, "MM/dd/yyyy"))
        .when(number == 0, F.date_format(when, "yyyyMMdd"))
        .when(number == 1, F.date_format(when, "MMM d yyyy"))
        .when(number == 2, F.date_format(when, "M/d/yyyy H:mm:ss"))
        .otherwise("bad")
    )


def _day_first_dates() -> Column:
    """Order dates with the day first, which the column shows by its dates after the 12th of a month."""
    when, number = F.col("o_orderdate").cast("timestamp_ntz"), F.col("o_orderkey") % 4
    return (
        F.when(number == 0, F.date_format(when, "dd/MM/yyyy")).when(number == 1, F.date_format(when, "d/M/yy"))
        .when(number == 2, F.date_format(when, "d.M.yyyy hh:mm:ss a")).otherwise(F.date_format(when, "dd-MM-yyyy H:mm"))
    )


def _no_dates() -> Column:
    """Six digits, times without a date, or more digits than a year has."""
    number = F.col("o_orderkey") % 3
    when = F.col("o_orderdate").cast("timestamp_ntz")
    return (
        F.when(number == 0, F.date_format(when, "yyyyMM")).when(number == 1, F.date_format(when, "'T'HH:mm:ss'Z'"))
        .otherwise(F.col("o_orderkey").cast("string"))
    )


def date_coercion(spark, sf_dir):
    """Text columns typed by name; whole numbers written with a fraction of zeros."""
    status = F.col("o_orderstatus")
    text = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")).alias("transaction_id"),
        _written_dates(status).alias("Order_Date"),
        F.col("o_orderpriority").alias("lead_time"),
        F.col("o_orderpriority").alias("priority"),
        _day_first_dates().alias("Due_Date"), _no_dates().alias("batch_time"),
        F.col("o_totalprice").cast("string").alias("total_amount"),
    )
    declared = TABLES["stg_transactions"].columns
    rows = typed(text, type(declared)([declared["transaction_id"], declared["total_amount"]]))
    names = {"Order_Date": "order_date", "Due_Date": "due_date"}
    return _as_text(rows, "Order_Date", "Due_Date", "lead_time", "batch_time").withColumnsRenamed(names)


def row_counts(spark, sf_dir):
    """Rows written to each table, as counted during the write and by a scan."""
    store = _new_store(spark, "counts")
    loaded = pipeline.stage(store, tpch.staging(spark, sf_dir))
    loaded |= pipeline.transform(store, FIRST_YEAR, LAST_YEAR, LOADED)
    scanned = None
    for name, rows in loaded.items():
        count = store.read(name).agg(
            F.lit(name).alias("table_name"), F.lit(rows).cast("bigint").alias("rows_loaded"),
            F.count(F.lit(1)).alias("row_count"),
        )
        scanned = count if scanned is None else scanned.unionByName(count)
    return scanned


_COUNTS = """
    SELECT 'staging.stg_customers' AS table_name, count(*) AS row_count FROM staging.stg_customers
    UNION ALL SELECT 'dwh.dim_customer', count(*) FROM dwh.dim_customer
    UNION ALL SELECT 'dwh.dim_date', count(*) FROM dwh.dim_date
    UNION ALL SELECT 'dwh.fact_sales', count(*) FROM dwh.fact_sales
"""


def verify_counts(spark, sf_dir):
    """Row counts asked in SQL of the registered tables."""
    warehouse(spark, sf_dir).register()
    return spark.sql(_COUNTS)


def verify_counts_reloaded(spark, sf_dir):
    """The same counts where the tables were registered before their second load, which brings more customers."""
    store, sources = _new_store(spark, "reloaded"), tpch.staging(spark, sf_dir)
    first = sources | {"stg_customers": sources["stg_customers"].filter("customer_id % 2 = 0")}
    pipeline.stage(store, first)
    pipeline.transform(store, FIRST_YEAR, LAST_YEAR, LOADED)
    store.register()
    pipeline.stage(store, sources)
    pipeline.transform(store, FIRST_YEAR, LAST_YEAR, RELOADED)
    return spark.sql(_COUNTS)


# --- dimensions ------------------------------------------------------------


def _order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar of all the years in which there are orders."""
    span = spark.read.parquet(f"{sf_dir}/orders.parquet").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    return dimensions.calendar_rows(dimensions.days_between(
        span, F.make_date(F.year("first"), F.lit(1), F.lit(1)), F.make_date(F.year("last"), F.lit(12), F.lit(31))
    ))


def dim_date(spark, sf_dir):
    return _order_calendar(spark, sf_dir)


def date_insert_absent(spark, sf_dir):
    """Days with orders exist already, marked as holidays; the other days are added."""
    ordered = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderdate").cast("date").alias("day")
    ).distinct()
    existing = dimensions.calendar_rows(ordered).withColumn("is_holiday", F.lit(True))
    return dimensions.insert_absent(existing, _order_calendar(spark, sf_dir), "date_key")


def unknown_members(spark, sf_dir):
    """Seeding the unknown members into loaded dimensions adds nothing to them."""
    store = warehouse(spark, sf_dir)
    members = None
    for load, label in zip(dimensions.DIMENSION_LOADS, ("name", "product_name", "campaign_name")):
        table = TABLES[load.table]
        seed = dimensions.new_dimension(spark, load, moment(RELOADED))
        rows = dimensions.insert_absent(store.read(load.table), seed, table.primary_key).select(
            F.lit(load.table).alias("table_name"),
            F.col(table.primary_key).alias("member_key"),
            F.col(table.natural_key).alias("natural_id"),
            F.col(label).alias("label"),
        )
        members = rows if members is None else members.unionByName(rows)
    return members


def _stored(spark: SparkSession, load: dimensions.DimensionLoad, rows: DataFrame) -> DataFrame:
    """A dimension as a table: written once, however often it is read."""
    store = _new_store(spark, "dimension")
    store.write(load.table, rows)
    return store.read(load.table)


def _first_load(spark: SparkSession, load: dimensions.DimensionLoad, staged: DataFrame) -> DataFrame:
    empty = dimensions.new_dimension(spark, load, moment(LOADED))
    return dimensions.load_dimension(empty, staged, load, moment(LOADED))


def _customer_text(rows: DataFrame) -> DataFrame:
    return _as_text(rows, "signup_date", "row_start_date", "row_end_date")


def dim_customer(spark, sf_dir):
    return _customer_text(_first_load(spark, dimensions.CUSTOMERS, tpch.customers(spark, sf_dir)))


def dim_product(spark, sf_dir):
    return _first_load(spark, dimensions.PRODUCTS, tpch.products(spark, sf_dir))


def dim_campaign(spark, sf_dir):
    rows = _first_load(spark, dimensions.CAMPAIGNS, tpch.campaigns(spark, sf_dir))
    return _as_text(rows, "start_date", "end_date")


def _close(customers: DataFrame, city: str) -> DataFrame:
    """End the rows of one city, as a change made outside the load would."""
    ended = F.col("city") == city
    return customers.withColumns({
        "is_current": F.when(ended, False).otherwise(F.col("is_current")),
        "row_end_date": F.when(ended, moment(CLOSED)).otherwise(F.col("row_end_date")),
    })


def dim_customer_upsert(spark, sf_dir):
    """A second batch: BUILDING customers are new, MACHINERY ones are missing from it."""
    source = tpch.customers(spark, sf_dir)
    existing = _stored(spark, dimensions.CUSTOMERS, _first_load(spark, dimensions.CUSTOMERS, source.filter("segment <> 'BUILDING'")))
    batch = source.filter("segment <> 'MACHINERY'").withColumns({
        "name": F.upper("name"),
        "city": F.concat("city", F.lit(" City")),
        "signup_date": F.lit("1999-09-09").cast("timestamp_ntz"),
    })
    merged = dimensions.load_dimension(_close(existing, "NATION_3"), batch, dimensions.CUSTOMERS, moment(RELOADED))
    return _customer_text(merged)


def dim_product_upsert(spark, sf_dir):
    source = tpch.products(spark, sf_dir)
    existing = _stored(spark, dimensions.PRODUCTS, _first_load(spark, dimensions.PRODUCTS, source.filter("category <> 'ECONOMY'")))
    batch = source.filter("category <> 'SMALL'").withColumn("price", (F.col("price") + 1).cast("decimal(18,2)"))
    return dimensions.load_dimension(existing, batch, dimensions.PRODUCTS, moment(RELOADED))


def dim_product_rewrite(spark, sf_dir):
    """Whole batches of which ever fewer rows change, upserted by files: first loaded, then a part, then one in a hundred."""
    source, store = tpch.products(spark, sf_dir), _new_store(spark, "rewrite")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(16 << 10))  # small files, in this query's own session
    for changed, after in (("false", 0), ("product_id % 4 = 0", 1), ("product_id % 100 = 7", 2)):
        price = F.when(F.expr(changed), F.col("price") + after).otherwise(F.col("price")).cast("decimal(18,2)")
        rows = source.withColumn("price", price).filter("category <> 'SMALL'" if after == 0 else "true")
        pipeline.stage(store, {"stg_products": rows})
        pipeline.refresh_dimension(store, dimensions.PRODUCTS, RELOADED)
    return store.read("dim_product")


def dim_campaign_upsert(spark, sf_dir):
    source = tpch.campaigns(spark, sf_dir)
    existing = _stored(spark, dimensions.CAMPAIGNS, _first_load(spark, dimensions.CAMPAIGNS, source.filter("channel <> 'click'")))
    batch = source.filter("channel <> 'view'").withColumn("end_date", F.col("start_date"))
    merged = dimensions.load_dimension(existing, batch, dimensions.CAMPAIGNS, moment(RELOADED))
    return _as_text(merged, "start_date", "end_date")


# --- fact ------------------------------------------------------------------


def _fact(spark: SparkSession, sf_dir: str, customers: DataFrame, products: DataFrame) -> DataFrame:
    return fact.build_fact_sales(
        tpch.transactions(spark, sf_dir), tpch.transaction_items(spark, sf_dir),
        _stored(spark, dimensions.CUSTOMERS, customers), _stored(spark, dimensions.PRODUCTS, products),
        FIRST_YEAR, LAST_YEAR,
    )


def fact_sales(spark, sf_dir):
    return _fact(
        spark, sf_dir,
        _first_load(spark, dimensions.CUSTOMERS, tpch.customers(spark, sf_dir)),
        _first_load(spark, dimensions.PRODUCTS, tpch.products(spark, sf_dir)),
    )


def fact_sales_unknown(spark, sf_dir):
    """Only BUILDING customers are known, those of one city no longer current."""
    customers = tpch.customers(spark, sf_dir).filter("segment = 'BUILDING'")
    products = tpch.products(spark, sf_dir).filter("category <> 'SMALL'")
    return _fact(
        spark, sf_dir,
        _close(_first_load(spark, dimensions.CUSTOMERS, customers), "NATION_3"),
        _first_load(spark, dimensions.PRODUCTS, products),
    )


def fact_refresh_twice(spark, sf_dir):
    """The whole pipeline, its transform run twice over the same staging tables."""
    store = _new_store(spark, "twice")
    pipeline.stage(store, tpch.staging(spark, sf_dir))
    pipeline.transform(store, FIRST_YEAR, LAST_YEAR, LOADED)
    pipeline.transform(store, FIRST_YEAR, LAST_YEAR, RELOADED, rebuild=True)
    return store.read("fact_sales")


def transform_unchanged(spark, sf_dir):
    """What later transforms write: of the same rows in another order, then of renamed customers."""
    store, sources = _new_store(spark, "unchanged"), tpch.staging(spark, sf_dir)
    pipeline.stage(store, sources)
    pipeline.transform(store, FIRST_YEAR, LAST_YEAR, LOADED)
    shuffled = {name: rows.repartition(*rows.columns) for name, rows in sources.items()}  # into as many parts as the data needs
    renamed = {"stg_customers": sources["stg_customers"].withColumn("name", F.concat("name", F.lit(" II")))}
    counts = []
    for number, staged in ((2, shuffled), (3, renamed)):
        pipeline.stage(store, staged)
        loaded = pipeline.transform(store, FIRST_YEAR, LAST_YEAR, RELOADED)
        tables = store.snapshot()  # the third load does not change what is counted for the second
        counts += [
            tables.read(name).agg(
                F.lit(number).alias("load"), F.lit(name).alias("table_name"), F.lit(rows.written).alias("written"),
                F.lit(int(rows)).cast("bigint").alias("rows_loaded"), F.count(F.lit(1)).alias("row_count"),
            )
            for name, rows in loaded.items()
        ]
    return reduce(DataFrame.unionByName, counts)


def star_snapshot(spark, sf_dir):
    """Sales by city in two releases: a star opened before all customers moved, and the one after."""
    store, sources = _new_store(spark, "releases"), tpch.staging(spark, sf_dir)
    pipeline.stage(store, sources)
    pipeline.transform(store, FIRST_YEAR, LAST_YEAR, LOADED)
    before = store.snapshot()
    pipeline.stage(store, {"stg_customers": sources["stg_customers"].withColumn("city", F.concat("city", F.lit(" City")))})
    pipeline.transform(store, FIRST_YEAR, LAST_YEAR, RELOADED)
    return reduce(DataFrame.unionByName, [
        analytics.sales_by_city(star.read("fact_sales"), star.read("dim_customer")).withColumn("star", F.lit(label))
        for label, star in (("before", before), ("after", store.snapshot()))
    ])


# --- checks ----------------------------------------------------------------


def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(
        spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_orderkey", "l_linenumber"
    )


def null_violations(spark, sf_dir):
    """Customers in debt lost their name, on the way to a table that requires one."""
    staged = tpch.customers(spark, sf_dir).withColumn("name", F.when(F.col("balance") >= 0, F.col("name")))
    return quality.null_counts(dimensions.CUSTOMERS.rename(staged), TABLES["dim_customer"].not_null)


def length_violations(spark, sf_dir):
    """Documents offered as products, whose names are limited."""
    offered = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("text").alias("product_name"), F.col("source").alias("category")
    )
    return quality.length_counts(offered, TABLES["dim_product"].max_length)


def range_violations(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", F.col("l_extendedprice").cast("bigint").alias("l_extendedprice"),
        F.col("l_quantity").cast("bigint").alias("l_quantity"),
    )
    return quality.range_counts(
        items, {"l_orderkey": "int", "l_extendedprice": "smallint", "l_quantity": "smallint"}
    )


def fact_fk_violations(spark, sf_dir):
    """The fact against a shorter calendar and without the customers of one city."""
    store = warehouse(spark, sf_dir)
    parents = {name: store.read(name) for name, _ in TABLES["fact_sales"].references.values()}
    parents["dim_date"] = parents["dim_date"].filter("year_num < 2000")
    parents["dim_customer"] = parents["dim_customer"].filter("city IS NULL OR city <> 'NATION_3'")
    return quality.reference_violations(store.read("fact_sales"), TABLES["fact_sales"], parents)


def declared_violations(spark, sf_dir):
    """Every constraint of every table; the line numbers that stand in for item ids repeat."""
    store = warehouse(spark, sf_dir)
    rows = {name: store.read(name) for name in TABLES}
    checks = [quality.declared_violations(rows[name], table, rows) for name, table in TABLES.items()]
    return reduce(DataFrame.unionByName, checks)


# --- sensors ---------------------------------------------------------------


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tpch.sensor_messages(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A stream source takes a folder or a glob: the braces match this one name and nothing longer, as a file or a folder.
    events = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(events).schema
    return tpch.sensor_messages(spark.readStream.schema(schema).parquet(f"{sf_dir}/{{events}}.parquet"))


def sensor_parse(spark, sf_dir):
    rows = sensors.parse_readings(_messages(spark, sf_dir))
    return rows.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def sensor_counts(spark, sf_dir):
    return sensors.sensor_counts(_messages(spark, sf_dir))


def _run_stream(spark, sf_dir, mode, sink) -> str:
    folder = _new_store(spark, "stream").root
    sensors.start_sensor_counts(
        _message_stream(spark, sf_dir), f"{folder}/checkpoint", sink(f"{folder}/result"), mode,
        trigger={"availableNow": True},
    ).awaitTermination()
    return f"{folder}/result"


def sensor_counts_stream(spark, sf_dir):
    """Complete mode on a file stream: the last result holds every window."""
    return sensors.latest_snapshot(spark, _run_stream(spark, sf_dir, "complete", sensors.to_snapshots))


def sensor_counts_append(spark, sf_dir):
    """Append mode: windows come out once the watermark has passed their end."""
    result = _run_stream(spark, sf_dir, "append", sensors.to_files)
    return spark.read.schema("window_start string, sensor_reading_count bigint").parquet(result)


# --- sales over the star ---------------------------------------------------


def sales_by_month(spark, sf_dir):
    store = warehouse(spark, sf_dir)
    return analytics.sales_by_month(store.read("fact_sales"), store.read("dim_date"))


def sales_by_category(spark, sf_dir):
    store = warehouse(spark, sf_dir)
    return analytics.sales_by_category(store.read("fact_sales"), store.read("dim_product"))


def sales_by_city(spark, sf_dir):
    store = warehouse(spark, sf_dir)
    return analytics.sales_by_city(store.read("fact_sales"), store.read("dim_customer"))


_QUERIES = (
    stage_transactions, csv_transactions, csv_transaction_items, csv_products, csv_line_breaks, csv_loose_quotes, csv_short_lines,
    date_coercion,
    row_counts, verify_counts, verify_counts_reloaded,
    dim_date, date_insert_absent, unknown_members, dim_customer, dim_product, dim_campaign,
    dim_customer_upsert, dim_product_upsert, dim_product_rewrite, dim_campaign_upsert,
    fact_sales, fact_sales_unknown, fact_refresh_twice, transform_unchanged, star_snapshot,
    duplicate_keys, null_violations, length_violations, range_violations, fact_fk_violations,
    declared_violations,
    sensor_parse, sensor_counts, sensor_counts_stream, sensor_counts_append,
    sales_by_month, sales_by_category, sales_by_city,
)


def _llm() -> tuple[dict[str, Callable], dict[str, str]]:
    """Queries and SQL of the training-data operators, none where that subpackage is not installed."""
    try:
        import corpus_pipeline
        from starloom.llm import queries as llm
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "starloom.llm", "starloom.llm.queries"):
            raise
        return {}, {}
    added = {query.__name__: query for query in llm.QUERIES} | {"pipeline": corpus_pipeline.run}
    sql = dict(llm.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return added, sql


def _in_size(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, built in a session whose settings follow the size of its data folder."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(sized(spark, file_bytes(spark, sf_dir)), sf_dir)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """The sales fact at sf0.001."""
    return queries()["fact_sales"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: _in_size(query) for query in _QUERIES} | _llm()[0]


# --- the same in SQL -------------------------------------------------------

_CUSTOMERS = """
    SELECT c_custkey + 1 AS id, c_name AS name, lower(c_name) || '@example.com' AS email, n_name AS city,
           c_mktsegment AS segment, c_acctbal AS balance
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
"""

_CAMPAIGNS = """
    SELECT row_number() OVER (ORDER BY event_type) AS id, event_type AS channel,
           min(ts) AS start_date, max(ts) AS end_date
    FROM events GROUP BY event_type
"""

_DAY_COLUMNS = """
    CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
    CAST(isodow(d) AS SMALLINT) AS day_of_week, rpad(dayname(d), 9, ' ') AS day_name,
    CAST(day(d) AS SMALLINT) AS day_of_month, CAST(dayofyear(d) AS SMALLINT) AS day_of_year,
    CAST(month(d) AS SMALLINT) AS month_of_year, rpad(monthname(d), 9, ' ') AS month_name,
    CAST(quarter(d) AS SMALLINT) AS quarter_of_year, CAST(year(d) AS SMALLINT) AS year_num,
    isodow(d) IN (6, 7) AS is_weekend
"""

_CALENDAR = """
    SELECT unnest(generate_series(make_date(year(min(o_orderdate)), 1, 1)::TIMESTAMP,
                                  make_date(year(max(o_orderdate)), 12, 31)::TIMESTAMP, INTERVAL 1 DAY)) AS d
    FROM orders
"""


def _fact_oracle(customer_rule: str = "TRUE", current_rule: str = "TRUE", product_rule: str = "TRUE") -> str:
    return f"""
        WITH c AS (SELECT *, row_number() OVER (ORDER BY id) AS key FROM ({_CUSTOMERS}) WHERE {customer_rule}),
             p AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS key FROM part WHERE {product_rule})
        SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
               COALESCE(c.key, 0) AS customer_key, COALESCE(p.key, 0) AS product_key,
               CAST(0 AS BIGINT) AS campaign_key, CAST(o_orderkey + 1 AS INTEGER) AS transaction_id_natural,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS price_at_sale,
               CAST(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(18,2))
                   AS total_amount
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        LEFT JOIN c ON c.id = o_custkey + 1 AND {current_rule}
        LEFT JOIN p ON p.p_partkey = l_partkey
        WHERE o_orderdate >= TIMESTAMP '{FIRST_YEAR}-01-01' AND o_orderdate <= TIMESTAMP '{LAST_YEAR}-12-31'
    """


def _sales_oracle(attributes: str) -> str:
    return f"""
        SELECT {attributes},
               CAST(sum(CAST(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(18,2))
                             AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_amount,
               CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS quantity, count(*) AS item_count
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        JOIN part ON p_partkey = l_partkey
        WHERE o_orderdate >= TIMESTAMP '{FIRST_YEAR}-01-01' AND o_orderdate <= TIMESTAMP '{LAST_YEAR}-12-31'
        GROUP BY ALL
    """


_WINDOWS = """
    SELECT date_trunc('minute', ts) AS start, count(*) AS n
    FROM events WHERE event_type NOT IN ('error', 'purchase') GROUP BY 1
"""
_WINDOW_COLUMNS = "strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start, n AS sensor_reading_count"


# Constraints per table as (rule, columns).
_CONSTRAINTS = {
    "stg_customers": [
        ("repeated", "customer_id"), ("missing", "customer_id"), ("too long", "name email city"),
    ],
    "stg_products": [
        ("repeated", "product_id"), ("missing", "product_id"), ("too long", "product_name category"),
    ],
    "stg_marketing_campaigns": [
        ("repeated", "campaign_id"), ("missing", "campaign_id"), ("too long", "campaign_name channel"),
    ],
    "stg_transactions": [("repeated", "transaction_id"), ("missing", "transaction_id")],
    "stg_transaction_items": [("missing", "transaction_item_id")],
    "dim_date": [
        ("repeated", "date_key"), ("too long", "day_name month_name"),
        ("missing", "date_key full_date day_of_week day_name day_of_month day_of_year month_of_year month_name "
                    "quarter_of_year year_num is_weekend is_holiday"),
    ],
    "dim_customer": [
        ("repeated", "customer_key customer_id_natural"), ("missing", "customer_key customer_id_natural name"),
        ("too long", "name email city"),
    ],
    "dim_product": [
        ("repeated", "product_key product_id_natural"), ("missing", "product_key product_id_natural"),
        ("too long", "product_name category"),
    ],
    "dim_campaign": [
        ("repeated", "campaign_key campaign_id_natural"), ("missing", "campaign_key campaign_id_natural"),
        ("too long", "campaign_name channel"),
    ],
    "fact_sales": [
        ("missing", "date_key customer_key product_key campaign_key transaction_id_natural quantity price_at_sale "
                    "total_amount"),
        ("unknown", "date_key customer_key product_key campaign_key"),
    ],
}


def _kept_constraints() -> str:
    """Constraints that hold whatever the data, by the way the tables are made."""
    return ", ".join(
        f"('{table}', '{column}', '{rule}', 0)"
        for table, rules in _CONSTRAINTS.items() for rule, columns in rules for column in columns.split()
    )


def oracle_sql() -> dict[str, str]:
    fact_oracle = _fact_oracle()
    return _llm()[1] | {
        "stage_transactions": """
            SELECT o_orderkey + 1 AS transaction_id, o_custkey + 1 AS customer_id,
                   CAST(o_orderdate AS VARCHAR) AS transaction_date,
                   CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount
            FROM orders
        """,
        "csv_transactions": """
            SELECT o_orderkey + 1 AS transaction_id, o_custkey + 1 AS customer_id,
                   CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS VARCHAR) END AS transaction_date,
                   CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount
            FROM orders
        """,
        "csv_transaction_items": """
            SELECT CAST(l_linenumber AS BIGINT) AS transaction_item_id, l_orderkey + 1 AS transaction_id,
                   l_partkey + 1 AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
                   CAST(l_extendedprice AS DECIMAL(18,2)) AS price
            FROM lineitem
        """,
        "csv_products": r"""
            SELECT doc_id + 1 AS product_id, regexp_replace(text, '[\r\n]', ' ', 'g') AS product_name,
                   lang AS category, CAST(n_chars AS DECIMAL(18,2)) AS price
            FROM documents
        """,
        "csv_line_breaks": r"""
            SELECT doc_id + 1 AS product_id, text || chr(10) || '"' || text || '",' || chr(10) || chr(10) || text AS product_name,
                   lang AS category, CAST(n_chars AS DECIMAL(18,2)) AS price
            FROM documents
        """,
        "csv_loose_quotes": r"""
            SELECT p_partkey AS product_id, CASE p_partkey % 3
                       WHEN 0 THEN '5" ' || p_name || ' 6"' WHEN 1 THEN p_name || ', " old' ELSE p_name || ',' || chr(10)
                   END AS product_name, p_type AS category, CAST(p_retailprice AS DECIMAL(18,2)) AS price
            FROM part
        """,
        "csv_short_lines": r"""
            SELECT doc_id + 1 AS product_id, nullif(regexp_replace(text, '[\r\n]', ' ', 'g'), '') AS product_name,
                   CAST(NULL AS VARCHAR) AS category, CAST(NULL AS DECIMAL(18,2)) AS price
            FROM documents
        """,
        "date_coercion": """
            SELECT o_orderkey AS transaction_id,
                   CASE WHEN o_orderstatus IN ('O', 'P') OR o_orderkey % 6 < 3
                        THEN CAST(o_orderdate AS VARCHAR) END AS order_date,
                   CAST(o_orderdate AS VARCHAR) AS due_date,
                   CASE WHEN o_orderkey % 3 = 2 AND o_orderkey BETWEEN 1000 AND 9999
                        THEN lpad(CAST(o_orderkey AS VARCHAR), 4, '0') || '-01-01 00:00:00' END AS batch_time,
                   CAST(TRY_CAST(o_orderpriority AS TIMESTAMP) AS VARCHAR) AS lead_time,
                   o_orderpriority AS priority, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount
            FROM orders
        """,
        "row_counts": f"""
            SELECT table_name, n AS rows_loaded, n AS row_count FROM (
                SELECT 'stg_customers' AS table_name, count(*) AS n FROM customer
                UNION ALL SELECT 'stg_products', count(*) FROM part
                UNION ALL SELECT 'stg_marketing_campaigns', count(DISTINCT event_type) FROM events
                UNION ALL SELECT 'stg_transactions', count(*) FROM orders
                UNION ALL SELECT 'stg_transaction_items', count(*) FROM lineitem
                UNION ALL SELECT 'dim_customer', count(*) + 1 FROM customer
                UNION ALL SELECT 'dim_product', count(*) + 1 FROM part
                UNION ALL SELECT 'dim_campaign', count(DISTINCT event_type) + 1 FROM events
                UNION ALL SELECT 'dim_date',
                    date_diff('day', DATE '{FIRST_YEAR}-01-01', DATE '{LAST_YEAR}-12-31') + 1
                UNION ALL SELECT 'fact_sales', count(*) FROM ({fact_oracle})
            )
        """,
        "verify_counts": f"""
            SELECT 'staging.stg_customers' AS table_name, count(*) AS row_count FROM customer
            UNION ALL SELECT 'dwh.dim_customer', count(*) + 1 FROM customer
            UNION ALL SELECT 'dwh.dim_date',
                date_diff('day', DATE '{FIRST_YEAR}-01-01', DATE '{LAST_YEAR}-12-31') + 1
            UNION ALL SELECT 'dwh.fact_sales', count(*) FROM ({fact_oracle})
        """,
        "verify_counts_reloaded": f"""
            SELECT 'staging.stg_customers' AS table_name, count(*) AS row_count FROM customer
            UNION ALL SELECT 'dwh.dim_customer', count(*) + 1 FROM customer
            UNION ALL SELECT 'dwh.dim_date',
                date_diff('day', DATE '{FIRST_YEAR}-01-01', DATE '{LAST_YEAR}-12-31') + 1
            UNION ALL SELECT 'dwh.fact_sales', count(*) FROM ({fact_oracle})
        """,
        "dim_date": f"SELECT {_DAY_COLUMNS}, FALSE AS is_holiday FROM ({_CALENDAR})",
        "date_insert_absent": f"""
            SELECT {_DAY_COLUMNS}, d IN (SELECT o_orderdate FROM orders) AS is_holiday FROM ({_CALENDAR})
        """,
        "unknown_members": f"""
            SELECT 'dim_customer' AS table_name, row_number() OVER (ORDER BY id) AS member_key,
                   CAST(id AS INTEGER) AS natural_id, name AS label FROM ({_CUSTOMERS})
            UNION ALL
            SELECT 'dim_product', row_number() OVER (ORDER BY p_partkey), CAST(p_partkey + 1 AS INTEGER), p_name
            FROM part
            UNION ALL
            SELECT 'dim_campaign', id, CAST(id AS INTEGER), channel || ' campaign' FROM ({_CAMPAIGNS})
            UNION ALL
            SELECT t, 0, 0, 'Unknown' FROM (VALUES ('dim_customer'), ('dim_product'), ('dim_campaign')) v(t)
        """,
        "dim_customer": f"""
            SELECT row_number() OVER (ORDER BY id) AS customer_key, CAST(id AS INTEGER) AS customer_id_natural,
                   name, email, city, '1995-01-01 00:00:00' AS signup_date,
                   '{LOADED}' AS row_start_date, CAST(NULL AS VARCHAR) AS row_end_date, TRUE AS is_current
            FROM ({_CUSTOMERS})
            UNION ALL SELECT 0, 0, 'Unknown', NULL, NULL, NULL, '{LOADED}', NULL, TRUE
        """,
        "dim_product_rewrite": """
            SELECT CASE WHEN p_type <> 'SMALL' THEN row_number() OVER (PARTITION BY p_type <> 'SMALL' ORDER BY p_partkey)
                        ELSE count(*) FILTER (WHERE p_type <> 'SMALL') OVER ()
                             + row_number() OVER (PARTITION BY p_type <> 'SMALL' ORDER BY p_partkey) END AS product_key,
                   CAST(p_partkey + 1 AS INTEGER) AS product_id_natural, p_name AS product_name, p_type AS category,
                   CAST(CAST(p_retailprice AS DECIMAL(18,2)) + CASE WHEN (p_partkey + 1) % 100 = 7 THEN 2 ELSE 0 END
                        AS DECIMAL(18,2)) AS master_price
            FROM part UNION ALL SELECT 0, 0, 'Unknown', NULL, NULL
        """,
        "dim_product": """
            SELECT row_number() OVER (ORDER BY p_partkey) AS product_key,
                   CAST(p_partkey + 1 AS INTEGER) AS product_id_natural, p_name AS product_name,
                   p_type AS category, CAST(p_retailprice AS DECIMAL(18,2)) AS master_price
            FROM part
            UNION ALL SELECT 0, 0, 'Unknown', NULL, NULL
        """,
        "dim_campaign": f"""
            SELECT id AS campaign_key, CAST(id AS INTEGER) AS campaign_id_natural,
                   channel || ' campaign' AS campaign_name, CAST(start_date AS VARCHAR) AS start_date,
                   CAST(end_date AS VARCHAR) AS end_date, channel
            FROM ({_CAMPAIGNS})
            UNION ALL SELECT 0, 0, 'Unknown', NULL, NULL, NULL
        """,
        "dim_customer_upsert": f"""
            WITH c AS (SELECT * FROM ({_CUSTOMERS}))
            SELECT row_number() OVER (ORDER BY id) AS customer_key, CAST(id AS INTEGER) AS customer_id_natural,
                   CASE WHEN segment = 'MACHINERY' THEN name ELSE upper(name) END AS name, email,
                   CASE WHEN segment = 'MACHINERY' THEN city ELSE city || ' City' END AS city,
                   '1995-01-01 00:00:00' AS signup_date, '{LOADED}' AS row_start_date,
                   CASE WHEN segment = 'MACHINERY' AND city = 'NATION_3' THEN '{CLOSED}' END AS row_end_date,
                   NOT (segment = 'MACHINERY' AND city = 'NATION_3') AS is_current
            FROM c WHERE segment <> 'BUILDING'
            UNION ALL
            SELECT row_number() OVER (ORDER BY id) + (SELECT count(*) FROM c WHERE segment <> 'BUILDING'),
                   CAST(id AS INTEGER), upper(name), email, city || ' City', '1999-09-09 00:00:00',
                   '{RELOADED}', NULL, TRUE
            FROM c WHERE segment = 'BUILDING'
            UNION ALL SELECT 0, 0, 'Unknown', NULL, NULL, NULL, '{LOADED}', NULL, TRUE
        """,
        "dim_product_upsert": """
            SELECT CASE WHEN p_type = 'ECONOMY' THEN (SELECT count(*) FROM part WHERE p_type <> 'ECONOMY') ELSE 0 END
                       + row_number() OVER (PARTITION BY p_type = 'ECONOMY' ORDER BY p_partkey) AS product_key,
                   CAST(p_partkey + 1 AS INTEGER) AS product_id_natural, p_name AS product_name,
                   p_type AS category,
                   CAST(CAST(p_retailprice AS DECIMAL(18,2)) + CASE WHEN p_type = 'SMALL' THEN 0 ELSE 1 END
                        AS DECIMAL(18,2)) AS master_price
            FROM part
            UNION ALL SELECT 0, 0, 'Unknown', NULL, NULL
        """,
        "dim_campaign_upsert": f"""
            SELECT CASE WHEN channel = 'click' THEN (SELECT count(DISTINCT event_type) FROM events
                                                     WHERE event_type <> 'click') ELSE 0 END
                       + row_number() OVER (PARTITION BY channel = 'click' ORDER BY id) AS campaign_key,
                   CAST(id AS INTEGER) AS campaign_id_natural, channel || ' campaign' AS campaign_name,
                   CAST(start_date AS VARCHAR) AS start_date,
                   CAST(CASE WHEN channel = 'view' THEN end_date ELSE start_date END AS VARCHAR) AS end_date, channel
            FROM ({_CAMPAIGNS})
            UNION ALL SELECT 0, 0, 'Unknown', NULL, NULL, NULL
        """,
        "fact_sales": fact_oracle,
        "fact_sales_unknown": _fact_oracle("segment = 'BUILDING'", "c.city <> 'NATION_3'", "p_type <> 'SMALL'"),
        "fact_refresh_twice": fact_oracle,
        "transform_unchanged": f"""
            SELECT load, table_name, load = 3 AND table_name IN ('dim_customer', 'fact_sales') AS written,
                   n AS rows_loaded, n AS row_count
            FROM (
                SELECT 'dim_customer' AS table_name, count(*) + 1 AS n FROM customer
                UNION ALL SELECT 'dim_product', count(*) + 1 FROM part
                UNION ALL SELECT 'dim_campaign', count(DISTINCT event_type) + 1 FROM events
                UNION ALL SELECT 'dim_date',
                    date_diff('day', DATE '{FIRST_YEAR}-01-01', DATE '{LAST_YEAR}-12-31') + 1
                UNION ALL SELECT 'fact_sales', count(*) FROM ({fact_oracle})
            ), (VALUES (2), (3)) loads(load)
        """,
        "star_snapshot": f"""
            SELECT 'before' AS star, * FROM ({_sales_oracle("n_name AS city")})
            UNION ALL SELECT 'after', * FROM ({_sales_oracle("n_name || ' City' AS city")})
        """,
        "duplicate_keys": """
            SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
            GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
        """,
        "null_violations": """
            SELECT 'customer_id_natural' AS column_name, count(*) FILTER (WHERE c_custkey IS NULL) AS violations
            FROM customer
            UNION ALL SELECT 'name', count(*) FILTER (WHERE c_acctbal < 0 OR c_acctbal IS NULL OR c_name IS NULL)
            FROM customer
        """,
        "length_violations": """
            SELECT 'product_name' AS column_name, count(*) FILTER (WHERE length(text) > 255) AS violations
            FROM documents
            UNION ALL SELECT 'category', count(*) FILTER (WHERE length(source) > 100) FROM documents
        """,
        "range_violations": """
            SELECT 'l_orderkey' AS column_name,
                   count(*) FILTER (WHERE l_orderkey NOT BETWEEN -2147483648 AND 2147483647) AS violations FROM lineitem
            UNION ALL SELECT 'l_extendedprice',
                   count(*) FILTER (WHERE CAST(trunc(l_extendedprice) AS BIGINT) NOT BETWEEN -32768 AND 32767)
            FROM lineitem
            UNION ALL SELECT 'l_quantity', count(*) FILTER (WHERE l_quantity NOT BETWEEN -32768 AND 32767) FROM lineitem
        """,
        "fact_fk_violations": f"""
            WITH f AS ({fact_oracle}),
                 gone AS (SELECT key FROM (SELECT city, row_number() OVER (ORDER BY id) AS key FROM ({_CUSTOMERS}))
                          WHERE city = 'NATION_3')
            SELECT 'date_key' AS column_name, CAST(date_key AS BIGINT) AS key, count(*) AS row_count
            FROM f WHERE date_key >= 20000101 GROUP BY 2
            UNION ALL SELECT 'customer_key', customer_key, count(*)
            FROM f WHERE customer_key IN (SELECT key FROM gone) GROUP BY 2
        """,
        "declared_violations": f"""
            SELECT table_name, column_name, rule, CAST(violations AS BIGINT) AS violations
            FROM (VALUES {_kept_constraints()}) v(table_name, column_name, rule, violations)
            UNION ALL
            SELECT 'stg_transaction_items', 'transaction_item_id', 'repeated', count(*)
            FROM (SELECT l_linenumber FROM lineitem GROUP BY l_linenumber HAVING count(*) > 1)
        """,
        "sensor_parse": """
            SELECT CASE WHEN ok AND dated THEN replace(CAST(ts AS VARCHAR), ' ', 'T') END AS date_time,
                   CASE WHEN ok THEN CAST(user_id % 5 + 1 AS INTEGER) END AS city_id,
                   CASE WHEN ok THEN 'City ' || (user_id % 5 + 1) END AS city_name,
                   CASE WHEN ok THEN 'DEV-' || user_id END AS device_name,
                   CASE WHEN ok AND event_type <> 'view' THEN CAST(250 + user_id % 50 AS INTEGER) END AS "P_watt",
                   CASE WHEN ok THEN 200 END AS "V_volt",
                   CASE WHEN ok THEN CAST(value AS FLOAT) END AS "I_amphere",
                   CASE WHEN ok AND dated THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS event_time
            FROM (SELECT *, event_type <> 'error' AS ok, event_type <> 'purchase' AS dated FROM events)
        """,
        "sensor_counts": f"SELECT {_WINDOW_COLUMNS} FROM ({_WINDOWS})",
        "sensor_counts_stream": f"SELECT {_WINDOW_COLUMNS} FROM ({_WINDOWS})",
        "sensor_counts_append": f"""
            SELECT {_WINDOW_COLUMNS} FROM ({_WINDOWS})
            WHERE start + INTERVAL 1 MINUTE <= (SELECT max(ts) - INTERVAL 1 MINUTE FROM events
                                                WHERE event_type NOT IN ('error', 'purchase'))
        """,
        "sales_by_month": _sales_oracle("""
            CAST(year(o_orderdate) AS SMALLINT) AS year_num, CAST(month(o_orderdate) AS SMALLINT) AS month_of_year,
            rpad(monthname(o_orderdate), 9, ' ') AS month_name
        """),
        "sales_by_category": _sales_oracle("p_type AS category"),
        "sales_by_city": _sales_oracle("n_name AS city"),
    }
