"""Loading the sources and rebuilding the star, in the order tables depend on each other."""

from __future__ import annotations

import datetime
import uuid
import warnings
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.functions.calendar import moment
from starloom.functions.coerce import is_temporal_name
from starloom.operators.dimensions import (
    DIMENSION_LOADS,
    DimensionLoad,
    calendar_days,
    changed_rows,
    insert_absent,
    load_dimension,
    merge_batch,
    new_dimension,
)
from starloom.operators.fact import build_fact_sales, total_amount
from starloom.operators.quality import ConstraintViolation, orphans, require_clean
from starloom.plans.sizing import sized
from starloom.plans.store import TableStore, file_bytes
from starloom.schemas import SOURCE_FILES, TABLES, UNKNOWN_KEY
from starloom.sources.csv import read_csv

# The years of the calendar, and with it of the fact.
FIRST_YEAR = 2020
LAST_YEAR = 2030


def _together(spark: SparkSession, jobs: dict[str, Callable[[], int]]) -> dict[str, int]:
    """Run independent loads side by side, so small ones do not wait for big ones.

    If one fails, the Spark jobs of the others are cancelled until all have
    ended, and its error is raised; a load that was cancelled publishes nothing.
    """
    context, tag = spark.sparkContext, f"starloom-{uuid.uuid4().hex}"

    def tagged(job: Callable[[], int]) -> Callable[[], int]:
        def run() -> int:
            context.addJobTag(tag)
            try:
                return job()
            finally:
                context.removeJobTag(tag)

        return run

    with ThreadPoolExecutor(max(len(jobs), 1)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(tagged(job))) for name, job in jobs.items()}
        done, pending = wait(running.values(), return_when=FIRST_EXCEPTION)
        broken = next((load for load in done if load.exception()), None)
        while broken and pending:  # a load may have been between two jobs
            context.cancelJobsWithTag(tag)
            _, pending = wait(pending, timeout=0.1)
    if broken:
        raise broken.exception()
    return {name: load.result() for name, load in running.items()}


def _moment(load_time: datetime.datetime | None) -> Column:
    return F.localtimestamp() if load_time is None else moment(load_time)


def stage(store: TableStore, sources: dict[str, DataFrame]) -> dict[str, int]:
    """Replace the given staging tables; returns rows loaded by table.

    The tables change together.  Columns that a table does not declare are named
    in a warning and not stored.
    """
    for name, rows in sources.items():
        unknown = [column for column in rows.columns if column not in TABLES[name].columns.names]
        if unknown:
            warnings.warn(f"{name} does not declare the columns {unknown}, which are not stored", stacklevel=2)
    with store.transaction() as work:
        return _together(
            store.spark,
            {name: lambda name=name, rows=rows: work.write(name, rows) for name, rows in sources.items()},
        )


class RowCount(int):
    """Rows loaded; ``lost_dates`` has, by column, how many cells held a text that is no date.

    ``written`` is false where a table was left as it is, because what it is made of has not changed.
    """

    lost_dates: dict[str, int] = {}
    written = True


def _unless_same(store: TableStore, name: str, inputs: dict, refresh: Callable[[], int], rebuild: bool) -> RowCount:
    """Refresh a table, unless its current version was made of the same inputs."""
    current = store.current(name)
    if current is not None and current.inputs == inputs and not rebuild:
        count = RowCount(current.rows)
        count.written = False
        return count
    before = store.versions(name)
    count = RowCount(refresh())
    count.written = store.versions(name) != before
    return count


def _content(store: TableStore, *names: str) -> dict[str, str]:
    """What stands for the content of tables: the digest of a staging table, the version of another."""
    found = {name: store.current(name) for name in names}
    return {name: entry.digest or f"v{entry.versions[-1]}" for name, entry in found.items() if entry}


def stage_csv(
    store: TableStore, folder: str, files: dict[str, str] = SOURCE_FILES, multiline: bool = False,
    date_formats: tuple[str, ...] | None = None,
) -> dict[str, RowCount]:
    """Replace the staging tables by the CSV files of a folder; returns rows loaded by table."""
    size = sum(file_bytes(store.spark, f"{folder}/{file}") for file in files.values())
    store = store.within(sized(store.spark, size))
    lost = {name: Observation() for name in files}
    loaded = stage(store, {
        name: read_csv(store.spark, f"{folder}/{file}", TABLES[name].columns, multiline, date_formats, lost[name])
        for name, file in files.items()
    })
    counts = {name: RowCount(rows) for name, rows in loaded.items()}
    for name, rows in counts.items():
        if any(is_temporal_name(column) for column in TABLES[name].columns.names):
            rows.lost_dates = {column: cells for column, cells in lost[name].get.items() if cells}
    return counts


def _current(store: TableStore, name: str, load_time: datetime.datetime | None) -> DataFrame:
    """A table as it is, or as it would be created: empty, or with its unknown member."""
    if store.exists(name):
        return store.read(name)
    for load in DIMENSION_LOADS:
        if load.table == name:
            return new_dimension(store.spark, load, _moment(load_time))
    return store.spark.createDataFrame([], TABLES[name].columns)


def create_tables(store: TableStore, load_time: datetime.datetime | None = None) -> None:
    """Write each table that does not exist yet."""
    with store.transaction() as work:
        _together(store.spark, {
            name: lambda name=name: work.write(name, _current(work, name, load_time))
            for name in TABLES if not work.exists(name)
        })


def _sized(store: TableStore, *read: str) -> TableStore:
    """The store in a session that fits the tables about to be read."""
    return store.within(sized(store.spark, store.stored_bytes(*filter(store.exists, read))))


def refresh_dimension(
    store: TableStore, load: DimensionLoad, load_time: datetime.datetime | None = None, rebuild: bool = False
) -> RowCount:
    """Upsert one staged batch into its dimension; files none of whose rows change stay as they are.

    A batch of the same content as the last one is not even read, unless
    ``rebuild`` asks for it or the dimension was written in another way since.
    """
    with store.transaction() as work:
        inputs = _content(work, load.source)
        return _unless_same(work, load.table, inputs, lambda: _upsert(work, load, load_time, inputs), rebuild)


def _upsert(store: TableStore, load: DimensionLoad, load_time: datetime.datetime | None, inputs: dict) -> int:
    store = _sized(store, load.source, load.table)
    staged, moment = store.read(load.source), _moment(load_time)
    if not store.exists(load.table) or store.files(load.table) is None:
        rows = load_dimension(_current(store, load.table, load_time), staged, load, moment)
        return store.write(load.table, rows, inputs=inputs)
    return store.rewrite(
        load.table, lambda current: changed_rows(current, staged, load),
        lambda existing, batch, last_key: merge_batch(existing, batch, load, moment, F.lit(last_key)), inputs=inputs,
    )


def refresh_calendar(
    store: TableStore, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR, rebuild: bool = False
) -> RowCount:
    """Add the days that the calendar lacks."""
    inputs = {"first_year": first_year, "last_year": last_year}

    def refresh() -> int:
        own = _sized(work, "dim_date")
        days = calendar_days(own.spark, first_year, last_year)
        return own.write("dim_date", insert_absent(_current(own, "dim_date", None), days, "date_key"), inputs=inputs)

    with store.transaction() as work:
        return _unless_same(work, "dim_date", inputs, refresh, rebuild)


def refresh_fact(
    store: TableStore, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR, rebuild: bool = False
) -> RowCount:
    """Rebuild the whole fact; it replaces the old one only if all its keys resolve.

    Its files hold one month each, or a part of a large one, so a read of some
    dates skips the others by the files' statistics.  A fact of the same staging
    tables, dimensions and years stays as it is unless ``rebuild`` asks for it.
    """
    with store.transaction() as work:
        parents = [name for name, _ in TABLES["fact_sales"].references.values()]
        inputs = _content(work, "stg_transactions", "stg_transaction_items", *parents)
        inputs |= {"first_year": first_year, "last_year": last_year}
        return _unless_same(
            work, "fact_sales", inputs, lambda: _build_fact(work, first_year, last_year, inputs), rebuild
        )


def _build_fact(store: TableStore, first_year: int, last_year: int, inputs: dict) -> int:
    store = _sized(store, "stg_transactions", "stg_transaction_items")
    dimensions = {name: store.read(name) for name, _ in TABLES["fact_sales"].references.values()}
    rows = build_fact_sales(
        store.read("stg_transactions"),
        store.read("stg_transaction_items"),
        dimensions["dim_customer"],
        dimensions["dim_product"],
        first_year,
        last_year,
    )
    # Rows travel without what follows from their other columns.
    rows = rows.drop("total_amount", "campaign_key").withColumn("sale_month", F.expr("date_key DIV 100"))
    rows = rows.hint("rebalance", "sale_month").withColumns({
        "total_amount": total_amount(F.col("price_at_sale")), "campaign_key": F.lit(UNKNOWN_KEY).cast("long"),
    })
    return store.write(
        "fact_sales", rows, verify=lambda written: _require_references(written, dimensions), inputs=inputs
    )


def _require_references(fact: DataFrame, dimensions: dict[str, DataFrame]) -> None:
    """Raise unless every key of a just built fact is in its dimension.

    Apart from dates, keys were read from these very dimensions or are the
    unknown member's.  So one small column of the fact is scanned, not four,
    and the unknown members are looked up.
    """
    require_clean(orphans(fact, "date_key", dimensions["dim_date"], "date_key"), "fact_sales has unknown keys")
    seeded = reduce(DataFrame.unionByName, [
        dimensions[load.table].filter(F.col(TABLES[load.table].primary_key) == UNKNOWN_KEY)
        .select(F.lit(load.table).alias("table_name"))
        for load in DIMENSION_LOADS
    ])
    absent = {load.table for load in DIMENSION_LOADS} - {row.table_name for row in seeded.collect()}
    if absent:
        raise ConstraintViolation(f"no unknown member in {sorted(absent)}")


def transform(
    store: TableStore,
    first_year: int = FIRST_YEAR,
    last_year: int = LAST_YEAR,
    load_time: datetime.datetime | None = None,
    rebuild: bool = False,
) -> dict[str, RowCount]:
    """Refresh the four dimensions, then the fact; returns rows by table.

    All five change in one release: readers see the old star or the new one.
    Running it again on staging tables of the same content changes nothing; it
    reads and writes no table then, and ``written`` of the counts says so.
    """
    with store.transaction() as work:
        jobs = {
            load.table: lambda load=load: refresh_dimension(work, load, load_time, rebuild)
            for load in DIMENSION_LOADS
        }
        jobs["dim_date"] = lambda: refresh_calendar(work, first_year, last_year, rebuild)
        counts = _together(store.spark, jobs)
        counts["fact_sales"] = refresh_fact(work, first_year, last_year, rebuild)
    return counts
