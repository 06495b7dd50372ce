"""Dimension maintenance: calendar, unknown members, upsert, insert-if-absent."""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import calendar
from starloom.functions.coerce import strict_cast
from starloom.operators.keys import assign_keys
from starloom.operators.quality import ConstraintViolation
from starloom.schemas import TABLES, Table


def days_between(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """Each day from ``first`` to ``last`` of a one-row frame, both included, as ``day``."""
    return bounds.select(F.explode(F.sequence(first, last)).alias("day"))


def calendar_days(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One ``dim_date`` row per day of the given years, both included."""
    first = F.lit(datetime.date(first_year, 1, 1))
    last = F.lit(datetime.date(last_year, 12, 31))
    return calendar_rows(days_between(spark.range(1), first, last))


def calendar_rows(days: DataFrame) -> DataFrame:
    """The ``dim_date`` row of each date in ``day``."""
    day = F.col("day")
    values = {
        "date_key": calendar.date_key(day),
        "full_date": day,
        "day_of_week": calendar.iso_day_of_week(day),
        "day_name": calendar.day_name(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "month_of_year": F.month(day),
        "month_name": calendar.month_name(day),
        "quarter_of_year": F.quarter(day),
        "year_num": F.year(day),
        "is_weekend": calendar.is_weekend(day),
        "is_holiday": F.lit(False),
    }
    return days.select(*[
        values[column.name].cast(column.dataType).alias(column.name) for column in TABLES["dim_date"].columns
    ])


def insert_absent(existing: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """``existing`` plus those of ``rows`` whose key it lacks; existing rows win.

    ``rows`` are expected to be the small side: the existing keys are first
    narrowed to theirs, so a large table is scanned but not shuffled.
    """
    present = existing.select(key).join(rows.select(key), key, "left_semi")
    return existing.unionByName(rows.dropDuplicates([key]).join(present, key, "left_anti"))


def unknown_member(spark: SparkSession, table: Table, defaults: dict[str, Column] | None = None) -> DataFrame:
    """The one row that facts without a match point to.

    It starts as an inline row, which joins treat as a table of known size;
    columns that are mere literals would turn equi joins into nested loops.
    """
    values = {name: F.lit(value) for name, value in table.unknown.items()} | (defaults or {})
    return spark.sql("SELECT * FROM VALUES (1) AS member(n)").select(*[
        values.get(column.name, F.lit(None)).cast(column.dataType).alias(column.name) for column in table.columns
    ])


@dataclass(frozen=True)
class DimensionLoad:
    """How a staging table feeds a dimension.

    ``columns`` maps source columns to dimension columns, the natural id first.
    ``update`` lists what a matched row takes over from the source; ``on_match``
    and ``on_insert`` give constants for further columns.
    """

    table: str
    source: str
    columns: dict[str, str]
    update: tuple[str, ...]
    on_match: dict[str, object] = field(default_factory=dict)
    on_insert: dict[str, object] = field(default_factory=dict)

    def rename(self, staged: DataFrame) -> DataFrame:
        """Source rows under the dimension's names and types (overflow fails)."""
        declared = TABLES[self.table].columns
        return staged.select(*[
            strict_cast(F.col(old), declared[new].dataType, old).alias(new) for old, new in self.columns.items()
        ])


# Which source columns feed which dimension columns.
CUSTOMERS = DimensionLoad(
    table="dim_customer",
    source="stg_customers",
    columns={
        "customer_id": "customer_id_natural", "name": "name", "email": "email", "city": "city",
        "signup_date": "signup_date",
    },
    update=("name", "email", "city"),
    on_match={"is_current": True, "row_end_date": None},
    on_insert={"is_current": True},
)
PRODUCTS = DimensionLoad(
    table="dim_product",
    source="stg_products",
    columns={
        "product_id": "product_id_natural", "product_name": "product_name", "category": "category",
        "price": "master_price",
    },
    update=("product_name", "category", "master_price"),
)
CAMPAIGNS = DimensionLoad(
    table="dim_campaign",
    source="stg_marketing_campaigns",
    columns={
        "campaign_id": "campaign_id_natural", "campaign_name": "campaign_name", "start_date": "start_date",
        "end_date": "end_date", "channel": "channel",
    },
    update=("campaign_name", "start_date", "end_date", "channel"),
)
DIMENSION_LOADS = (CUSTOMERS, PRODUCTS, CAMPAIGNS)


def insert_defaults(load: DimensionLoad, load_time: Column) -> dict[str, Column]:
    """Column defaults of a new row; only customers record when it started."""
    defaults = {name: F.lit(value) for name, value in load.on_insert.items()}
    if "row_start_date" in TABLES[load.table].columns.names:
        defaults["row_start_date"] = load_time
    return defaults


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    key: str,
    natural: str,
    update: tuple[str, ...],
    on_match: dict[str, Column],
    on_insert: dict[str, Column],
    last_key: Column | None = None,
) -> DataFrame:
    """Overwrite matched rows in place, append new ones with the next keys.

    Keys continue after ``last_key``, which is that of ``existing`` unless it is
    only a part of a table.

    Rows of ``existing`` that the batch does not mention stay as they are, and
    matched ones keep their key and every column outside ``update`` and
    ``on_match``.  A natural id that is NULL or occurs twice in the batch fails
    the job: the guards sit in the key column, so no write can skip them.

    Repeated ids are looked for and keys assigned on the ids alone, so whole
    rows are shuffled once, for the join of the batch with its members.
    """
    ids = incoming.groupBy(natural).count()
    repeated = ids.filter("count > 1").select(F.max(natural)).scalar()
    twice = F.raise_error(
        F.concat(F.lit(f"{natural} occurs twice in one batch: "), repeated.cast("string"))
    ).cast("long")

    new_ids = ids.select(natural).join(existing.select(natural), natural, "left_anti")
    if last_key is None:
        last_key = existing.select(F.coalesce(F.max(key), F.lit(0))).scalar()
    members = existing.withColumn("_new", F.lit(False)).unionByName(
        assign_keys(new_ids, key, natural, last_key).withColumn("_new", F.lit(True)), allowMissingColumns=True
    )
    attributes = {name: f"_sent_{name}" for name in incoming.columns if name != natural}
    batch = incoming.withColumnsRenamed(attributes).withColumn("_sent", F.lit(True))

    def column(name: str) -> Column:
        kept = F.col(name)
        if name == natural:
            return kept
        if name == key:
            return F.when(repeated.isNotNull(), twice).otherwise(kept)
        sent = F.col(attributes[name]) if name in attributes else None
        if name in update:
            kept = F.when(F.col("_sent"), sent).otherwise(kept)
        elif name in on_match:
            kept = F.when(F.col("_sent"), on_match[name]).otherwise(kept)
        first = on_insert.get(name, F.lit(None)) if sent is None else sent
        return F.when(F.col("_new"), first).otherwise(kept)

    return members.join(batch, natural, "left").select(*[
        column(c.name).cast(c.dataType).alias(c.name) for c in existing.schema
    ])


def load_dimension(existing: DataFrame, staged: DataFrame, load: DimensionLoad, load_time: Column) -> DataFrame:
    """The next state of a dimension after one staged batch."""
    return merge_batch(existing, load.rename(staged), load, load_time)


def merge_batch(
    existing: DataFrame, batch: DataFrame, load: DimensionLoad, load_time: Column, last_key: Column | None = None
) -> DataFrame:
    """:func:`load_dimension` of a batch under the dimension's names, also into a part of the dimension."""
    table = TABLES[load.table]
    return upsert(
        existing,
        batch,
        key=table.primary_key,
        natural=table.natural_key,
        update=load.update,
        on_match={name: F.lit(value) for name, value in load.on_match.items()},
        on_insert=insert_defaults(load, load_time),
        last_key=last_key,
    )


def changed_rows(existing: DataFrame, staged: DataFrame, load: DimensionLoad) -> DataFrame:
    """The rows of a batch that are new or would change their member, under the dimension's names and ``_file``.

    ``existing`` has the ``_file`` of each row.  A natural id that is NULL or
    occurs twice in the batch fails at once.
    """
    natural = TABLES[load.table].natural_key
    batch = load.rename(staged)
    broken = batch.groupBy(natural).count().filter((F.col("count") > 1) | F.col(natural).isNull())
    for row in broken.take(1):
        what = "is NULL" if row[natural] is None else f"occurs twice in one batch: {row[natural]}"
        raise ConstraintViolation(f"{natural} {what}")
    values = {name: F.col(f"_sent.{name}") for name in load.update} | {
        name: F.lit(value).cast(existing.schema[name].dataType) for name, value in load.on_match.items()
    }
    sent = batch.select(F.struct(*batch.columns).alias("_sent"))
    members = existing.select(natural, "_file", *values)
    differs = reduce(lambda one, other: one | other, [~F.col(name).eqNullSafe(value) for name, value in values.items()])
    joined = sent.join(members, F.col(f"_sent.{natural}") == F.col(natural), "left")
    return joined.filter(F.col("_file").isNull() | differs).select("_sent.*", "_file")


def new_dimension(spark: SparkSession, load: DimensionLoad, load_time: Column) -> DataFrame:
    """A dimension that holds its unknown member only."""
    return unknown_member(spark, TABLES[load.table], insert_defaults(load, load_time))
