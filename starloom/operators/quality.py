"""Constraint checks, each a query that returns what breaks the rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.coerce import strict_cast
from starloom.schemas import Table

# Bounds of the integer columns.
INTEGER_BOUNDS = {"smallint": (-(2**15), 2**15 - 1), "int": (-(2**31), 2**31 - 1)}


class ConstraintViolation(ValueError):
    """Rows that a declared constraint forbids."""


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once, with their number of ``copies``.

    NULL keys are left to the not-null check; to a unique constraint they
    never equal each other.
    """
    return (
        rows.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def too_long(column: str, limit: int) -> Column:
    return F.char_length(F.col(column)) > limit


def out_of_range(column: str, kind: str) -> Column:
    low, high = INTEGER_BOUNDS[kind]
    return ~F.col(column).between(low, high)


def _count_broken(rows: DataFrame, rules: dict[str, Column], named: str = "column_name") -> DataFrame:
    """How many rows break each rule, in one pass: the rule's name and ``violations``."""
    counts = rows.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    return counts.unpivot([], list(rules), named, "violations")


def null_counts(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return _count_broken(rows, {name: F.col(name).isNull() for name in columns})


def length_counts(rows: DataFrame, limits: dict[str, int]) -> DataFrame:
    return _count_broken(rows, {name: too_long(name, limit) for name, limit in limits.items()})


def range_counts(rows: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Values that do not fit the ``int`` or ``smallint`` column they go to."""
    return _count_broken(rows, {name: out_of_range(name, kind) for name, kind in kinds.items()})


def _place() -> Column:
    return F.col("key").bitwiseAND(63).cast("int")


def _known(rows: DataFrame, parent: DataFrame, parent_key: str) -> DataFrame:
    """``rows`` with ``_mask``, whose bit at the last six bits of ``key`` says that ``parent`` has that key.

    The parent's keys go to all tasks, 64 neighbours of the dense surrogate keys
    in one word: a hundredth of the rows that a merge join would shuffle.
    """
    keys = parent.dropna(subset=[parent_key]).select(F.col(parent_key).cast("long").alias("key"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), _place())
    words = keys.groupBy(F.shiftright("key", 6).alias("_word")).agg(F.bit_or(bit).alias("_mask"))
    return rows.join(F.broadcast(words), F.shiftright("key", 6) == F.col("_word"), "left")


def orphans(rows: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Values of ``column`` that ``parent`` lacks: ``column_name, key, row_count``.

    Known keys are dropped where the rows are read, so only rows that break the
    rule are counted per key, and no skew of the keys matters.
    """
    used = rows.dropna(subset=[column]).select(F.col(column).cast("long").alias("key"))
    known = F.coalesce(F.getbit("_mask", _place()), F.lit(0)) == 1
    unknown = _known(used, parent, parent_key).filter(~known)
    return unknown.groupBy("key").agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(column).alias("column_name"), "key", "row_count"
    )


def reference_violations(rows: DataFrame, table: Table, parents: dict[str, DataFrame]) -> DataFrame:
    """Orphans of every declared reference of ``table``."""
    checks = [
        orphans(rows, column, parents[parent], parent_key)
        for column, (parent, parent_key) in table.references.items()
    ]
    return reduce(DataFrame.unionByName, checks)


def declared_violations(rows: DataFrame, table: Table, parents: dict[str, DataFrame]) -> DataFrame:
    """How often each declared constraint of a table is broken.

    ``table_name, column_name, rule, violations``, one row per constraint, 0
    where it holds.  Repeated and unknown keys count once per key.
    """

    per_row = {f"missing:{name}": F.col(name).isNull() for name in table.required}
    per_row |= {f"too long:{name}": too_long(name, limit) for name, limit in table.max_length.items()}

    def counted(rule: str, column: str, keys: DataFrame) -> DataFrame:
        return keys.agg(F.lit(f"{rule}:{column}").alias("check"), F.count(F.lit(1)).alias("violations"))

    found = [_count_broken(rows, per_row, "check")]
    found += [
        counted("repeated", key, duplicate_keys(rows, key)) for key in (table.primary_key, table.natural_key) if key
    ]
    found += [
        counted("unknown", column, orphans(rows, column, parents[parent], parent_key))
        for column, (parent, parent_key) in table.references.items()
    ]
    parts = F.split("check", ":")
    return reduce(DataFrame.unionByName, found).select(
        F.lit(table.name).alias("table_name"), parts[1].alias("column_name"), parts[0].alias("rule"), "violations"
    )


def enforced(rows: DataFrame, table: Table) -> DataFrame:
    """The declared columns of ``rows``; a NULL or an overlong text fails the job.

    The rules are part of the projection, so they cost no pass of their own
    and a bad load stops at its first bad row instead of after the write.
    """

    def column(name: str, kind: T.DataType) -> Column:
        value = strict_cast(F.col(name), kind, f"{table.name}.{name}")
        if not table.enforced:
            return value.alias(name)
        checked = value
        if name in table.max_length:
            limit = table.max_length[name]
            error = F.raise_error(F.lit(f"{table.name}.{name} is longer than {limit}")).cast(kind)
            checked = F.when(too_long(name, limit), error).otherwise(checked)
        if name in table.required:
            error = F.raise_error(F.lit(f"{table.name}.{name} is NULL")).cast(kind)
            checked = F.when(value.isNull(), error).otherwise(checked)
        return checked.alias(name)

    return rows.select(*[column(c.name, c.dataType) for c in table.columns])


def require_clean(violations: DataFrame, what: str) -> None:
    """Raise unless ``violations`` is empty, quoting the first one."""
    first = violations.take(1)
    if first:
        raise ConstraintViolation(f"{what}: {first[0].asDict()}")
