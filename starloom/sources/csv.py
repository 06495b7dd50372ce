"""CSV source: header, comma, UTF-8, every column typed by name and schema."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.coerce import blank_missing, typed
from starloom.plans.sizing import same_splits

_DIALECT = {"sep": ",", "encoding": "UTF-8", "quote": '"', "escape": '"'}
# Read with this separator and no quote, a line is one column.
_WHOLE_LINE = {"sep": "\x01\x02\x1f\x01", "quote": "", "encoding": "UTF-8", "header": True}
_RAGGED = "_ragged_line"
# Put behind the last cell of a line, it shows where the parser saw the line end.
_END = "\x02end of the line\x03"

# Expressions for lines and records; possessive, so they neither recurse nor backtrack, however long a cell.
_QUOTED = r'"(?:[^"]++|"")*+"'
_OPEN = r'"(?:[^"]++|"")*+\z'
_CELL = rf'(?:{_QUOTED}[^,]*+|[^",][^,]*+|)'
_CLOSED_CELL = rf'(?:{_QUOTED}(?=,|\z)|[^",][^,]*+|(?=,|\z))'
# A line that ends inside a quoted cell if it begins outside of one, and one that does if it begins inside.
_OPENS = rf'^(?:{_CELL},)*+{_OPEN}'
_STAYS = rf'^(?:[^"]++|"")*+(?:\z|"[^,]*+,(?:{_CELL},)*+{_OPEN})'
# A record without a carriage return outside of quotes.
_ONE_LINE_CELL = rf'(?:{_QUOTED}[^,\r]*+|[^",\r][^,\r]*+|)'
_ONE_LINE = rf'^(?:{_ONE_LINE_CELL},)*+{_ONE_LINE_CELL}\z'
# A cell with more text behind its closing quote.
_LOOSE = rf'\G((?:{_CLOSED_CELL},)*+)"((?:[^"]++|"")*+)"([^,"]++)(?=,|\z)'
_TOO_LOOSE = rf'^(?:{_CLOSED_CELL},)*+{_QUOTED}[^,]'


def _checked(rows: DataFrame, line: str, problem: Column) -> DataFrame:
    # The message names the line; a filter cannot be skipped by a query that needs no column.
    error = F.raise_error(F.concat(problem, F.col(line))).cast("boolean")
    return rows.filter(F.when(problem.isNotNull(), error).otherwise(True))


def read_text_columns(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """All columns as text, named by the header; missing-value texts are NULL.

    A line with too few cells ends in NULLs, one with too many fails the read,
    and so does a quoted cell that never ends.  Files are split across tasks,
    line breaks inside quoted cells or not, and all must have the same header.
    The files are looked through once for such cells when this is called.
    ``multiline`` reads each file in one task instead, and needs no look ahead.
    """
    rows, file = _text(spark, path, multiline)
    return rows.drop(file)


def _text(spark: SparkSession, path: str, multiline: bool) -> tuple[DataFrame, str]:
    """The columns as text, behind one more of the file's name, and that column's name."""
    names = spark.read.options(**_DIALECT, header=True).csv(path).columns
    file = "_file"
    while file in map(str.lower, names):
        file += "_"
    if multiline:
        return _select(_read_multiline(spark, path, names, file), names, file), file

    header = spark.read.options(**_WHOLE_LINE).csv(path).columns
    if len(header) != 1:
        raise ValueError(f"the header of {path} holds control characters")
    spread = same_splits(spark, _stored_bytes(spark, path))
    inside = _inside(spread, path)
    lines = _lines(spark, path, header[0]) if inside is None else _records(spread, path, header[0], inside)
    return _select(_cells(lines, names, file), names, file), file


def _stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files that a path or glob names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(files.getContentSummary(entry.getPath()).getLength() for entry in files.globStatus(place) or ())


def _lines(spark: SparkSession, path: str, header: str) -> DataFrame:
    """``file, line``: the lines of files in which each is a record; blank ones are left out."""
    # Spark compares the header of each file with the one column's name.
    whole = T.StructType([T.StructField(header, T.StringType()), T.StructField(_RAGGED, T.StringType())])
    lines = (
        spark.read.schema(whole).options(**_WHOLE_LINE, enforceSchema=False, columnPruning=False)
        .option("columnNameOfCorruptRecord", _RAGGED).csv(path).select("*", "_metadata.file_path")
        .toDF("line", _RAGGED, "file")
    )
    problem = F.when(F.col(_RAGGED).isNotNull(), "control characters in line: ")
    return _checked(lines, "line", problem).select("file", "line")


def _cells(lines: DataFrame, names: list[str], file: str) -> DataFrame:
    """The cells of records behind their file, as the parser sees them; it alone says how many there are.

    A mark is put behind each record and parsed with it as one more cell.  It is
    found where the record ends: after all columns, or earlier in a short one;
    in a long one another cell stands in its place.
    """
    quoted = F.contains("line", F.lit('"'))
    line = F.when(quoted & F.col("line").rlike(_TOO_LOOSE), F.regexp_replace("line", _LOOSE, '$1"$2$3"')).otherwise(F.col("line"))
    columns = [f"c{number}" for number in range(len(names) + 1)]
    schema = ", ".join(f"{name} string" for name in columns)
    cells = lines.select("file", "line", line.alias("tidy")).select("file", "line", "tidy", F.inline(F.array(
        F.from_csv(F.concat("tidy", F.lit(f",{_END}")), schema, _DIALECT)
    )))
    *own, last = (F.col(name) for name in columns)
    short = F.arrays_overlap(F.array(*own), F.array(F.lit(_END)))
    problem = (
        F.when(quoted & F.col("tidy").rlike(_TOO_LOOSE), "quotes behind a closing quote in line: ")
        .when(last.eqNullSafe(_END), F.lit(None))
        .when(~F.coalesce(short, F.lit(False)), "too many cells in line: ")
    )
    ended = [F.when(~F.col(name).eqNullSafe(_END), F.col(name)).alias(name) for name in columns[:-1]]
    return _checked(cells, "line", problem).select("file", *ended).toDF(file, *names)


# --- line breaks in quoted cells ------------------------------------------------
# Whether a line begins inside a quoted cell depends on all lines before it.  So each split is read under both
# assumptions at once: a line either ends the same way under both, or keeps, or turns the state it begins with.


def _states(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, line, opens, stays``: the lines of all splits, and how each ends if it begins outside, or inside, a cell."""
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )
    quoted = F.contains("line", F.lit('"'))
    return lines.withColumns({
        "opens": F.when(quoted, F.col("line").rlike(_OPENS)).otherwise(False),
        "stays": F.when(quoted, F.col("line").rlike(_STAYS)).otherwise(True),
    })


def _inside(spark: SparkSession, path: str) -> dict[str, list[tuple[int, int | None]]] | None:
    """Which splits begin inside a quoted cell; ``None`` if no line of any file can open one that it does not close.

    By file, pairs of places: a split that begins after the first and not after
    the second does.  The driver gets one pair for each run of such splits.
    """

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, ends, opened = None, (False, True), 0

        def told() -> pa.RecordBatch:
            return pa.record_batch({
                "file": pa.array([place[0]]), "block": pa.array([place[1]], pa.int64()),
                "out_end": pa.array([ends[0]]), "in_end": pa.array([ends[1]]), "opened": pa.array([opened], pa.int64()),
            })

        for batch in batches:
            block = batch.column("block").to_numpy()
            opens, stays = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("opens", "stays"))
            files = batch.column("file").dictionary_encode()
            file = files.indices.to_numpy()
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(file) != 0)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
                if low == high:
                    continue
                here = (files.dictionary[int(file[low])].as_py(), int(block[low]))
                if here != place:
                    if place:
                        yield told()
                    place, ends, opened = here, (False, True), 0
                one, other = opens[low:high], stays[low:high]
                fixed = np.flatnonzero(one == other)
                turns = one & ~other
                if len(fixed):
                    end = bool(one[fixed[-1]]) ^ bool(turns[fixed[-1]:].sum() & 1)
                    ends = (end, end)
                elif turns.sum() & 1:
                    ends = (not ends[0], not ends[1])
                opened += int(one.sum())
        if place:
            yield told()

    found = _states(spark, path).filter(F.contains("line", F.lit('"'))).select("file", "block", "opens", "stays").mapInArrow(
        compose, "file string, block long, out_end boolean, in_end boolean, opened long"
    )
    ordered = Window.partitionBy("file").orderBy("block")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    turn = (F.col("out_end") & ~F.col("in_end")).cast("long")
    rows = found.withColumns({
        "upto": F.sum(turn).over(ordered), "turned": F.coalesce(F.sum(turn).over(before), F.lit(0)),
        "next": F.lead("block").over(ordered),
    }).withColumn("last", F.last(
        F.when(F.col("out_end") == F.col("in_end"), F.struct("out_end", "upto")), ignorenulls=True
    ).over(before))
    entering = F.coalesce(
        F.col("last.out_end").cast("long") + F.col("turned") - F.col("last.upto"), F.col("turned")
    ) % 2 == 1
    leaving = F.when(entering, F.col("in_end")).otherwise(F.col("out_end"))
    open_splits = rows.filter((F.col("opened") > 0) | leaving).select(
        "file", "block", "next", leaving.alias("leaving")
    ).collect()
    if not open_splits:
        return None
    inside: dict[str, list[tuple[int, int | None]]] = {}
    for row in open_splits:
        if row.leaving:
            if row.next is None:
                raise ValueError(f"a quoted cell does not end: {row.file}")
            inside.setdefault(row.file, []).append((row.block, row.next))
    return inside


def _records(spark: SparkSession, path: str, header: str, inside: dict[str, list[tuple[int, int | None]]]) -> DataFrame:
    """``file, line``: the records of files with line breaks in quoted cells, each split cut at its true record ends.

    The splits are those of :func:`_inside`, also where only the files with open records are read again.
    A record that goes on in further splits is put together from its pieces,
    which are the only lines that leave their task.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, state, at_header, parts, head, number = None, False, False, [], True, 0

        def rows(lines, file=None, block=None, first=None, order=None) -> pa.RecordBatch:
            count = len(lines)
            return pa.record_batch({
                "line": pa.array(lines, pa.string()), "file": pa.array([file] * count, pa.string()),
                "block": pa.array([block] * count, pa.int64()), "head": pa.array([first] * count, pa.bool_()),
                "number": pa.array([order] * count, pa.int64()),
            })

        def piece() -> pa.RecordBatch:
            nonlocal number
            number += 1
            return rows(["\n".join(parts)], *place, head, number)

        def whole(lines: list[str]) -> pa.RecordBatch:
            nonlocal at_header
            lines = [line for line in (line.removesuffix("\r") for line in lines) if line.strip(" \t")]
            if at_header and lines:
                if lines[0] != header:
                    raise ValueError(f"the header of {place[0]} is not {header}")
                lines, at_header = lines[1:], False
            return rows(lines, place[0])

        for batch in batches:
            block = batch.column("block").to_numpy()
            opens, stays = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("opens", "stays"))
            files = batch.column("file").dictionary_encode()
            file, lines = files.indices.to_numpy(), batch.column("line")
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(file) != 0)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
                if low == high:
                    continue
                here = (files.dictionary[int(file[low])].as_py(), int(block[low]))
                if here != place:
                    if parts:
                        yield piece()
                    place, at_header, parts, number = here, here[1] == 0, [], 0
                    state = any(after < here[1] <= upto for after, upto in inside.get(here[0], ()))
                    head = not state
                one, other, texts = opens[low:high], stays[low:high], lines.slice(low, high - low)
                turns = one & ~other
                upto = np.cumsum(turns)
                fixed = np.maximum.accumulate(np.where(one == other, np.arange(len(one)), -1))
                after = np.where(
                    fixed < 0, state ^ (upto & 1).astype(bool), one[fixed] ^ ((upto - upto[fixed]) & 1).astype(bool)
                )
                begins_inside = np.concatenate([[state], after[:-1]])
                starts = np.flatnonzero(~begins_inside)
                state = bool(after[-1])
                bounds = [*starts.tolist(), len(one)]
                if bounds[0]:  # lines that go on with an open record
                    parts += texts.slice(0, bounds[0]).to_pylist()
                    if len(bounds) > 1 or not state:
                        if head:
                            yield whole(["\n".join(parts)])
                        else:
                            yield piece()
                        parts, head = [], True
                if len(bounds) == 1:
                    continue
                size = np.diff(bounds)
                if state:  # the last record stays open
                    if at_header and len(size) == 1:
                        raise ValueError(f"a line break in the header of {place[0]}")
                    parts, size = texts.slice(bounds[-2]).to_pylist(), size[:-1]
                single = starts[:len(size)][size == 1]
                broken = [
                    "\n".join(texts.slice(start, count).to_pylist())
                    for start, count in zip(starts[:len(size)].tolist(), size.tolist()) if count > 1
                ]
                yield whole([*texts.take(pa.array(single)).to_pylist(), *broken])
        if parts:
            yield piece()

    def records(lines: DataFrame) -> DataFrame:
        return lines.mapInArrow(cut, "line string, file string, block long, head boolean, number long")

    lines = _states(spark, path)
    found = records(lines).filter("block IS NULL").select("file", "line")
    if inside:
        pieces = records(lines.filter(F.col("file").isin(list(inside)))).filter("block IS NOT NULL")
        first = F.sum(F.col("head").cast("long")).over(Window.partitionBy("file").orderBy("block", "number"))
        joined = pieces.withColumn("record", first).groupBy("file", "record").agg(
            F.sort_array(F.collect_list(F.struct("block", "number", "line"))).alias("pieces")
        ).select("file", F.array_join(F.transform("pieces", lambda one: one.line), "\n").alias("line"))
        found = found.unionByName(joined.select("file", F.regexp_replace("line", r"\r\z", "").alias("line")))
    stray = F.when(
        F.contains("line", F.lit("\r")) & ~F.col("line").rlike(_ONE_LINE), "a carriage return outside quotes in line: "
    )
    return _checked(found, "line", stray)


def _read_multiline(spark: SparkSession, path: str, names: list[str], file: str) -> DataFrame:
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, _RAGGED]])
    rows = spark.read.schema(schema).options(
        **_DIALECT, header=True, multiLine=True, enforceSchema=False,
        columnPruning=False,  # a parser that skips cells cannot tell a ragged line
        columnNameOfCorruptRecord=_RAGGED,
    ).csv(path).select("*", F.col("_metadata.file_path").alias(file))
    unquoted = F.regexp_replace(F.col(_RAGGED), _QUOTED, "")
    broken = F.col(_RAGGED).isNotNull() & (F.size(F.split(unquoted, ",")) > len(names))
    first = F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))  # Spark refuses a query of ragged lines alone
    error = F.raise_error(F.concat(F.lit("too many cells in line: "), F.col(_RAGGED), F.lit(", first cell: "), first))
    return rows.filter(F.when(broken, error.cast("boolean")).otherwise(True))


def _select(rows: DataFrame, names: list[str], file: str) -> DataFrame:
    return rows.select(file, *[blank_missing(F.col(f"`{name}`")).alias(name) for name in names])


def read_csv(
    spark: SparkSession, path: str, declared: T.StructType, multiline: bool = False,
    date_formats: tuple[str, ...] | None = None, lost: Observation | None = None,
) -> DataFrame:
    """A CSV source with declared types; see :func:`starloom.functions.coerce.typed`."""
    rows, file = _text(spark, path, multiline)
    return typed(rows, declared, date_formats, lost, file)
