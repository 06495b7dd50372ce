"""Typing rules for source columns that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cell texts a CSV source uses for "no value".
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Names of months, in full or by three letters.
MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
)
_HAS_ZONE = r"[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d*)?)?\s*(?:[A-Za-z]|[+-]\d)"
# Two-digit years from this one on belong to the 20th century.
_PIVOT = 69

# One expression for each shape of a date, and the same date with the year first; what follows it is judged by the cast.
_ISO = r"^\d{4}(?:-|$)"
_NUMERIC = r"^(\d{1,2})([/.-])(\d{1,2})\2(\d{4}|\d{2})(?!\d)"
_SHAPES = {
    r"^(\d{4})(\d{2})(\d{2})[T ]?(\d{2})(\d{2})(\d{2})$": "$1-$2-$3 $4:$5:$6",
    r"^(\d{4})(\d{2})(\d{2})(?!\d)": "$1-$2-$3",
    r"^([A-Za-z]{3,9})\.? +(\d{1,2}),? +(\d{4})(?!\d)": "$3-$1-$2",
    r"^(\d{1,2})[- ]([A-Za-z]{3,9})\.?,?[- ](\d{4})(?!\d)": "$3-$2-$1",
    r"^(\d{4})([/.])(\d{1,2})\2(\d{1,2})(?!\d)": "$1-$3-$4",
}
# Numeric dates that are valid in one order only.
_HIGH, _LOW, _YEAR = r"(?:1[3-9]|2\d|3[01])", r"(?:0?[1-9]|1[0-2])", r"\1\d{2}(?:\d{2})?(?!\d)"
_ONLY_DAY_FIRST = rf"^\s*{_HIGH}([/.-]){_LOW}{_YEAR}"
_ONLY_MONTH_FIRST = rf"^\s*{_LOW}([/.-]){_HIGH}{_YEAR}"


def is_temporal_name(name: str) -> bool:
    """Whether a column is read as a timestamp, judged by its name alone.

    The rule is about the name only, so ``update_count`` and ``lifetime``
    count as temporal too.
    """
    lowered = name.lower()
    return "date" in lowered or "time" in lowered


def blank_missing(cell: Column) -> Column:
    return F.when(~cell.isin(*MISSING_TEXTS), cell)


def _in_utc(instant: Column) -> Column:
    """A point in time as UTC shows it, whatever the session's zone."""
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000)
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )


def _cast(text: Column) -> Column:
    """An ISO text as it is, or in UTC where it names an offset."""
    return F.when((F.length(text) > 10) & text.rlike(_HAS_ZONE), _in_utc(text.try_cast("timestamp"))).otherwise(text.try_cast("timestamp_ntz"))


def _year_first(text: Column, day_first: Column | bool) -> Column:
    """A date of any known shape with its parts in the ISO order, NULL for other shapes."""
    order = F.when(day_first, "$4-$3-$1").otherwise("$4-$1-$3") if isinstance(day_first, Column) else (
        F.lit("$4-$3-$1" if day_first else "$4-$1-$3")
    )
    found = F.when(text.rlike(_ISO), text).when(text.rlike(_NUMERIC), F.regexp_replace(text, F.lit(_NUMERIC), order))
    for shape, parts in _SHAPES.items():
        found = found.when(text.rlike(shape), F.regexp_replace(text, shape, parts))
    return found


def _in_numbers(text: Column) -> Column:
    """A date whose month may be a name and whose year may have two digits, in numbers alone."""
    names = [name[:3] for name in MONTHS] + list(MONTHS)
    word = F.split_part(text, F.lit("-"), F.lit(2))
    place = F.array_position(F.array(*map(F.lit, names)), F.lower(word))
    month = F.when(place > 0, ((place - 1) % 12 + 1).cast("string"))
    century = F.when(F.left(text, F.lit(2)).cast("int") < _PIVOT, "20").otherwise("19")
    return (
        F.when(F.substring(text, 3, 1) == "-", F.concat(century, text))
        .when(F.substring(text, 6, 1).between("A", "z"), F.replace(text, word, month))
        .otherwise(text)
    )


def _on_half_day(at: Column, half: Column) -> Column:
    """An hour of 1 to 12 in the morning (``am``) or afternoon; any other hour is none."""
    shift = F.hour(at) % 12 - F.hour(at) + F.when(half == "pm", 12).otherwise(0)
    return F.when(F.hour(at).between(1, 12), at + F.make_dt_interval(F.lit(0), shift))


def lenient_timestamps(rows: DataFrame, day_first: dict[str, Column | bool]) -> DataFrame:
    """The named text columns as zone-less timestamps, NULL where a text is none.

    ISO texts are read as they are, or in UTC where they name an offset.  Other
    texts are told by their shape, and each shape has one reading: numbers with
    ``/``, ``-`` or ``.`` (day or month first as ``day_first`` says, or the year
    first), eight or fourteen digits in a row, or a month's name; with a time
    or without, on a clock of 24 or of 12 hours.  A year of two digits lies
    between 1969 and 2068.  A time without a date is no timestamp, nor are five
    or six digits in a row.
    """
    cells = {name: F.col(f"`{name}`") for name in day_first}
    halves = {name: f"_half_{place}" for place, name in enumerate(day_first)}
    # Each step reads the one before more than once, so they stay apart in the plan and each is computed once.
    rows = rows.withColumns({name: F.trim(cell) for name, cell in cells.items()})
    rows = rows.withColumns({name: _year_first(cell, day_first[name]) for name, cell in cells.items()})
    rows = rows.withColumns({name: _in_numbers(cell) for name, cell in cells.items()})
    ending = {name: F.lower(F.right(cell, F.lit(2))) for name, cell in cells.items()}
    rows = rows.withColumns({halves[name]: F.when(ending[name].isin("am", "pm"), ending[name]) for name in cells})
    rows = rows.withColumns({
        name: F.when(F.col(halves[name]).isNull(), cell).otherwise(F.rtrim(F.expr(f"left(`{name}`, length(`{name}`) - 2)")))
        for name, cell in cells.items()
    })
    rows = rows.withColumns({name: _cast(cell) for name, cell in cells.items()})
    return rows.withColumns({
        name: F.when(F.col(halves[name]).isNull(), cell).otherwise(_on_half_day(cell, F.col(halves[name])))
        for name, cell in cells.items()
    }).drop(*halves.values())


def formatted_timestamp(cell: Column, formats: tuple[str, ...]) -> Column:
    """A zone-less timestamp: an ISO text, or one in the first of ``formats`` that fits; else NULL."""
    utc = F.concat(cell, F.lit(" +00:00"))
    others = [_in_utc(F.try_to_timestamp(utc, F.lit(f"{format} XXX"))) for format in formats]
    # The formats run only where a cell is neither missing nor ISO.
    read = F.when(F.trim(cell).rlike(_ISO), _cast(cell))
    return F.when(cell.isNull(), F.lit(None).cast("timestamp_ntz")).otherwise(F.coalesce(read, *others))


def day_first_votes(rows: DataFrame, names: list[str], by: str) -> DataFrame:
    """By ``by`` and for each text column: whether its numeric dates have the day first.

    They have if more of them are dates only that way than only the other way.
    The counts are summed map-side, one row for each value of ``by``.
    """
    cells = {name: F.col(f"`{name}`") for name in names}
    return rows.groupBy(F.col(f"`{by}`")).agg(*[
        (F.count_if(cell.rlike(_ONLY_DAY_FIRST)) > F.count_if(cell.rlike(_ONLY_MONTH_FIRST))).alias(name)
        for name, cell in cells.items()
    ])


def _whole_number(cell: Column, kind: T.DataType) -> Column:
    """Whole numbers, also those written with a fraction of zeros, as ``12.0``, or with an exponent, as ``1.2e3``.

    Only texts that are such numbers are cast: a cast that fails is dear.
    """
    number = F.trim(cell)
    fraction = F.rtrim(F.regexp_extract(number, r"\.(\d*)", 1), F.lit("0"))
    power = F.regexp_extract(number, r"[eE]\+?(\d{1,2})$", 1).try_cast("int")
    digits = (
        F.when(number.rlike(r"^[+-]?\d+$"), number)
        .when(number.rlike(r"^[+-]?\d+\.0*$"), F.split_part(number, F.lit("."), F.lit(1)))
        .when(
            number.rlike(r"^[+-]?\d+(?:\.\d*)?[eE]\+?\d{1,2}$") & (F.length(fraction) <= power),
            number.try_cast("decimal(38,0)").cast("string"),
        )
    )
    return digits.try_cast(kind)


def strict_cast(cell: Column, kind: T.DataType, what: str) -> Column:
    """``cell`` as ``kind``; a value that does not fit fails the job, in any ANSI mode.

    For integer kinds ``12.0`` fits and ``12.5`` does not.
    """
    error = F.raise_error(
        F.concat(F.lit(f"{what} does not fit {kind.simpleString()}: "), cell.cast("string"))
    ).cast(kind)
    return F.coalesce(cell.try_cast(kind), F.when(cell.isNotNull(), error))


def typed(
    rows: DataFrame, declared: T.StructType, date_formats: tuple[str, ...] | None = None,
    lost: Observation | None = None, file: str | None = None,
) -> DataFrame:
    """Type the text columns of a source.

    Temporal names are coerced leniently, other declared columns are cast
    strictly (bad text fails the load), and undeclared columns stay text.  A
    declared column that the source lacks fails at once.  Whether numeric dates
    have the day or the month first is decided for each column by a look at all
    its cells, when this is called; for each file apart where a column ``file``
    names it, which is then left out.  ``date_formats`` names formats instead.
    ``lost`` observes, by column, how many cells held a text that is no date; it
    has them once the rows have been written.
    """
    names = [name for name in rows.columns if name != file]
    absent = [name for name in declared.names if name not in names]
    if absent:
        raise ValueError(f"source lacks the columns {absent}")
    dates = [name for name in names if is_temporal_name(name)]
    seen = {name: f"_had_text_{place}" for place, name in enumerate(dates)}
    rows = rows.withColumns({flag: F.col(f"`{name}`").isNotNull() for name, flag in seen.items()} if lost else {})
    if date_formats is not None:
        rows = rows.withColumns({name: formatted_timestamp(F.col(f"`{name}`"), date_formats) for name in dates})
    elif dates:
        rows = lenient_timestamps(*_with_orders(rows, dates, file))

    def column(name: str) -> Column:
        cell = F.col(f"`{name}`")
        if name in dates or name not in declared.names:
            return cell
        kind = declared[name].dataType
        if isinstance(kind, T.IntegralType):
            return F.coalesce(_whole_number(cell, kind), strict_cast(cell, kind, name)).alias(name)
        return strict_cast(cell, kind, name).alias(name)

    if lost is None or not dates:
        return rows.select(*[column(name) for name in names])
    counts = [F.count_if(F.col(flag) & F.col(f"`{name}`").isNull()).alias(name) for name, flag in seen.items()]
    return rows.select(*[column(name) for name in names], *seen.values()).observe(lost, *counts).drop(*seen.values())


def _with_orders(rows: DataFrame, dates: list[str], file: str | None) -> tuple[DataFrame, dict[str, Column | bool]]:
    """Whether each column has the day first; where files differ, as columns joined by file, one row for each file."""
    by = file or "_all_rows"
    counted = rows if file else rows.withColumn(by, F.lit(""))
    votes = day_first_votes(counted, dates, by).collect()
    if len({row[1:] for row in votes}) <= 1:
        return rows, {name: bool(votes and votes[0][place]) for place, name in enumerate(dates, 1)}
    names = [f"_day_first_{place}" for place in range(len(dates))]
    table = rows.sparkSession.createDataFrame(
        [tuple(row) for row in votes], ", ".join([f"`{by}` string", *(f"{name} boolean" for name in names)])
    )
    return rows.join(F.broadcast(table), by, "left"), dict(zip(dates, map(F.col, names)))
