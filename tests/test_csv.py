import csv
import datetime
import random
from decimal import Decimal

import pandas
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from starloom.functions.coerce import is_temporal_name, typed
from starloom.schemas import TABLES
from starloom.sources.csv import read_csv, read_text_columns

CAMPAIGNS = TABLES["stg_marketing_campaigns"].columns
PRODUCTS = TABLES["stg_products"].columns
FAILED = (PySparkException, Py4JJavaError)


def _file(folder, text):
    path = folder / "source.csv"
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_columns_are_typed_by_header_name(spark, tmp_path):
    path = _file(tmp_path, "price,product_id,category,product_name\n1000,1,Fashion,Baju\n")
    row = read_csv(spark, path, PRODUCTS).collect()[0]
    assert row.asDict() == {
        "price": Decimal("1000.00"), "product_id": 1, "category": "Fashion", "product_name": "Baju",
    }


def test_bad_date_is_null_and_row_stays(spark, tmp_path):
    path = _file(
        tmp_path,
        "campaign_id,campaign_name,start_date,end_date,channel\n"
        "1,Spring,bad,2025-01-02 03:04:05,SEO\n2,Autumn,2025-06-01T01:02:03,2025-06-02,Email\n",
    )
    rows = {row.campaign_id: row for row in read_csv(spark, path, CAMPAIGNS).collect()}
    assert rows[1].start_date is None
    assert rows[1].end_date == datetime.datetime(2025, 1, 2, 3, 4, 5)
    assert rows[2].start_date == datetime.datetime(2025, 6, 1, 1, 2, 3)
    assert rows[2].end_date == datetime.datetime(2025, 6, 2)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("cells", ["x,Baju,Fashion,1000", "9999999999999999999,Baju,Fashion,1", "1,Baju,Fashion,1e17"])
def test_bad_number_fails_the_load(spark, tmp_path, cells, ansi):
    path = _file(tmp_path, f"product_id,product_name,category,price\n{cells}\n")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(FAILED, match="does not fit"):
            read_csv(spark, path, PRODUCTS).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_missing_value_texts_are_null(spark, tmp_path):
    path = _file(tmp_path, 'product_id,product_name,category,price\n1,NULL,N/A,\n2,"",none,nan\n3,Nan,NA ,5\n')
    rows = {row.product_id: tuple(row)[1:] for row in read_csv(spark, path, PRODUCTS).collect()}
    assert rows == {1: (None, None, None), 2: (None, "none", None), 3: ("Nan", "NA ", Decimal("5.00"))}


def test_quotes_commas_and_letters_survive(spark, tmp_path):
    path = _file(tmp_path, 'product_id,product_name,category,price\n1,"A ""b"", c","é\\x",2.675\n')
    row = read_csv(spark, path, PRODUCTS).collect()[0]
    assert (row.product_name, row.category, row.price) == ('A "b", c', "é\\x", Decimal("2.68"))


def test_line_break_in_a_cell_on_request(spark, tmp_path):
    path = _file(tmp_path, 'product_id,product_name,category,price\n1,"A\nb",c,1\n')
    assert read_csv(spark, path, PRODUCTS, multiline=True).collect()[0].product_name == "A\nb"


@pytest.mark.parametrize("line", ['1,"A\nb",c,1', '1,x,"A\nb",1', '1,x,c,"A\nb"', '1,"A\nb, c","d",1'])
def test_line_break_in_a_cell_is_not_read_as_two_lines(spark, tmp_path, line):
    path = _file(tmp_path, f"product_id,product_name,category,price\n{line}\n")
    rows = read_text_columns(spark, path)
    assert rows.count() == 1 and "A\nb" in "|".join(rows.collect()[0])
    assert rows.collect() == read_text_columns(spark, path, multiline=True).collect()


def test_lone_quote_in_a_short_line(spark, tmp_path):
    path = _file(tmp_path, 'product_id,product_name,category,price\n1,a"b\n')
    assert tuple(read_text_columns(spark, path).collect()[0]) == ("1", 'a"b', None, None)


def test_short_line_is_padded_and_long_line_fails(spark, tmp_path):
    header = "product_id,product_name,category,price\n"
    short = read_csv(spark, _file(tmp_path, header + "1,Baju\n\n2,Topi,Fashion,1\n"), PRODUCTS)
    assert sorted(map(tuple, short.collect())) == [(1, "Baju", None, None), (2, "Topi", "Fashion", Decimal("1.00"))]
    assert short.select("product_id").count() == 2
    long = _file(tmp_path, header + '1,"a,b",Fashion,1\n2,Topi,Fashion,1,9\n')
    for columns in (["*"], ["product_id"]):
        with pytest.raises(FAILED, match="too many cells"):
            read_csv(spark, long, PRODUCTS).select(*columns).collect()
    with pytest.raises(FAILED, match="too many cells"):
        read_csv(spark, long, PRODUCTS).count()
    assert read_csv(spark, _file(tmp_path, header + '1,"a,b"\n'), PRODUCTS).count() == 1


def test_missing_column_fails(spark, tmp_path):
    with pytest.raises(ValueError, match="price"):
        read_csv(spark, _file(tmp_path, "product_id,product_name,category\n1,a,b\n"), PRODUCTS)


def test_name_rule():
    assert [name for name in ("signup_date", "update_count", "LIFETIME", "city", "data") if is_temporal_name(name)] == [
        "signup_date", "update_count", "LIFETIME",
    ]


def test_undeclared_columns_follow_the_name_rule(spark):
    text = spark.createDataFrame([("1", "7", "2024-01-01", "x")], "product_id string, update_count string, "
                                 "uptime string, note string")
    declared = type(PRODUCTS)([PRODUCTS["product_id"]])
    row = typed(text, declared).collect()[0]
    assert tuple(row) == (1, None, datetime.datetime(2024, 1, 1), "x")


@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
def test_cells_read_as_pandas_reads_them(spark, tmp_path, quoting):
    pick = random.Random(quoting)
    pieces = ["a", " ", '"', ",", "'", "\\", "é", "漢", "NA", "null", "#", "\t", "0", "-", '""', "None", "😀", ";"]
    rows = [[str(n)] + ["".join(pick.choices(pieces, k=pick.randrange(5))) for _ in range(3)] for n in range(400)]
    path = tmp_path / "cells.csv"
    with open(path, "w", newline="", encoding="utf-8") as file:
        csv.writer(file, quoting=quoting).writerows([["id", "x", "sale date", "z"], *rows])
    frame = pandas.read_csv(path, dtype=str)
    expected = [tuple(None if pandas.isna(cell) else cell for cell in row) for row in frame.itertuples(index=False)]
    read = read_text_columns(spark, str(path))
    assert read.columns == list(frame.columns)
    assert sorted(map(tuple, read.collect())) == sorted(expected)


@pytest.mark.parametrize("length", [20_000, 1_000_000])
def test_short_lines_with_long_cells(spark, tmp_path, length):
    path = _file(tmp_path, f'a,b,c\n1,"{"x" * length}"\n2,"{'"",' * (length // 3)}"\n3,y,z\n')
    rows = {row.a: row for row in read_text_columns(spark, path).collect()}
    assert len(rows["1"].b) == length and rows["1"].c is None
    assert rows["2"].b == '",' * (length // 3) and rows["2"].c is None and rows["3"].c == "z"


def _as_pandas(path):
    frame = pandas.read_csv(path, dtype=str, lineterminator=None)
    return frame.columns.tolist(), [tuple(None if pandas.isna(c) else c for c in row) for row in frame.itertuples(index=False)]


@pytest.fixture
def splits(spark, request):
    """Files cut into splits of a few bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield request.param
    for name in settings:
        spark.conf.unset(name)


@pytest.mark.parametrize("text", ['1,"abc\n2,def"\n3,z', '1,"a""b\n2,c"', '1,"""\n2,x"', '"1\n2",x', '1,"a,b\n2,c"'])
@pytest.mark.parametrize("splits", [1, 5, 1 << 20], indirect=True)
def test_records_over_several_lines(spark, tmp_path, text, splits):
    path = _file(tmp_path, f"id,name\n{text}\n")
    rows = read_text_columns(spark, path)
    assert sorted(map(tuple, rows.collect())) == sorted(_as_pandas(path)[1])
    assert rows.count() == rows.select("id").count() == len(_as_pandas(path)[1])


@pytest.mark.parametrize("text", ['1,"abc\n2,def', '1,"a\n2,c""', '"', '1,x\n2,"\n\n'])
@pytest.mark.parametrize("splits", [3, 1 << 20], indirect=True)
def test_a_cell_that_never_ends_fails(spark, tmp_path, text, splits):
    with pytest.raises(ValueError, match="does not end"):
        read_text_columns(spark, _file(tmp_path, f"id,name\n{text}\n"))


def _random_record(pick, cells):
    def text(letters, most=6):
        return "".join(pick.choices(letters, k=pick.randrange(most)))

    made = []
    for _ in range(cells):
        inner = text(["a", "\n", ",", '""', "é", "\r\n", " ", "b c"])
        made.append(pick.choice([
            text(["a", "'", "é", "\\", "-", "x"]), 'q"' + text(["a", '"', " ", "z"]), f'"{inner}"', f'"{inner}"', f'"{inner}"',
            f'"{inner}"' + text(["k", " m", "n"], 3),
        ]))
    return ",".join(made)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("splits", [11, 40, 150, 1 << 20], indirect=True)
def test_random_records_read_as_pandas_reads_them(spark, tmp_path, splits, ending):
    pick = random.Random(f"{splits}{ending}")
    for number in range(3):
        lines = ["id,x,sale date"] + [f"{n}," + _random_record(pick, pick.choice([1, 2, 2, 2])) for n in range(60)]
        lines += ["", "7,8,9"]
        path = tmp_path / f"{number}.csv"
        path.write_bytes(ending.join(lines).encode() + ending.encode() * pick.randrange(3))
        names, expected = _as_pandas(path)
        read = read_text_columns(spark, str(path))
        assert read.columns == names
        assert sorted(map(repr, map(tuple, read.collect()))) == sorted(map(repr, expected))


@pytest.mark.parametrize("splits", [30], indirect=True)
def test_long_cell_over_many_splits_and_files(spark, tmp_path, splits):
    folder = tmp_path / "many"
    folder.mkdir()
    expected = []
    for number in range(4):
        cells = [(f"{number}-{n}", "line\n" * (200 if n == 2 else n % 3), "z") for n in range(6)]
        expected += [tuple(c or None for c in row) for row in cells]
        with open(folder / f"{number}.csv", "w", newline="", encoding="utf-8") as file:
            csv.writer(file, lineterminator="\n").writerows([("id", "x", "y"), *cells])
    read = read_text_columns(spark, str(folder))
    assert read.rdd.getNumPartitions() > 40
    assert sorted(map(tuple, read.collect())) == sorted(expected)
    (folder / "9.csv").write_text('id,y,x\n1,"a\nb",c\n')
    with pytest.raises(FAILED, match="header of"):
        read_text_columns(spark, str(folder)).collect()


@pytest.mark.parametrize("line", ['1,5" x,6" y,lost', "1,2,3,", '1,"a,b",3,4', '1,"a\nb",3,4', '"a"b"c",1,2'])
def test_the_parser_counts_the_cells(spark, tmp_path, line):
    path = _file(tmp_path, f"a,b,c\n7,8,9\n{line}\n")
    for read in (lambda rows: rows.collect(), lambda rows: rows.count(), lambda rows: rows.select("a").collect()):
        with pytest.raises(FAILED, match="in line: "):
            read(read_text_columns(spark, path))


def test_carriage_returns_between_lines(spark, tmp_path):
    path = tmp_path / "source.csv"
    path.write_bytes(b'a,b\r1,"x"\r2,y\r')
    assert sorted(map(tuple, read_text_columns(spark, str(path)).collect())) == [("1", "x"), ("2", "y")]
    path.write_bytes(b'a,b\n1,"x\ny"\n2,y\r3,z\n')
    with pytest.raises(FAILED, match="carriage return"):
        read_text_columns(spark, str(path)).collect()


def test_splits_do_not_follow_the_cores(spark, tmp_path):
    path = _file(tmp_path, "id,x\n" + "".join(f'{n},"a\nb{n}"\n' for n in range(3000)))
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = read_text_columns(spark, path)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "11")
        assert rows.filter("x = concat('a\n', 'b', id)").count() == 3000
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("others", [1, 2])
def test_splits_do_not_follow_the_other_files(spark, tmp_path, others):
    """Only files with a record over two splits are read again, and then alone."""
    folder = tmp_path / "many"
    folder.mkdir()
    cells = ["x" * 9] * 4000 + ["y\n" * 25_000] + ["x" * 9] * 1500
    with open(folder / "0.csv", "w", newline="") as file:
        csv.writer(file, lineterminator="\n").writerows([("id", "x"), *enumerate(cells)])
    for number in range(1, others + 1):
        (folder / f"{number}.csv").write_text("id,x\n" + "".join(f"{n},{'z' * 14}\n" for n in range(6500)))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = read_text_columns(spark, str(folder))
        assert sorted(tuple(row) for row in rows.filter("x not like 'z%'").collect()) == sorted(
            (str(number), cell) for number, cell in enumerate(cells)
        )
        assert rows.filter(f"x = '{'z' * 14}'").count() == 6500 * others
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_lines_are_read_as_they_are(spark, tmp_path):
    path = _file(tmp_path, 'a,b\n "x" ,y\\\n\n5" pipe, z \n#c,"q\\"\n')
    assert [tuple(r) for r in read_text_columns(spark, path).collect()] == [
        (' "x" ', "y\\"), ('5" pipe', " z "), ("#c", "q\\"),
    ]


def test_files_with_other_headers_fail(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "one.csv").write_text("a,b\n1,2\n")
    (folder / "two.csv").write_text("b,a\n3,4\n")
    with pytest.raises(FAILED):
        read_text_columns(spark, str(folder)).collect()
    (folder / "two.csv").write_text("a,b\n3,4\n")
    assert sorted(map(tuple, read_text_columns(spark, str(folder)).collect())) == [("1", "2"), ("3", "4")]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_dates_as_exports_write_them(spark, tmp_path, zone):
    cells = {
        "06/15/2025": "2025-06-15 00:00:00", "20250615": "2025-06-15 00:00:00", "Jun 15 2025": "2025-06-15 00:00:00",
        "2025-06-15T10:00:00+07:00": "2025-06-15 03:00:00", "2025-06-15 10:00:00Z": "2025-06-15 10:00:00",
        "03/09/2025 2:30": "2025-03-09 02:30:00", "2025-03-09 02:30:00": "2025-03-09 02:30:00", "13/45/2025": None,
        "bad": None, "6/5/2025 1:02:03 PM": "2025-06-05 13:02:03",
    }
    path = _file(tmp_path, "start_date\n" + "\n".join(cells) + "\n")
    kept = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = typed(read_text_columns(spark, path), type(CAMPAIGNS)([CAMPAIGNS["start_date"]])).selectExpr("string(start_date) AS d").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)
    assert [row.d for row in rows] == list(cells.values())


DATES = [
    "06/15/2025", "1/2/25", "12/31/99", "2025-06-15 10:00:00 PM", "6/5/2025 12:02:03 AM", "6/5/2025 12:02 pm", "Jun 15 2025",
    "June 5, 2025 3:04 PM", "15 Jun 2025", "15-Jun-2025", "2025/06/15", "2025/6/5 7:08", "20250615", "20250615103000",
    "20250615T103000", "2025-6-5", "2025-06-05T10:11:12.5", " 2025-06-05 ", "2025", "2025-06", "06-15-2025", "06.15.2025 1:02:03",
    "2025-02-30", "32/01/2025", "202506", "12345", "T12:30:00Z", "bad", "2025-06-15 13:00:00 PM", "Juny 5 2025", "",
    "2025-06-05 25:00:00",
]


def _read_dates(spark, cells, **how):
    rows = spark.createDataFrame([(n, cell) for n, cell in enumerate(cells)], "n int, a_date string")
    declared = TABLES["stg_marketing_campaigns"].columns
    found = typed(rows, type(declared)([]), **how).orderBy("n").selectExpr("string(a_date) AS d").collect()
    return [row.d for row in found]


def test_dates_of_every_shape_as_pandas_reads_each(spark):
    expected = [pandas.to_datetime(pandas.Series([cell]), errors="coerce", format=None)[0] for cell in DATES]
    for cell, found, other in zip(DATES, _read_dates(spark, DATES), expected):
        assert (found and pandas.Timestamp(found)) == (None if pandas.isna(other) else other), cell


def test_times_without_a_date_are_lost(spark):
    assert _read_dates(spark, ["12:30:00", "T12:30:00Z", "10:00 PM", "7"]) == [None] * 4


def test_years_of_two_digits(spark):
    assert _read_dates(spark, ["1/2/68", "1/2/69"]) == ["2068-01-02 00:00:00", "1969-01-02 00:00:00"]


@pytest.mark.parametrize("mark", "/-.")
def test_the_column_tells_whether_days_come_first(spark, mark):
    cells = [f"{day:02}{mark}06{mark}2025 10:00" for day in range(1, 31)] + ["07/31/2025"]
    assert _read_dates(spark, cells) == [f"2025-06-{day:02} 10:00:00" for day in range(1, 31)] + [None]
    turned = [f"06{mark}{day:02}{mark}25" for day in range(1, 31)] + ["31/07/2025"]
    assert _read_dates(spark, turned) == [f"2025-06-{day:02} 00:00:00" for day in range(1, 31)] + [None]
    assert _read_dates(spark, ["01/02/2025", "13/02/2025", "02/13/2025"])[0] == "2025-01-02 00:00:00"


def test_each_file_and_column_has_its_own_order(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.csv").write_text("start_date,end_date\n13/01/2025,01/13/2025\n02/01/2025,02/01/2025\n")
    (folder / "b.csv").write_text('start_date,end_date\n01/13/2025,13/01/2025\n02/01/2025,"02/01/\n2025"\n')
    declared = type(CAMPAIGNS)([CAMPAIGNS["start_date"], CAMPAIGNS["end_date"]])
    rows = read_csv(spark, str(folder), declared).selectExpr("string(date(start_date)) AS s", "string(date(end_date)) AS e").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([
        ("2025-01-13", "2025-01-13"), ("2025-01-02", "2025-02-01"), ("2025-01-13", "2025-01-13"), ("2025-02-01", None),
    ], key=str)


def test_named_formats_replace_the_shapes(spark):
    assert _read_dates(spark, ["2025|06|15", "06/15/2025", "2025-06-15"], date_formats=("yyyy|MM|dd",)) == [
        "2025-06-15 00:00:00", None, "2025-06-15 00:00:00",
    ]


def test_whole_numbers_with_exponents(spark, tmp_path):
    one = type(PRODUCTS)([PRODUCTS["product_id"]])
    path = _file(tmp_path, "product_id\n1e3\n1.5E+1\n12.\n")
    assert [r.product_id for r in read_csv(spark, path, one).collect()] == [1000, 15, 12]
    for cell in ("12.0000001", "1.25e1", "12.00000000000000000000001", "1e-1", "1e30"):
        with pytest.raises(FAILED, match="does not fit bigint"):
            read_csv(spark, _file(tmp_path, f"product_id\n{cell}\n"), one).collect()


def test_whole_numbers_with_a_fraction_of_zeros(spark, tmp_path):
    path = _file(tmp_path, "product_id\n12.0\n7\n-3.00\n")
    assert [r.product_id for r in read_csv(spark, path, type(PRODUCTS)([PRODUCTS["product_id"]])).collect()] == [12, 7, -3]
    with pytest.raises(FAILED, match="does not fit bigint: 12.5"):
        read_csv(spark, _file(tmp_path, "product_id\n12.5\n"), type(PRODUCTS)([PRODUCTS["product_id"]])).collect()
