"""CSV and day-partitioned tables, there and back."""

import csv
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagegrid import schemas
from wagegrid.sources import csv_rows, readers, writers

ROWS = [
    ("say \"hi\", all", "New York, NY", "Acme", "\n   $70,000 - $80,000 a year", "two\nlines \\ here"),
    ("", None, " padded ", "None", "é — ü"),
    (None, None, None, None, None),
    ("\\\"odd\\", "a,b", "x;y", "$1", "'quoted'"),
]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(ROWS, schemas.LISTINGS_RAW)
    path = str(tmp_path / "csv")
    writers.write_csv(df, path)
    back = readers.read_listings_csv(spark, path)
    assert back.columns == schemas.LISTINGS_RAW.names
    # As with data frames read from CSV elsewhere, an empty text is a missing one.
    want = df.replace("", None)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, want.collect()))


@pytest.fixture
def ranges(spark):
    """Sets how many bytes of a file one task reads."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def read_by(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield read_by
    for k, v in before.items():
        spark.conf.set(k, v)


def _cells(draw, n):
    """Texts with line breaks, quotes, commas, carriage returns and empty lines in quotes."""
    marks = ["\n", '"', ",", "\r\n", "\n\n", "x", " y", "é", '""', "\\", "long " * 9]
    return ["a" + "".join(draw.choice(marks) for _ in range(draw.randrange(7))) + "z" for _ in range(n)]


@pytest.mark.parametrize("size", [10**9, 4_000, 700, 90, 20])
def test_rows_do_not_depend_on_ranges(spark, tmp_path, ranges, size):
    draw = random.Random(4)
    rows = [(i, *_cells(draw, 2)) for i in range(200)]
    rows[50] = (50, "inside quotes for many ranges\n" * 60, "z")
    for name in ("one", "two"):  # several files, the last without a line end
        with open(tmp_path / f"{name}.csv", "w", newline="") as file:
            writer = csv.writer(file, lineterminator="\r\n" if name == "one" else "\n")
            writer.writerow(["i", 'a "header"\nof lines', "b"])
            writer.writerows(rows)
            if name == "two":
                file.write("200,last,row")
    ranges(size)
    schema = T.StructType([T.StructField("i", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("an a", "b: 2")]])
    read = readers.read_listings_csv(spark, str(tmp_path), schema)
    assert sorted(map(tuple, read.collect())) == sorted([*rows, *rows, (200, "last", "row")])
    if size == 20:
        assert csv_rows._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 50


def test_many_open_ranges_are_joined(spark, tmp_path, ranges, monkeypatch):
    monkeypatch.setattr("wagegrid.settings.small_side", lambda df, *_: df)
    test_rows_do_not_depend_on_ranges(spark, tmp_path, ranges, 90)


def test_lines_that_are_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n\n1,"open\n2,b\n')
    (tmp_path / "b.csv").write_text("x,y\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text('x,y\n"",3\n  \n5\n')
    read = readers.read_listings_csv(spark, str(tmp_path), T.StructType([T.StructField(c, T.StringType()) for c in "xy"]))
    assert sorted(map(tuple, read.collect()), key=repr) == [("1", "open\n2,b"), ("5", None), (None, "3")]


def test_numbers_round_trip(spark, tmp_path):
    df = spark.range(50).selectExpr(
        "id", "id / 7 as x", "timestamp_ntz'2024-01-01 00:00:00.123456' as t",
        "cast(null as int) as n",
    )
    path = str(tmp_path / "csv")
    writers.write_csv(df, path)
    back = readers.read_listings_csv(spark, path, df.schema, multi_line=False)
    assert sorted(back.collect()) == sorted(df.collect())


def test_saved_index_is_dropped(spark):
    df = spark.createDataFrame([(0, "a")], "`Unnamed: 0` int, Title string")
    assert readers.drop_saved_index(df).columns == ["Title"]


def test_details_are_cast_and_appended(spark, tmp_path):
    path = str(tmp_path / "details")
    text = {f.name: "x" for f in schemas.JOB_DETAILS}
    text |= {
        "search_datetime": "20240101 10:00", "search_detail_datetime": "20240102 11:30",
        "company_rating": "3.5", "company_rating_count": "7",
    }
    df = spark.createDataFrame([tuple(text.values())], list(text)).select(*reversed(list(text)))
    for _ in range(2):
        writers.append_details(df, path)
    back = spark.read.parquet(path)
    assert back.count() == 2
    assert back.drop("detail_date").schema.names == schemas.JOB_DETAILS.names
    row = back.first()
    assert (row.company_rating, row.company_rating_count) == (3.5, 7)
    assert str(row.search_detail_datetime) == "2024-01-02 11:30:00"
    assert str(row.detail_date) == "2024-01-02"


def test_a_run_counts_once(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.range(6).selectExpr("id", "timestamp'2024-01-01 12:00:00' + make_interval(0, 0, 0, id) as search_datetime")
    writers.append_search_day(rows, path, run="2024-01-06")
    writers.append_search_day(rows.where("id < 2"), path, run="b")
    # the second attempt has fewer days: those of the first do not stay
    for _ in range(2):
        writers.append_search_day(rows.where("id > 3"), path, run="2024-01-06")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 4, 5]
    day = readers.read_day(spark, path, "2024-01-02")
    assert [(r.id, r.run) for r in day.collect()] == [(1, "b")]
    with pytest.raises(ValueError, match="run names"):
        writers.append_search_day(rows, path, run="../x")


def test_sheet_is_cleared_or_kept(spark, tmp_path):
    path = str(tmp_path / "sheet")
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    cells = T.StructType([T.StructField(c, T.StringType()) for c in df.columns])
    for clear, rows in ((True, 2), (False, 4), (True, 2)):
        writers.export_sheet(df, path, clear=clear)
        assert readers.read_listings_csv(spark, path, cells, multi_line=False).count() == rows


def test_new_ids_and_days(spark, tmp_path):
    path = str(tmp_path / "ids")
    row = ("j", None, "t", "l", "c", "st", "sl")
    spark.createDataFrame([row], schemas.NEW_IDS).write.parquet(path)
    ids = readers.read_new_ids(spark, path)
    assert "search_datetime" in ids.columns and "new_search_datetime" not in ids.columns
    days = str(tmp_path / "days")
    stamped = spark.range(4).withColumn(
        "search_datetime", F.expr("timestamp'2024-01-01 23:59:59' + make_interval(0,0,0,0,0,0,id)")
    )
    writers.append_search_day(stamped, days)
    assert readers.read_day(spark, days, "2024-01-01").count() == 1
    assert readers.read_day(spark, days, "2024-01-02").count() == 3


def test_range_ends_are_in(spark):
    df = spark.createDataFrame(
        [("2019-01-01 00:00:00",), ("2019-02-01 00:00:00",), ("2019-02-01 00:00:01",)], "t string"
    ).selectExpr("cast(t as timestamp) t")
    assert readers.read_date_range(df, "t", "2019-01-01", "2019-02-01").count() == 2
