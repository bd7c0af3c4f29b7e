"""Salary and place texts, filters, casts and joins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wagegrid import fixed_values, schemas
from wagegrid.functions import places, salary
from wagegrid.operators import cleaning, grid, joins, stats


def _numbers(spark, text, **options):
    df = spark.createDataFrame([(text,)], "Salary string")
    row = salary.parse_salary(df, **options).first()
    return row.Low, row.High, row.Average


@pytest.mark.parametrize(
    "text, expected",
    [
        ("$117,500 - $127,500 a year", (117500, 127500, 122500)),
        ("$80,000 a year", (80000, None, 80000)),
        ("Up to $80,000 a year", (80000, None, 80000)),
        ("$50,000.50 - $60,000 a year", (50000.5, 60000, 55000.25)),
        ("\n   $70,000 - $80,000 a year", (70000, 80000, 75000)),
        ("$1,000 a week", (1000, None, 1000)),
        ("$90K a year", (90, None, 90)),
        ("$80000 a year", (80000, None, 80000)),
        ("negotiable", (None, None, None)),
        ("", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_salary_amounts(spark, text, expected):
    assert _numbers(spark, text) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("$117,500 - $127,500 a year", (117500, 127500, 122500)),
        ("$80,000 a year", (80000, None, 80000)),
        ("Up to $80,000 a year", (None, 80000, 80000)),
        ("$50,000.50 - $60,000 a year", (5000050, 60000, 2530025)),
        ("\n   $70,000 - $80,000 a year", (None, 7000080000, 7000080000)),
        ("$1,000 a week", (1000, None, 1000)),
    ],
)
def test_salary_by_blanks(spark, text, expected):
    assert _numbers(spark, text, mode="reference") == expected


def test_thousands(spark):
    assert _numbers(spark, "$90K - $1.5k", thousands=True) == (90000, 1500, 45750)


def test_annual_and_sentinel(spark):
    rows = [("$1 a year",), ("$25 an hour",), ("$4,000 a month",), ("$9 an Hour",), ("None",), (None,)]
    df = spark.createDataFrame(rows, "Salary string")
    kept = {r.Salary for r in cleaning.annual_only(cleaning.drop_sentinel(df)).collect()}
    assert kept == {"$1 a year", "$9 an Hour"}
    answer = cleaning.check_all_match(df.limit(1), "Salary").first()
    assert answer.all_match


@pytest.mark.parametrize(
    "text, city, state, initials",
    [
        ("New York, NY 10001", "New York", " NY 10001", " NY"),
        ("Washington, DC", "Washington", " DC", " DC"),
        ("Remote", "Remote", None, None),
        ("A, B, C", "A", " B, C", " B,"),
        (None, None, None, None),
    ],
)
def test_places(spark, text, city, state, initials):
    df = spark.createDataFrame([(text,)], "Location string")
    row = places.state_initials(places.split_location(df)).first()
    assert (row.City, row.State, row["State Initials"]) == (city, state, initials)


def test_dedupe_is_idempotent(spark):
    rows = [("a", 1), ("a", 1), ("a", None), ("a", None), (None, None)]
    df = spark.createDataFrame(rows, "x string, y int")
    once = cleaning.dedupe_rows(df)
    assert once.count() == 3 == cleaning.dedupe_rows(once).count()
    assert cleaning.drop_nulls(once).collect() == [("a", 1)]
    summary = stats.quality_summary(df).first()
    assert tuple(summary) == (5, 2, 1)
    assert tuple(stats.quality_summary(df.limit(0)).first()) == (0, 2, 0)


def test_cast_to(spark):
    df = spark.createDataFrame([("20240102 03:04", "3.5", "x")], "a string, b string, c string")
    from pyspark.sql import types as T

    kinds = T.StructType(
        [T.StructField("c", T.IntegerType()), T.StructField("a", T.TimestampType()),
         T.StructField("b", T.DoubleType())]
    )
    assert tuple(cleaning.cast_to(df, kinds).first()) == (None, dt.datetime(2024, 1, 2, 3, 4), 3.5)


def test_search_request(spark):
    text = """{ "titles":"'data+scientist', 'product+manager'", "locations":"'New+York', 'Aus tin'"}"""
    df = spark.createDataFrame([(1, text), (2, "not json")], "id int, r string")
    rows = grid.parse_search_request(df, "r")
    first = rows.where("id = 1").first()
    assert first.titles == ["data+scientist", "product+manager"]
    assert first.locations == ["New+York", "Austin"]
    assert rows.where("id = 2").first().titles is None
    urls = [r.url for r in grid.search_grid(rows).collect()]
    assert len(urls) == 4
    assert "https://www.indeed.com/jobs?q=data+scientist+%2420%2C000&l=Austin&start=10&sort=date" in urls


def test_places_searched(spark):
    assert len(fixed_values.PLACES) == 75
    assert grid.default_places(spark).count() == 72
    paged = grid.paginate(spark.createDataFrame([("X",)], "place string"), "place", 100)
    assert [r.start for r in paged.collect()] == list(range(0, 100, 10))
    place = spark.createDataFrame([("X",)], "place string")
    for most in (25, 5, 0):
        assert [r.start for r in grid.paginate(place, "place", most).collect()] == list(range(0, most, 10))


def test_cross_grid_keeps_types_and_missing_terms(spark):
    left, right = spark.range(3), spark.createDataFrame([(1,), (2,), (2,), (None,)], "t int")
    made = grid.cross_grid(left, right, "t")
    assert made.schema["t"].dataType.simpleString() == "int"
    assert sorted((r.id, r.t or 0) for r in made.collect()) == [(i, t) for i in range(3) for t in (0, 1, 2)]


def test_money_with_cents(spark):
    texts = ["$1,250.50 or $3 or $ 20.5", "from $7.25 to $1234.00", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(salary.find_money("t", with_cents=True)).collect()] == [["$1,250.50"], ["$7.25", "$1234.00"], None]


def test_new_ids_and_join(spark):
    stamp = "2024-01-0{} 00:00"
    search = spark.createDataFrame(
        [("a", stamp.format(1), "old"), ("a", stamp.format(2), "new"), ("b", stamp.format(1), "b"),
         (None, stamp.format(1), "n")],
        "job_id string, search_datetime string, title string",
    ).where("job_id is not null")
    stored = spark.createDataFrame([("b",), ("z",)], "job_id string")
    assert [tuple(r) for r in joins.new_job_ids(search, stored).collect()] == [
        ("a", "2024-01-02 00:00", "new")
    ]
    details = spark.createDataFrame([("a", 1), ("a", 2), ("q", 3)], "job_id string, d int")
    plain = joins.join_details(search, details)
    salted = joins.join_details(search, details, salt=4)
    assert plain.count() == 4
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.collect()))


def test_fill_and_reshape(spark):
    df = spark.createDataFrame([(None, "t"), ("d", "t")], "desc string, title string")
    assert [r.desc for r in cleaning.fill_from(df, {"desc": "title"}).collect()] == ["t", "d"]
    shaped = cleaning.reshape_columns(df, drop=("title",), rename={"desc": "x"}, order=["x"])
    assert shaped.columns == ["x"]


def test_schema_order():
    assert schemas.JOB_DETAILS.names == [
        "job_id", "search_datetime", "location", "search_title", "search_location",
        "search_detail_datetime", "title", "job_desc", "company", "company_rating",
        "company_rating_count",
    ]


def test_sheet_cells(spark):
    from wagegrid.sources import writers

    df = spark.createDataFrame([(1, float("nan"), None), (2, 1.5, "x")], "a int, b double, c string")
    assert [tuple(r) for r in writers.as_sheet(df).collect()] == [("1", "", ""), ("2", "1.5", "x")]


def test_sample_is_stable(spark):
    from wagegrid.sources import readers

    df = spark.range(10_000)
    one = {r.id for r in readers.sample_rows(df, 0.1, key="id").collect()}
    two = {r.id for r in readers.sample_rows(df.repartition(7), 0.1, key="id").collect()}
    assert one == two and 850 < len(one) < 1150
    assert readers.sample_rows(df, 0.5).count() > 0


def test_minute_stamp(spark):
    row = spark.range(1).select(
        cleaning.minute_stamp(F.lit("2024-01-01 10:11:59").cast("timestamp")),
        cleaning.day_mark(F.lit("2024-01-01 10:11:59").cast("timestamp")),
    ).first()
    assert str(row[0]) == "2024-01-01 10:11:00" and row[1] == "20240101"
