"""Filters, projections, salary and place parsing, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from wagegrid.functions import places, salary
from wagegrid.operators import cleaning, joins, positions
from wagegrid.plans import standins
from wagegrid.plans.registry import query, table
from wagegrid.plans.standins import LISTINGS, SALARIES, SALARIES_BY_BLANKS


@query("drop_sentinel", f"""SELECT job_id, "Salary" FROM {LISTINGS} WHERE "Salary" <> 'None'""")
def drop_sentinel(spark, folder):
    rows = standins.listings(spark, folder).select("job_id", "Salary")
    return cleaning.drop_sentinel(rows)


@query("dedupe_rows", "SELECT DISTINCT text, lang FROM documents")
def dedupe_rows(spark, folder):
    return cleaning.dedupe_rows(table(spark, folder, "documents").select("text", "lang"))


@query(
    "drop_nulls",
    "SELECT d.doc_id, d.source, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id "
    "WHERE d.source IS NOT NULL AND l.quality IS NOT NULL",
)
def drop_nulls(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "source")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return cleaning.drop_nulls(documents.join(labels, "doc_id", "left"))


@query(
    "annual_only",
    f"""SELECT * FROM {LISTINGS} WHERE NOT contains("Salary", 'hour') AND NOT contains("Salary", 'month')""",
)
def annual_only(spark, folder):
    return cleaning.annual_only(standins.listings(spark, folder))


@query("parse_salary", f"""SELECT job_id, "Low", "High", "Average" FROM {SALARIES}""")
def parse_salary(spark, folder):
    return salary.parse_salary(standins.listings(spark, folder).select("job_id", "Salary"))


@query(
    "parse_salary_by_blanks",
    f"""SELECT job_id, "Low", "High", "Average" FROM {SALARIES_BY_BLANKS}""",
)
def parse_salary_by_blanks(spark, folder):
    rows = standins.listings(spark, folder).select("job_id", "Salary")
    return salary.parse_salary(rows, mode="reference")


_CITY = """CASE WHEN strpos("Location", ',') > 0 THEN substr("Location", 1, strpos("Location", ',') - 1) ELSE "Location" END"""
_STATE = """CASE WHEN strpos("Location", ',') > 0 THEN substr("Location", strpos("Location", ',') + 1) END"""


@query(
    "split_location",
    f"""SELECT job_id, "Location", {_CITY} AS "City", {_STATE} AS "State" FROM {LISTINGS}""",
)
def split_location(spark, folder):
    return places.split_location(standins.listings(spark, folder).select("job_id", "Location"))


@query(
    "state_initials",
    f"""SELECT job_id, substr({_STATE}, 1, 3) AS "State Initials" FROM {LISTINGS}""",
)
def state_initials(spark, folder):
    rows = split_location(spark, folder)
    return places.state_initials(rows).select("job_id", "State Initials")


@query(
    "fill_from",
    "SELECT o_orderkey, COALESCE(CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END, c_name) AS title "
    "FROM orders JOIN customer ON o_custkey = c_custkey",
)
def fill_from(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("title"),
    )
    names = table(spark, folder, "customer").select("c_custkey", "c_name")
    joined = orders.join(names, "c_custkey")
    return cleaning.fill_from(joined, {"title": "c_name"}).drop("c_custkey")


@query(
    "reshape_columns",
    "SELECT o_orderpriority AS title, o_orderkey AS job_id, o_orderdate, o_totalprice AS average FROM orders",
)
def reshape_columns(spark, folder):
    return cleaning.reshape_columns(
        table(spark, folder, "orders"), drop=("o_orderstatus", "o_custkey"),
        rename={"o_orderpriority": "title", "o_orderkey": "job_id", "o_totalprice": "average"},
        order=["title", "job_id", "o_orderdate", "average"],
    )


@query(
    "cast_columns",
    "SELECT CAST(o_orderkey AS INTEGER) AS id, o_totalprice AS rating, "
    "strftime(o_orderdate, '%Y-%m-%d %H:%M:00') AS stamp FROM orders",
)
def cast_columns(spark, folder):
    texts = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_totalprice").cast("string").alias("rating"),
        F.date_format("o_orderdate", "yyyyMMdd HH:mm").alias("stamp"),
    )
    from pyspark.sql import types as T

    kinds = T.StructType(
        [
            T.StructField("id", T.IntegerType()),
            T.StructField("rating", T.DoubleType()),
            T.StructField("stamp", T.TimestampType()),
        ]
    )
    typed = cleaning.cast_to(texts, kinds)
    return typed.withColumn("stamp", F.date_format("stamp", "yyyy-MM-dd HH:mm:ss"))


@query(
    "minute_stamp",
    "SELECT event_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS minute, "
    "strftime(ts, '%Y%m%d') AS day FROM events",
)
def minute_stamp(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        F.date_format(cleaning.minute_stamp("ts"), "yyyy-MM-dd HH:mm:ss").alias("minute"),
        cleaning.day_mark("ts").alias("day"),
    )


@query(
    "trim_text",
    r"SELECT doc_id, replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), chr(10), '') AS text FROM documents",
)
def trim_text(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", cleaning.trim_text("text").alias("text")
    )


@query(
    "row_numbers",
    "SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders",
)
def row_numbers(spark, folder):
    return positions.row_numbers(
        table(spark, folder, "orders").select("o_orderkey", "o_custkey"), "o_orderkey"
    )


@query(
    "rows_between",
    "SELECT o_orderkey, o_custkey, position FROM (SELECT o_orderkey, o_custkey, "
    "row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders) WHERE position BETWEEN 50 AND 59",
)
def rows_between(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return positions.rows_between(orders, "o_orderkey", 50, 60)


@query(
    "scalar_if",
    "SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS high FROM orders",
)
def scalar_if(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", cleaning.scalar_if(F.col("o_totalprice") > 250000).alias("high")
    )


@query(
    "check_all_match",
    f"""SELECT COUNT(*) AS n_rows,
  COUNT(*) FILTER (WHERE NOT COALESCE(contains("Salary", 'year'), false)) AS n_without,
  COUNT(*) FILTER (WHERE NOT COALESCE(contains("Salary", 'year'), false)) = 0 AS all_match
FROM {LISTINGS} WHERE NOT contains("Salary", 'hour') AND NOT contains("Salary", 'month')""",
)
def check_all_match(spark, folder):
    return cleaning.check_all_match(annual_only(spark, folder), "Salary")


@query(
    "join_details",
    "SELECT o_orderkey AS job_id, o_orderdate, l_linenumber, l_extendedprice "
    "FROM orders JOIN lineitem ON o_orderkey = l_orderkey",
)
def join_details(spark, folder):
    search = table(spark, folder, "orders").select(F.col("o_orderkey").alias("job_id"), "o_orderdate")
    details = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("job_id"), "l_linenumber", "l_extendedprice"
    )
    return joins.join_details(search, details)


@query(
    "align_columns",
    "SELECT p_partkey, CASE WHEN contains(p_type, 'SMALL') THEN 1 ELSE 0 END AS small, "
    "p_size, CASE WHEN contains(p_name, 'ring') THEN 1 ELSE 0 END AS ring FROM part",
)
def align_columns(spark, folder):
    part = table(spark, folder, "part")
    blocks = [
        part.select("p_partkey", cleaning.scalar_if(F.col("p_type").contains("SMALL")).alias("small")),
        part.select("p_partkey", "p_size"),
        part.select("p_partkey", cleaning.scalar_if(F.col("p_name").contains("ring")).alias("ring")),
    ]
    return joins.align_columns(blocks, "p_partkey")


@query(
    "new_job_ids",
    """
SELECT job_id, search_datetime, event_id, title FROM (
  SELECT user_id AS job_id, ts AS search_datetime, event_id, event_type AS title,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
  FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0))
WHERE r = 1""",
)
def new_job_ids(spark, folder):
    search = table(spark, folder, "events").select(
        F.col("user_id").alias("job_id"), F.col("ts").alias("search_datetime"),
        "event_id", F.col("event_type").alias("title"),
    )
    stored = table(spark, folder, "customer").where("c_acctbal < 0").select(
        F.col("c_custkey").alias("job_id")
    )
    return joins.new_job_ids(search, stored, ties=("event_id",))
