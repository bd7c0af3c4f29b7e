"""Posting-shaped rows derived from the given tables, in Spark and in SQL.

The tables hold no postings.  Every order becomes a listing whose salary text
shows all the forms found in practice, and every customer a search request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagegrid.operators import features
from wagegrid.plans.registry import table, texts


def _dollars(value: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(F.floor(value), 0))


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """job_id, Title, Location, Company, Salary of every order."""
    orders = table(spark, folder, "orders")
    low, high = _dollars(F.col("o_totalprice")), _dollars(F.col("o_totalprice") + 12500)
    status, rank = F.col("o_orderstatus"), F.col("o_orderpriority")
    salary = (
        F.when(rank == "1-URGENT", F.concat(low, F.lit(" - "), high, F.lit(" a year")))
        .when(rank == "2-HIGH", F.concat(low, F.lit(" a year")))
        .when((rank == "3-MEDIUM") & (status == "F"), F.concat(F.lit("Up to "), low, F.lit(" a year")))
        .when((rank == "3-MEDIUM") & (status == "O"),
              F.concat(low, F.lit(".50 - "), high, F.lit(" a year")))
        .when(rank == "3-MEDIUM", F.concat(F.lit("\n   "), low, F.lit(" - "), high, F.lit(" a year")))
        .when((rank == "4-NOT SPECIFIED") & (status == "F"), F.lit("$25 an hour"))
        .when((rank == "4-NOT SPECIFIED") & (status == "O"), F.concat(low, F.lit(" a month")))
        .when(rank == "4-NOT SPECIFIED", F.concat(low, F.lit(" a week")))
        .when(status == "F", F.lit("None"))
        .when(status == "P", F.lit("$90K a year"))
    )
    mark = F.upper(F.substring("o_orderpriority", 3, 2))
    city = F.concat(F.lit("City "), F.col("o_custkey").cast("string"))
    location = (
        F.when(status == "F", F.concat(city, F.lit(", "), mark, F.lit(" 10001")))
        .when(status == "O", F.concat(city, F.lit(", "), mark, F.lit(", USA")))
        .when(rank != "5-LOW", F.lit("Remote"))
    )
    return orders.select(
        F.col("o_orderkey").alias("job_id"),
        F.col("o_orderpriority").alias("Title"),
        location.alias("Location"),
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("Company"),
        salary.alias("Salary"),
    )


LISTINGS = """(
SELECT job_id, "Title",
  CASE WHEN st = 'F' THEN city || ', ' || mark || ' 10001'
       WHEN st = 'O' THEN city || ', ' || mark || ', USA'
       WHEN "Title" <> '5-LOW' THEN 'Remote' END AS "Location",
  company AS "Company",
  CASE WHEN "Title" = '1-URGENT' THEN low || ' - ' || high || ' a year'
       WHEN "Title" = '2-HIGH' THEN low || ' a year'
       WHEN "Title" = '3-MEDIUM' AND st = 'F' THEN 'Up to ' || low || ' a year'
       WHEN "Title" = '3-MEDIUM' AND st = 'O' THEN low || '.50 - ' || high || ' a year'
       WHEN "Title" = '3-MEDIUM' THEN chr(10) || '   ' || low || ' - ' || high || ' a year'
       WHEN "Title" = '4-NOT SPECIFIED' AND st = 'F' THEN '$25 an hour'
       WHEN "Title" = '4-NOT SPECIFIED' AND st = 'O' THEN low || ' a month'
       WHEN "Title" = '4-NOT SPECIFIED' THEN low || ' a week'
       WHEN st = 'F' THEN 'None'
       WHEN st = 'P' THEN '$90K a year' END AS "Salary"
FROM (SELECT o_orderkey AS job_id, o_orderpriority AS "Title", o_orderstatus AS st,
        'City ' || o_custkey AS city, 'Customer ' || o_custkey AS company,
        upper(substr(o_orderpriority, 3, 2)) AS mark,
        '$' || format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS low,
        '$' || format('{:,}', CAST(floor(o_totalprice + 12500) AS BIGINT)) AS high
      FROM orders))"""

_AMOUNTS = r"""regexp_extract_all("Salary", '\$\s*([0-9][0-9,]*(?:\.[0-9]+)?)', 1)"""

#: Listings with Low, High, Average by the amounts behind dollar signs.
SALARIES = f"""(
SELECT *, CASE WHEN "Low" IS NULL THEN "High" WHEN "High" IS NULL THEN "Low"
               ELSE ("Low" + "High") / 2 END AS "Average"
FROM (SELECT *, TRY_CAST(replace({_AMOUNTS}[1], ',', '') AS DOUBLE) AS "Low",
                TRY_CAST(replace({_AMOUNTS}[2], ',', '') AS DOUBLE) AS "High"
      FROM {LISTINGS}))"""

#: The same by blanking out what is no digit and cutting at three blanks.
SALARIES_BY_BLANKS = f"""(
SELECT *, CASE WHEN "Low" IS NULL THEN "High" WHEN "High" IS NULL THEN "Low"
               ELSE ("Low" + "High") / 2 END AS "Average"
FROM (SELECT * EXCLUDE (s),
        TRY_CAST(replace(CASE WHEN strpos(s, ',,,') > 0 THEN substr(s, 1, strpos(s, ',,,') - 1)
                              ELSE s END, ',', '') AS DOUBLE) AS "Low",
        TRY_CAST(replace(CASE WHEN strpos(s, ',,,') > 0 THEN substr(s, strpos(s, ',,,') + 3) END,
                         ',', '') AS DOUBLE) AS "High"
      FROM (SELECT *, regexp_replace(replace("Salary", '$', ''), '[^0-9]', ',', 'g') AS s
            FROM {LISTINGS})))"""


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """A JSON search request per customer."""
    customer = table(spark, folder, "customer")
    return customer.select(
        "c_custkey",
        F.concat(
            F.lit('{"titles": "\''), F.lower("c_mktsegment"),
            F.lit("+analyst', 'data scientist'\", \"locations\": \"'NATION_"),
            F.col("c_nationkey").cast("string"), F.lit("', 'New+York', 'Austin'\"}"),
        ).alias("request"),
    )


_TERMS = "string_split(replace(replace(json_extract_string(request, '$.{}'), '''', ''), ' ', ''), ',')"

REQUESTS = f"""(
SELECT c_custkey, {_TERMS.format('titles')} AS titles, {_TERMS.format('locations')} AS locations
FROM (SELECT c_custkey, '{{"titles": "''' || lower(c_mktsegment)
        || '+analyst'', ''data scientist''", "locations": "''NATION_' || c_nationkey
        || ''', ''New+York'', ''Austin''"}}' AS request
      FROM customer))"""


def _postings(spark: SparkSession, folder: str) -> DataFrame:
    """Documents named like postings; their length stands in for the salary."""
    return texts(spark, folder, "documents", "doc_id", "text", "source", "lang", "n_chars").select(
        "doc_id", F.col("text").alias("Title"), F.col("text").alias("Synopsis"),
        F.col("source").alias("City"), F.col("lang").alias("State Initials"), "n_chars",
    )


def labelled_postings(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that have a quality label, with whether they are longer than the median of
    them: a class that counts of words can tell.
    """
    chosen = table(spark, folder, "labels").select("doc_id")
    found = _postings(spark, folder).join(chosen, "doc_id", "inner")
    return features.above_median(found, "n_chars", name="label").drop("n_chars")


#: The same in SQL: doc_id, label and the columns of the documents.
LABELLED = """(
SELECT d.*, CASE WHEN n_chars > median(n_chars) OVER () THEN 1 ELSE 0 END AS label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def unlabelled_postings(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without a label."""
    labelled = table(spark, folder, "labels").select("doc_id")
    return _postings(spark, folder).join(labelled, "doc_id", "left_anti").drop("n_chars")
