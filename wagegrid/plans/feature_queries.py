"""Labels, flags, place columns and assembled vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.functions import salary
from wagegrid.operators import cleaning, features, positions, stats
from wagegrid.plans import standins
from wagegrid.plans.registry import query, table
from wagegrid.plans.standins import SALARIES
from wagegrid.plans.term_queries import KEPT, PAIRS


@query(
    "one_hot",
    "SELECT c_custkey, c_mktsegment, "
    + ", ".join(
        f"""CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS "{s}\""""
        for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    )
    + " FROM customer",
)
def one_hot(spark, folder):
    return features.one_hot(
        table(spark, folder, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment"
    )


@query(
    "title_flags",
    "SELECT p_partkey, title, "
    + ", ".join(
        f"""CASE WHEN contains(title, '{w}') THEN 1 ELSE 0 END AS "{w}\"""" for w in
        ["SMALL", "ring", "in", "STANDARD", "large bolt"]
    )
    + " FROM (SELECT p_partkey, p_type || ' ' || p_name AS title FROM part)",
)
def title_flags(spark, folder):
    titles = table(spark, folder, "part").select(
        "p_partkey", F.concat_ws(" ", "p_type", "p_name").alias("title")
    )
    return features.title_flags(titles, "title", ["SMALL", "ring", "in", "STANDARD", "large bolt"])


@query(
    "flagged_rows",
    "SELECT p_partkey, p_name, 1 AS ring FROM part WHERE contains(p_name, 'ring')",
)
def flagged_rows(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return features.flagged_rows(features.title_flags(parts, "p_name", ["ring"]), "ring")


@query(
    "above_median",
    """SELECT o_orderkey, CASE WHEN o_totalprice > (SELECT median(o_totalprice) FROM orders)
       THEN 1 ELSE 0 END AS "Above Median" FROM orders""",
)
def above_median(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return features.above_median(rows, "o_totalprice").drop("o_totalprice")


_ANNUAL = f"""
WITH s AS (SELECT * FROM {SALARIES} WHERE "Salary" <> 'None'
           AND NOT contains("Salary", 'hour') AND NOT contains("Salary", 'month'))"""


def labelled_salaries(spark: SparkSession, folder: str) -> DataFrame:
    """Listings to labelled salaries: clean, parse, compare with the median.

    The clean listings are written: the median then reads one column of numbers
    and the texts are parsed once.
    """
    listed = cleaning.annual_only(cleaning.drop_sentinel(standins.listings(spark, folder)))
    clean = settings.written(salary.parse_salary(listed), "clean")
    return features.above_median(clean, "Average")


@query(
    "salary_study",
    _ANNUAL
    + """ SELECT "Above Median", COUNT(*) AS n FROM (
  SELECT CASE WHEN "Average" > (SELECT median("Average") FROM s) THEN 1 ELSE 0 END AS "Above Median" FROM s)
GROUP BY 1""",
)
def salary_study(spark, folder):
    return stats.value_counts(labelled_salaries(spark, folder), "Above Median")


_POSTED = "(SELECT d.doc_id, d.text, d.source, d.lang FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"


@query(
    "assemble",
    f"""
WITH d AS (SELECT doc_id, source, lang, kept, {PAIRS} AS pairs
           FROM (SELECT doc_id, source, lang, {KEPT} AS kept FROM {_POSTED})),
pair AS (SELECT doc_id, term, COUNT(*) AS n FROM (SELECT doc_id, unnest(pairs) AS term FROM d) GROUP BY 1, 2),
word AS (SELECT doc_id, term, COUNT(*) AS n FROM (SELECT doc_id, unnest(kept) AS term FROM d) GROUP BY 1, 2),
top_pair AS (SELECT term FROM pair GROUP BY term ORDER BY SUM(n) DESC, term LIMIT 30),
top_word AS (SELECT term FROM word GROUP BY term ORDER BY SUM(n) DESC, term LIMIT 50)
SELECT doc_id, 'city=' || source AS feature, 1.0::DOUBLE AS value FROM d
UNION ALL SELECT doc_id, 'state=' || lang, 1.0::DOUBLE FROM d
UNION ALL SELECT doc_id, 'title_terms=' || p.term, n::DOUBLE FROM pair p JOIN top_pair t ON p.term = t.term
UNION ALL SELECT doc_id, 'synopsis_terms=' || w.term, n::DOUBLE FROM word w JOIN top_word t ON w.term = t.term""",
)
def assemble(spark, folder):
    rows = settings.spread(
        settings.written(standins.labelled_postings(spark, folder), "postings")
    )
    model = features.assemble(rows, "synopses")
    return features.named_features(model.transform(rows), model, "doc_id")


@query(
    "stratified_folds",
    "SELECT doc_id, quality, CAST(ntile(6) OVER (PARTITION BY quality ORDER BY doc_id) - 1 AS INTEGER) AS fold FROM labels",
)
def stratified_folds(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return positions.stratified_folds(labels, "quality", "doc_id", 6)
