"""Counts, medians, summaries, tops and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.functions.salary import mean_present
from wagegrid.operators import quantiles, stats
from wagegrid.plans.registry import query, table


@query("count_rows", "SELECT COUNT(*) AS total_rows FROM lineitem")
def count_rows(spark, folder):
    return stats.count_rows(table(spark, folder, "lineitem"))


@query("median_value", "SELECT round(median(o_totalprice), 6) AS median FROM orders")
def median_value(spark, folder):
    found = quantiles.median_value(table(spark, folder, "orders"), "o_totalprice")
    return found.select(F.round("median", 6).alias("median"))


@query(
    "quantile_value",
    "SELECT round(quantile_cont(l_extendedprice, 0.75), 6) AS upper FROM lineitem",
)
def quantile_value(spark, folder):
    found = quantiles.quantile_value(
        table(spark, folder, "lineitem"), "l_extendedprice", 0.75, name="upper"
    )
    return found.select(F.round("upper", 6).alias("upper"))


def _within(found, rows, group):
    """``group``, n and whether the rank of the estimate is as near to the middle as is stated."""
    joined = rows.join(settings.small_side(found.select(F.col(group).alias("_group"), "n", "median")), F.col(group) == F.col("_group"))
    ranks = joined.groupBy(group, "n").agg(
        F.count_if(F.col("value") < F.col("median")).alias("less"), F.count_if(F.col("value") <= F.col("median")).alias("upto"),
    )
    off = quantiles.SKETCH_ERROR * F.col("n") + 1
    near = (F.col("less") - off <= F.col("n") / 2) & (F.col("upto") + off >= F.col("n") / 2)
    return ranks.select(group, "n", near.alias("near"))


def _daily_sketches(spark, folder):
    """Sketches of the values of each day, stored by day as a nightly job would."""
    events = table(spark, folder, "events").select(F.to_date("ts").cast("string").alias("day"), "value")
    path = settings.new_folder(spark, "sketches")
    quantiles.quantile_sketches(events, "value", ["day"]).write.partitionBy("day").parquet(path)
    return events, spark.read.schema("sketch binary, day string").parquet(path)


@query(
    "median_by_day",
    "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, COUNT(value) AS n, true AS near FROM events GROUP BY 1 HAVING COUNT(value) > 0",
)
def median_by_day(spark, folder):
    events, stored = _daily_sketches(spark, folder)
    return _within(quantiles.sketch_quantile(stored, name="median"), events, "day")


@query(
    "median_by_month",
    "SELECT strftime(ts, '%Y-%m') AS month, COUNT(value) AS n, true AS near FROM events GROUP BY 1 HAVING COUNT(value) > 0",
)
def median_by_month(spark, folder):
    """From the sketches of the days, without a second look at the values."""
    events, stored = _daily_sketches(spark, folder)
    month = F.substring("day", 1, 7).alias("month")
    merged = quantiles.merged_sketches(stored.withColumn("month", month), ["month"])
    return _within(quantiles.sketch_quantile(merged, name="median"), events.withColumn("month", month), "month")


@query("value_counts", "SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1")
def value_counts(spark, folder):
    return stats.value_counts(table(spark, folder, "orders"), "o_orderpriority")


@query(
    "baseline_accuracy",
    "SELECT round(max(n) / sum(n), 9) AS baseline FROM (SELECT quality, COUNT(*) AS n FROM labels GROUP BY 1)",
)
def baseline_accuracy(spark, folder):
    found = stats.baseline_accuracy(table(spark, folder, "labels"), "quality")
    return found.select(F.round("baseline", 9).alias("baseline"))


@query(
    "mean_of_columns",
    """
SELECT o_orderkey, round(CASE WHEN low IS NULL THEN high WHEN high IS NULL THEN low ELSE (low + high) / 2 END, 4) AS average
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS low,
             CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice * 2 END AS high FROM orders)""",
)
def mean_of_columns(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("low"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice") * 2).alias("high"),
    )
    return rows.select("o_orderkey", F.round(mean_present("low", "high"), 4).alias("average"))


@query(
    "quality_summary",
    """
WITH r AS (SELECT d.text, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT (SELECT COUNT(*) FROM r) AS n_rows, CAST(3 AS BIGINT) AS n_columns,
  (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM r)
   WHERE text IS NOT NULL AND lang IS NOT NULL AND quality IS NOT NULL) AS n_good""",
)
def quality_summary(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return stats.quality_summary(documents.join(labels, "doc_id", "left").drop("doc_id"))


@query(
    "fold_summary",
    "SELECT l_returnflag, round(avg(l_discount), 6) AS mean_score, "
    "round(stddev_pop(l_discount), 6) AS sd_score FROM lineitem GROUP BY 1",
)
def fold_summary(spark, folder):
    return stats.fold_summary(
        table(spark, folder, "lineitem"), "l_discount", by=("l_returnflag",), digits=6
    )


@query(
    "top_importance",
    "SELECT p_partkey, p_name AS name, p_retailprice AS importance FROM part "
    "ORDER BY p_retailprice DESC, p_name, p_partkey LIMIT 20",
)
def top_importance(spark, folder):
    rows = table(spark, folder, "part").select(
        "p_partkey", F.col("p_name").alias("name"), F.col("p_retailprice").alias("importance")
    )
    return stats.top_importance(rows)


@query(
    "head_tail",
    "SELECT 'head' AS part, * FROM (SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5) "
    "UNION ALL SELECT 'tail' AS part, * FROM "
    "(SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 5)",
)
def head_tail(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    first = stats.head(rows, 5, ["o_orderkey"]).select(F.lit("head").alias("part"), "*")
    last = stats.tail(rows, 5, ["o_orderkey"]).select(F.lit("tail").alias("part"), "*")
    return stats.append_all([first, last])


@query(
    "append_all",
    "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier UNION ALL "
    "SELECT c_custkey, c_name, c_acctbal FROM customer",
)
def append_all(spark, folder):
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_name").alias("name"), F.col("c_custkey").alias("id"),
        F.col("c_acctbal").alias("balance"),
    )
    return stats.append_all([suppliers, customers])


@query("set_of", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def set_of(spark, folder):
    return stats.set_of(table(spark, folder, "customer"), "c_nationkey", "c_mktsegment")
