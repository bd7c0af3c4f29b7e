"""Term statistics over rows of words."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagegrid import fixed_values, settings
from wagegrid.operators import frequent


#: Up to this many terms of a vocabulary become part of the plan.
LISTED_TERMS = 10_000


def term_totals(df: DataFrame, words: str = "words", rows_too: bool = True) -> DataFrame:
    """``term``, ``n`` (all uses) and, with ``rows_too``, ``n_rows`` (rows that use it).

    Uses are combined in each task, so a shuffle carries one line per term and
    task, also for terms that are everywhere.  Rows with a term are counted
    from the distinct words of each row in the same pass, without bringing
    (row, term) pairs together.
    """
    if not rows_too:
        used = settings.unfolded(df.select(words), words, "term")
        return used.groupBy("term").agg(F.count("*").alias("n"))
    both = df.select(
        F.posexplode(F.array(words, F.array_distinct(words))).alias("distinct", "listed")
    )
    used = both.select("distinct", F.explode("listed").alias("term")).where(F.col("term").isNotNull())
    return used.groupBy("term").agg(
        F.count_if(F.col("distinct") == 0).alias("n"),
        F.count_if(F.col("distinct") == 1).alias("n_rows"),
    )


def top_terms(
    df: DataFrame, words: str = "words", n: int = fixed_values.TITLE_TERMS, min_rows: int = 1,
    rows_too: bool = False, capacity: int = frequent.CAPACITY,
) -> DataFrame:
    """The ``n`` most frequent terms used by at least ``min_rows`` rows; ties by term.

    ``term`` and ``n``, with ``rows_too`` also ``n_rows``.  One pass over summaries of at most
    ``capacity`` terms per task serves vocabularies of any size (``frequent``).
    """

    def totals(rows: DataFrame, listed: list[str] | None) -> DataFrame:
        if listed is not None:
            rows = rows.select(F.filter(words, lambda w: w.isin(listed)).alias(words))
        return term_totals(rows, words)

    found = frequent.most_frequent(df, words, n, min_rows, totals, capacity)
    return found if rows_too else found.select("term", "n")


def _row_counts(df: DataFrame, words: str, listed: list[str]) -> DataFrame:
    """``df`` with ``term`` and ``n``: a row's listed words are sorted, equal ones then stand
    side by side.  All of it happens inside the row.
    """
    kept = df.withColumn("_kept", F.array_sort(F.filter(words, lambda w: w.isin(listed))))
    place = F.when(F.size("_kept") > 0, F.sequence(F.lit(0), F.size("_kept") - 1))
    first = lambda i: (i == 0) | (F.get("_kept", i) != F.get("_kept", i - 1))
    kept = kept.withColumn("_starts", F.filter(place, first))
    end = lambda i: F.coalesce(F.get("_starts", i + 1), F.size("_kept"))
    counts = F.transform("_starts", lambda s, i: F.struct(F.get("_kept", s).alias("term"), (end(i) - s).cast("long").alias("n")))
    used = settings.unfolded(kept.withColumn("_counts", counts).drop("_kept", "_starts", words), "_counts", "_used")
    return used.select(*[c for c in df.columns if c != words], "_used.term", "_used.n")


def _counts_of(
    df: DataFrame, id_column: str, words: str, vocabulary: DataFrame, size: int
) -> DataFrame:
    """Counts of a vocabulary of at most ``size`` terms, per row (rows that share an id add up
    where the reader sums them).

    Up to ``LISTED_TERMS`` terms are part of the plan and counted inside each row, without a
    shuffle.  A larger vocabulary is joined: other words are dropped where they are read, and
    at most ``size`` lines per row are shuffled.
    """
    extra = [c for c in vocabulary.columns if c != "term"]
    rows = df.select(id_column, words)
    if size <= LISTED_TERMS:
        found = vocabulary.collect()
        counted = _row_counts(rows, words, [r.term for r in found])
        if not extra:
            return counted
        local = df.sparkSession.createDataFrame(found, vocabulary.schema)
        return counted.join(F.broadcast(local), "term")
    if size <= settings.BROADCAST_ROWS:
        vocabulary = F.broadcast(vocabulary)
    # rows are told apart by a number, as equal ids may occur in several
    used = settings.unfolded(rows.withColumn("_row", F.monotonically_increasing_id()), words, "term").drop(words)
    used = used.join(vocabulary, "term")
    return used.groupBy("_row", id_column, "term", *extra).agg(F.count("*").alias("n")).drop("_row")


def term_counts(
    df: DataFrame, id_column: str, words: str = "words", *,
    size: int = fixed_values.TFIDF_VOCABULARY, min_rows: int = fixed_values.TFIDF_MIN_ROWS,
    binary: bool = False,
) -> DataFrame:
    """Counts of the ``size`` top terms per row: ``id_column``, ``term``, ``n``.

    ``binary`` keeps presence (1) in place of the count.
    """
    vocabulary = top_terms(df, words, size, min_rows).select("term")
    counted = _counts_of(df, id_column, words, vocabulary, size)
    n = F.lit(1).cast("long") if binary else F.col("n")
    return counted.select(id_column, "term", n.alias("n"))


def tfidf(
    df: DataFrame, id_column: str, words: str = "words", *,
    size: int = fixed_values.TFIDF_VOCABULARY, min_rows: int = fixed_values.TFIDF_MIN_ROWS,
) -> DataFrame:
    """``n * ln((rows + 1) / (rows with term + 1))`` of the ``size`` top terms per row."""
    rows = df.agg(F.count("*").alias("m")).scalar()
    weights = top_terms(df, words, size, min_rows, rows_too=True).select(
        "term", F.log((rows + 1) / (F.col("n_rows") + 1)).alias("idf")
    )
    counted = _counts_of(df, id_column, words, weights, size)
    return counted.select(
        id_column, "term", "n", (F.col("n") * F.col("idf")).alias("weight")
    )


def hash_term_counts(
    df: DataFrame, words: str = "words", out: str = "counts",
    buckets: int = fixed_values.HASH_BUCKETS,
) -> DataFrame:
    """Counts of hashed terms as a sparse vector of ``buckets`` places."""
    return HashingTF(inputCol=words, outputCol=out, numFeatures=buckets).transform(df)


def bucket_of(term: Column, buckets: int = fixed_values.HASH_BUCKETS) -> Column:
    """A term's bucket: the first 32 bits of its MD5, modulo ``buckets``; the same in any engine."""
    return (F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def bucket_counts(
    df: DataFrame, id_column: str, words: str = "words", buckets: int = fixed_values.HASH_BUCKETS
) -> DataFrame:
    """``id_column``, ``bucket``, ``n``: uses of hashed terms, counted inside each row.

    No vocabulary is needed and nothing is shuffled.
    """
    numbered = df.select(id_column, F.transform(F.filter(words, lambda w: w.isNotNull()), lambda w: bucket_of(w, buckets)).alias(words))
    counted = _row_counts(numbered, words, list(range(buckets)))
    return counted.withColumnRenamed("term", "bucket")
