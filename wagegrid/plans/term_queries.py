"""Words, pairs, counts and TF-IDF of the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from wagegrid import fixed_values
from wagegrid.functions import words
from wagegrid.operators import terms
from wagegrid.plans.registry import query, texts

STOP_LIST = ", ".join("'" + w.replace("'", "''") + "'" for w in fixed_values.ENGLISH_STOP_WORDS)
WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
KEPT = f"[w for w in {WORDS} if w NOT IN ({STOP_LIST})]"
PAIRS = "[kept[i] || ' ' || kept[i + 1] for i in range(1, len(kept))]"
KEPT_TERMS = f"(SELECT doc_id, unnest({KEPT}) AS term FROM documents)"
TOP_50 = f"""
SELECT term, COUNT(*) AS n, COUNT(DISTINCT doc_id) AS n_rows FROM {KEPT_TERMS}
GROUP BY term HAVING COUNT(DISTINCT doc_id) >= 2 ORDER BY n DESC, term LIMIT 50"""
COUNTS = f"SELECT doc_id, term, COUNT(*) AS n FROM {KEPT_TERMS} GROUP BY doc_id, term"


def kept_words(spark, folder):
    tokens = words.tokenize_words(texts(spark, folder, "documents", "doc_id", "text"))
    return words.remove_stop_words(tokens.drop("text"))


def _joined(df, column):
    return df.select("doc_id", F.array_join(column, " ").alias("words"))


@query(
    "tokenize",
    r"""SELECT doc_id, array_to_string(regexp_split_to_array(regexp_replace(lower(text), '\s+$', ''), '\s'), ' ')
        AS words FROM documents""",
)
def tokenize(spark, folder):
    return _joined(words.tokenize(texts(spark, folder, "documents", "doc_id", "text")), "words")


@query("tokenize_words", f"SELECT doc_id, array_to_string({WORDS}, ' ') AS words FROM documents")
def tokenize_words(spark, folder):
    return _joined(words.tokenize_words(texts(spark, folder, "documents", "doc_id", "text")), "words")


@query("remove_stop_words", f"SELECT doc_id, array_to_string({KEPT}, ' ') AS words FROM documents")
def remove_stop_words(spark, folder):
    return _joined(kept_words(spark, folder), "kept")


@query(
    "bigrams",
    f"SELECT doc_id, array_to_string({PAIRS}, '|') AS pairs FROM (SELECT doc_id, {KEPT} AS kept FROM documents)",
)
def bigrams(spark, folder):
    pairs = words.bigrams(kept_words(spark, folder))
    return pairs.select("doc_id", F.array_join("pairs", "|").alias("pairs"))


@query("top_terms", TOP_50)
def top_terms(spark, folder):
    return terms.top_terms(
        kept_words(spark, folder), "kept", fixed_values.SYNOPSIS_TERMS, min_rows=2, rows_too=True
    )


@query(
    "term_counts",
    f"SELECT c.doc_id, c.term, c.n FROM ({COUNTS}) c JOIN ({TOP_50}) t ON c.term = t.term",
)
def term_counts(spark, folder):
    return terms.term_counts(
        kept_words(spark, folder), "doc_id", "kept", size=fixed_values.SYNOPSIS_TERMS
    )


@query(
    "hash_term_counts",
    f"SELECT doc_id, CAST(('0x' || substr(md5(term), 1, 8))::BIGINT % 100 AS INTEGER) AS bucket, COUNT(*) AS n "
    f"FROM {KEPT_TERMS} GROUP BY 1, 2",
)
def hash_term_counts(spark, folder):
    return terms.bucket_counts(kept_words(spark, folder), "doc_id", "kept")


@query("top_terms_bounded", TOP_50)
def top_terms_bounded(spark, folder):
    """The same with summaries too small for the vocabulary: candidates are counted again."""
    return terms.top_terms(
        kept_words(spark, folder), "kept", fixed_values.SYNOPSIS_TERMS, min_rows=2, rows_too=True, capacity=400
    )


_BLANKS = r"regexp_split_to_array(regexp_replace(lower(text), '\s+$', ''), '\s')"
_SPARK_TERMS = f"(SELECT doc_id, unnest([w for w in {_BLANKS} if w NOT IN ({STOP_LIST})]) AS term FROM documents)"


@query(
    "tfidf",
    f"""
WITH used AS (SELECT doc_id, term, COUNT(*) AS n FROM {_SPARK_TERMS} GROUP BY doc_id, term),
top AS (SELECT term, SUM(n) AS total, COUNT(*) AS n_rows FROM used GROUP BY term
        HAVING COUNT(*) >= 2 ORDER BY total DESC, term LIMIT 3)
SELECT u.doc_id, u.term, u.n,
  round(u.n * ln(((SELECT COUNT(*) FROM documents) + 1) / (t.n_rows + 1)), 6) AS weight
FROM used u JOIN top t ON u.term = t.term""",
)
def tfidf(spark, folder):
    tokens = words.tokenize(texts(spark, folder, "documents", "doc_id", "text"))
    kept = words.remove_stop_words(tokens.drop("text"))
    weighed = terms.tfidf(kept, "doc_id", "kept")
    return weighed.withColumn("weight", F.round("weight", 6))


@query(
    "binary_terms",
    f"SELECT c.doc_id, c.term, CAST(1 AS BIGINT) AS n FROM ({COUNTS}) c JOIN ({TOP_50}) t ON c.term = t.term",
)
def binary_terms(spark, folder):
    return terms.term_counts(
        kept_words(spark, folder), "doc_id", "kept",
        size=fixed_values.SYNOPSIS_TERMS, binary=True,
    )
