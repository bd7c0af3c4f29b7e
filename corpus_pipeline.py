"""A training corpus from raw documents: language, lines, near copies, mixture, tokens.

Each stage takes (spark, docs, sf_dir) with the columns of ``documents`` and works on all
its predecessor kept; all but the last return these columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.llm import language, line_dedup, mixing, near_text
from wagegrid.llm.queries import tokenizer

#: Documents farther than this from every language profile are rejected: clean prose of
#: the given tables stays above 0.36, text without any known order of letters near 0.
LEAST_LANGUAGE_SCORE = 0.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters and texts unlike any language; ``lang`` becomes the one found.

    Profiles come from the documents that name their language.  If none does, all stay.
    """
    profiles = settings.written(language.learn_profiles(docs), "profiles")
    if profiles.isEmpty():
        return docs
    found = language.with_language(docs, profiles, lang_col="#lang", score_col="#score")
    kept = found.where((F.col("#lang") != "und") & (F.col("#score") >= LEAST_LANGUAGE_SCORE))
    return kept.withColumn("lang", F.col("#lang")).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one occurrence of each line; documents that lost all their words go too."""
    found = line_dedup.without_repeats(docs)
    found = found.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    cut = F.when(F.col("n_dropped") > 0, length).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", cut).select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group that shares 0.8 of its five-word runs.

    Of rows with equal id and text one stays; rows with a null id all stay.
    """
    kept = near_text.near_duplicates(docs, shingle=5, percent=80).where("kept AND doc_id IS NOT NULL")
    named = docs.join(kept.select("doc_id").distinct(), "doc_id", "left_semi").select(*docs.columns)
    again = Window.partitionBy("doc_id", F.sha2(F.col("text").cast("binary"), 256)).orderBy("source", "lang", "n_chars")
    named = named.withColumn("#again", F.row_number().over(again)).where("`#again` = 1").drop("#again")
    return named.unionByName(docs.where("doc_id IS NULL"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources by target weights: a document comes once for each time it is taken."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of the documents, the ids of their texts and their number."""
    return tokenizer().encode(docs).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("lines", dedup_lines),
    ("near_documents", dedup_documents),
    ("mixture", mix_sources),
    ("tokens", tokenize),
]

#: The stages learn, draw and encode: no SQL states their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each is written to the shared folder and read by the next."""
    docs = settings.spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = settings.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
