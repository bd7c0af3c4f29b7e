"""Words of texts: tokens, stop words and pairs."""

from __future__ import annotations

from pyspark.ml.feature import NGram, Tokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagegrid import fixed_values

#: Words of at least two word characters, letters of any script.
WORD = r"(?U)\b\w\w+\b"


def tokenize(df: DataFrame, text: str = "text", out: str = "words") -> DataFrame:
    """Lower-case, cut at white space; punctuation stays on the words.  Null stays null."""
    held = df.withColumn("_given", F.coalesce(text, F.lit("")))
    cut = Tokenizer(inputCol="_given", outputCol="_cut").transform(held)
    return cut.withColumn(out, F.when(F.col(text).isNotNull(), F.col("_cut"))).drop("_given", "_cut")


def words_of(text: str | Column) -> Column:
    """Lower-case words of two or more word characters, as a native expression."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def tokenize_words(df: DataFrame, text: str = "text", out: str = "words") -> DataFrame:
    return df.withColumn(out, words_of(text))


def remove_stop_words(
    df: DataFrame, words: str = "words", out: str = "kept",
    stop_words: list[str] | None = None,
) -> DataFrame:
    """Without stop words (case is ignored); the default list is Spark's English one.

    A null list stays null; null words go.
    """
    listed = sorted({w.lower() for w in stop_words or fixed_values.ENGLISH_STOP_WORDS})
    return df.withColumn(out, F.filter(words, lambda w: ~F.lower(w).isin(listed)))


def bigrams(df: DataFrame, words: str = "kept", out: str = "pairs") -> DataFrame:
    """Neighbouring word pairs, joined by a blank."""
    return NGram(n=2, inputCol=words, outputCol=out).transform(df)
