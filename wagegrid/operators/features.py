"""Labels, flags, place columns and assembled feature vectors."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    NGram,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
    VectorAssembler,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagegrid import fixed_values
from wagegrid.functions.flags import flag
from wagegrid.functions.words import WORD
from wagegrid.operators.dictionaries import OneHotDictionary, OneHotDictionaryModel
from wagegrid.operators.quantiles import quantile_value
from wagegrid.operators.stages import TitleFlags
from wagegrid.operators.terms import top_terms


def above_median(
    df: DataFrame, column: str = "Average", *, q: float = 0.5, name: str = "Above Median"
) -> DataFrame:
    """1 when the value is above the median (or another quantile), else 0.

    The quantile is one value computed once and compared in each row.  A missing value, be
    it null or NaN, is 0 and has no part in the quantile.
    """
    middle = quantile_value(df, column, q).scalar()
    value = F.col(f"`{column}`").cast("double")
    return df.withColumn(name, F.when((value > middle) & ~F.isnan(value), 1).otherwise(0))


#: Most columns that ``one_hot`` makes.
MOST_COLUMNS = 10_000


def distinct_values(df: DataFrame, column: str) -> list[str]:
    """Sorted values of a column, as names of columns to make: one text per column.

    A column of more than ``MOST_COLUMNS`` values is refused before they are brought together.
    """
    found = df.select(F.col(f"`{column}`").alias("v")).where("v IS NOT NULL").distinct()
    values = found.limit(MOST_COLUMNS + 1).collect()
    if len(values) > MOST_COLUMNS:
        raise ValueError(f"{column} has more than {MOST_COLUMNS} values: use one_hot_stages")
    return sorted(row[0] for row in values)


def one_hot(df: DataFrame, column: str, values: list | None = None) -> DataFrame:
    """One 0/1 column per value in sorted order, none left out; missing is 0 in all.

    The list of values is a parameter of the result (as in a pivot); each row
    is then widened where it is, without a shuffle.  A value that is named like a column of
    ``df`` gives a column ``column=value``.  For a column with very many values
    ``one_hot_stages`` makes one sparse vector instead.
    """
    listed = distinct_values(df, column) if values is None else values
    taken = {c.lower() for c in df.columns}
    flags = []
    for v in listed:
        name = f"{column}={v}" if str(v).lower() in taken else str(v)
        taken.add(name.lower())
        flags.append(F.coalesce((F.col(f"`{column}`") == v).cast("int"), F.lit(0)).alias(name))
    return df.select("*", *flags)


def one_hot_stages(column: str, out: str) -> list:
    """The same as a sparse vector, for any number of values: they stay in a table.

    Missing and unknown values are all 0 and every value of the fitted rows has a place.
    """
    return [OneHotDictionary(column, out)]


def title_flags(
    df: DataFrame, column: str = "Title", words: list[str] | None = None
) -> DataFrame:
    """One 0/1 column per word: is it in the title?  Case counts."""
    listed = fixed_values.TITLE_WORDS if words is None else words
    return df.select("*", *[flag(column, w).alias(w) for w in listed])


def flagged_rows(df: DataFrame, flag: str) -> DataFrame:
    return df.where(F.col(f"`{flag}`") != 0)


def _term_stages(df: DataFrame, column: str, out: str, size: int, pairs: bool, binary: bool) -> list:
    """Words, stop words out, perhaps pairs, counts of the ``size`` top terms.

    The vocabulary is found by a plain aggregation with ties broken by term,
    so that a repeated run gets the same columns; only ``size`` terms come to
    the driver.  Columns are in alphabetical order.
    """
    given, tokens, kept = f"{out}_given", f"{out}_words", f"{out}_kept"
    stages = [
        # a missing text has no words
        SQLTransformer(statement=f"SELECT *, coalesce(`{column}`, '') AS `{given}` FROM __THIS__"),
        RegexTokenizer(inputCol=given, outputCol=tokens, pattern=WORD, gaps=False),
        StopWordsRemover(inputCol=tokens, outputCol=kept, locale="en_US",
                         stopWords=fixed_values.ENGLISH_STOP_WORDS),
    ]
    last = kept
    if pairs:
        last = f"{out}_pairs"
        stages.append(NGram(n=2, inputCol=kept, outputCol=last))
    rows = df.select(column)
    for stage in stages:
        rows = stage.transform(rows)
    found = top_terms(rows, last, size).select("term").collect()
    model = CountVectorizerModel.from_vocabulary(
        sorted(r.term for r in found), inputCol=last, outputCol=out
    )
    return [*stages, model.setBinary(binary)]


#: Which blocks each feature set is made of.
FEATURE_SETS = {
    "places": ("city",),
    "flags": ("city", "flags", "state"),
    "titles": ("title_terms", "city", "state"),
    "synopses": ("title_terms", "city", "state", "synopsis_terms"),
    # for weights of one block alone
    "title_terms": ("title_terms",),
    "states": ("state",),
}


def block_stages(
    df: DataFrame, blocks: tuple[str, ...], *, title: str = "Title", synopsis: str = "Synopsis",
    city: str = "City", state: str = "State Initials", words: list[str] | None = None,
    title_terms: int = fixed_values.TITLE_TERMS,
    synopsis_terms: int = fixed_values.SYNOPSIS_TERMS, binary: bool = False,
) -> list:
    """Pipeline stages that add one vector per block, named like the block."""
    made = {
        "city": lambda: one_hot_stages(city, "city"),
        "state": lambda: one_hot_stages(state, "state"),
        "flags": lambda: [TitleFlags(inputCol=title, outputCol="flags", words=words)],
        "title_terms": lambda: _term_stages(
            df, title, "title_terms", title_terms, True, binary
        ),
        "synopsis_terms": lambda: _term_stages(
            df, synopsis, "synopsis_terms", synopsis_terms, False, binary
        ),
    }
    return [stage for block in blocks for stage in made[block]()]


def assembler(feature_set: str) -> VectorAssembler:
    """The blocks of a feature set side by side in ``features``."""
    return VectorAssembler(inputCols=list(FEATURE_SETS[feature_set]), outputCol="features")


def feature_stages(df: DataFrame, feature_set: str, **options) -> list:
    """Pipeline stages that end in a ``features`` vector of the given set."""
    return [*block_stages(df, FEATURE_SETS[feature_set], **options), assembler(feature_set)]


def assemble(df: DataFrame, feature_set: str, **options) -> PipelineModel:
    """Fit the feature stages on ``df``; ``transform`` adds ``features``."""
    return Pipeline(stages=feature_stages(df, feature_set, **options)).fit(df)


def feature_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``place``, ``name``: the places of ``features``, block by block, as a table.

    Names of places come from their dictionary and never pass through the driver.
    """
    blocks = model.stages[-1].getInputCols()
    made = {s.getOutputCol(): s for s in model.stages if not isinstance(s, SQLTransformer)}
    tables, first = [], 0
    for block in blocks:
        stage = made[block]
        if isinstance(stage, OneHotDictionaryModel):
            names, size = stage.table(), stage.getOrDefault(stage.size)
        else:
            terms = stage.vocabulary if isinstance(stage, CountVectorizerModel) else stage.getOrDefault(stage.words)
            names, size = spark.createDataFrame(list(enumerate(terms)), "number long, value string"), len(terms)
        tables.append(names.select(
            (F.col("number") + first).alias("place"), F.concat(F.lit(f"{block}="), F.col("value")).alias("name")
        ))
        first += size
    return reduce(DataFrame.unionByName, tables)


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the places of ``features`` as a list, for sets whose weights are a list too."""
    found = feature_table(SparkSession.active(), model)
    return [r.name for r in found.orderBy("place").collect()]


def named_features(rows: DataFrame, model: PipelineModel, *keep: str) -> DataFrame:
    """``keep``, ``feature``, ``value``: what is not 0 in ``features``, by name."""
    names = feature_table(rows.sparkSession, model)
    held = rows.select(*keep, F.unwrap_udt("features").alias("v"))
    dense = F.col("v.indices").isNull()
    places = F.when(dense, F.sequence(F.lit(0), F.size("v.values") - 1)).otherwise(F.col("v.indices"))
    used = held.select(*keep, F.inline(F.arrays_zip(places.alias("place"), F.col("v.values").alias("value"))))
    return used.where("value <> 0").join(names, "place").select(*keep, F.col("name").alias("feature"), "value")
