"""Words, counts inside rows, vocabularies and weights."""

import math
import random
from collections import Counter

import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import IDF, CountVectorizer, StopWordsRemover
from pyspark.sql import functions as F

from wagegrid import fixed_values
from wagegrid.functions import words
from wagegrid.operators import frequent, terms


def test_stop_words_are_sparks(spark):
    assert StopWordsRemover.loadDefaultStopWords("english") == fixed_values.ENGLISH_STOP_WORDS


def test_tokens(spark):
    df = spark.createDataFrame([("Über  the C++ dev-ops a b x_1 ",)], "text string")
    assert words.tokenize_words(df).first().words == ["über", "the", "dev", "ops", "x_1"]
    assert words.tokenize(df).first().words == ["über", "", "the", "c++", "dev-ops", "a", "b", "x_1"]


def test_pairs_come_after_stop_words(spark):
    df = spark.createDataFrame([("head of the data team",), ("one",)], "text string")
    kept = words.remove_stop_words(words.tokenize_words(df))
    pairs = [r.pairs for r in words.bigrams(kept).collect()]
    assert pairs == [["head data", "data team"], []]
    other = words.remove_stop_words(words.tokenize_words(df), stop_words=["data"])
    assert "the" in other.first().kept


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("abcde"), max_size=12), min_size=1, max_size=6))
def test_term_totals(spark, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "id int, words array<string>")
    found = {r.term: (r.n, r.n_rows) for r in terms.term_totals(df).collect()}
    uses = Counter(t for row in rows for t in row)
    in_rows = Counter(t for row in rows for t in set(row))
    assert found == {t: (uses[t], in_rows[t]) for t in uses}
    counts = {
        (r.id, r.term): r.n for r in terms.term_counts(df, "id", size=9, min_rows=1).collect()
    }
    assert counts == {(i, t): n for i, row in enumerate(rows) for t, n in Counter(row).items()}


def test_weights_agree_with_ml(spark):
    rows = [(0, "a a b c".split()), (1, "a b".split()), (2, "d d d d d".split()), (3, [])]
    df = spark.createDataFrame(rows, "id int, words array<string>")
    counter = CountVectorizer(inputCol="words", outputCol="n", vocabSize=3, minDF=2).fit(df)
    assert set(counter.vocabulary) == {"a", "b"}
    scaled = IDF(inputCol="n", outputCol="w").fit(counter.transform(df)).transform(counter.transform(df))
    want = {
        (r.id, counter.vocabulary[i]): v
        for r in scaled.collect() for i, v in zip(r.w.indices, r.w.values)
    }
    found = {(r.id, r.term): r.weight for r in terms.tfidf(df, "id").collect()}
    assert found.keys() == want.keys()
    assert all(math.isclose(found[k], want[k]) for k in want)
    assert {r.n for r in terms.term_counts(df, "id", binary=True).collect()} == {1}
    assert [(r.term, r.n, r.n_rows) for r in terms.top_terms(df, n=2, rows_too=True).collect()] == [
        ("d", 5, 1), ("a", 3, 2),
    ]
    assert terms.top_terms(df, n=2, min_rows=2).columns == ["term", "n"]


def test_missing_texts_and_words(spark):
    df = spark.createDataFrame([(None,), ("The Cat  sat",), ("",)], "text string")
    cut = words.tokenize(df)
    assert [r.words for r in cut.collect()] == [None, ["the", "cat", "", "sat"], [""]]
    kept = words.remove_stop_words(cut.withColumn("words", F.array_append("words", F.lit(None).cast("string"))))
    assert [r.kept for r in kept.collect()] == [None, ["cat", "", "sat"], [""]]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("abcdefghij") | st.none(), max_size=14), min_size=1, max_size=9),
       st.integers(1, 4), st.integers(1, 5), st.integers(1, 3))
def test_bounded_summaries_find_the_same_terms(spark, rows, capacity, n, min_rows):
    df = spark.createDataFrame(list(enumerate(rows)), "id int, words array<string>").repartition(3)
    uses = Counter(t for row in rows for t in row if t)
    in_rows = Counter(t for row in rows for t in set(row) if t)
    want = sorted((-uses[t], t, in_rows[t]) for t in uses if in_rows[t] >= min_rows)[:n]
    found = terms.top_terms(df, n=n, min_rows=min_rows, rows_too=True, capacity=capacity)
    assert [(-r.n, r.term, r.n_rows) for r in found.collect()] == want


def test_bounds_of_summaries():
    draw = random.Random(2)
    words = [f"w{int(draw.paretovariate(0.9))}" for _ in range(20_000)]
    batches = [pa.record_batch({"w": pa.array([words[i : i + 50] for i in range(at, at + 1000, 50)])}) for at in range(0, 20_000, 1000)]
    (out,) = frequent._summary(60)(batches)
    rows, uses = out.to_pylist(), Counter(words)
    lost = rows[-1]["lost"]
    assert len(rows) <= 61 and 0 < lost < 20_000 / 60
    low = {r["term"]: r["n"] for r in rows[:-1]}
    assert all(low.get(t, 0) <= n <= low.get(t, 0) + lost for t, n in uses.items())


def test_counts_in_rows_are_not_shuffled(spark):
    df = spark.createDataFrame([(i % 2, ["a", "b", "a", None, "z"]) for i in range(6)], "id int, words array<string>")
    for made in (terms.term_counts(df, "id", size=2), terms.bucket_counts(df, "id")):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Join" not in plan
    assert sorted(map(tuple, terms.term_counts(df, "id", size=2, min_rows=1).collect()))[:2] == [(0, "a", 2), (0, "a", 2)]
    weighed = terms.tfidf(df, "id", size=2)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in weighed
    many = terms.term_counts(df, "id", size=terms.LISTED_TERMS + 1)
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, terms.term_counts(df, "id", size=9).collect()))
    assert sum(r.n for r in terms.bucket_counts(df, "id").collect()) == 24


def test_pieces_of_rows_are_counted_once_a_row(spark):
    rows = [["a"] * 100 + ["b"], ["b"] * 40, [], None, ["a", None, "c"] * 30]
    df = spark.createDataFrame(list(enumerate(rows)), "id int, words array<string>")
    pieces = frequent._pieces(df, "words").collect()
    assert max(len(r[0]) for r in pieces) == frequent.PIECE and sum(len(r[0]) for r in pieces) == 231
    batches = [
        pa.record_batch({"w": pa.array([p[0]], pa.list_(pa.string())), "row": pa.array([p[1]], pa.int64())}) for p in pieces
    ]
    (out,) = frequent._summary(60)(batches)
    assert [tuple(r.values())[:3] for r in out.to_pylist()] == [("a", 130, 2), ("b", 41, 2), ("c", 30, 1), (None, 0, 0)]
