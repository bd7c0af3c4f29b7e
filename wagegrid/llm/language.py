"""Language by rank order: a text's most frequent n-grams against learned profiles.

N-grams are runs of one to three characters of lower-cased words, with one blank before
and behind each word; what is no letter parts words.  The profile of a language lists its
``PROFILE`` most frequent n-grams.  The out-of-place distance of a text sums, over its own
``PROFILE`` most frequent n-grams, how far their rank is from the rank in the profile, and
``PROFILE`` for those that the profile lacks.  The nearest language wins.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagegrid.llm.common import give_back, map_batches, slices, with_columns

#: N-grams in a profile.
PROFILE = 300
#: Characters worked on at a time, and counts a task holds before it hands them on.
_BATCH_CHARS = 1 << 18
#: Characters of the texts whose profiles are held at a time.
_SCORED_CHARS = 1 << 21
_HELD = 500_000
_BITS = 21  # of a code point; three of them fill 63 bits


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _gram_runs(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, n-grams, text of each n-gram) for about ``_BATCH_CHARS`` at a time."""
    for first, last in slices([len(t or "") + 1 for t in texts], _BATCH_CHARS):
        lowered = [(t or "").lower() for t in texts[first:last]]
        points = np.frombuffer(" ".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        # the blank behind a text is its own; numbers come from lengths, as texts hold any character
        text = np.repeat(np.arange(len(lowered)), [len(t) + 1 for t in lowered])[:-1]
        letter = _letters()[points]
        # one blank between words: keep letters and the first other character behind one
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        code = np.where(letter, points, 32)[keep]
        text = text[keep]
        blank = code == 32
        # with the blank of the word before it, or of the start
        code = np.concatenate([[32], code, [32]])
        n = len(text)
        at = np.flatnonzero(~blank) + 1
        of = text[at - 1]
        before, after = code[at - 1], code[at + 1]
        before = np.where((at >= 2) & (text[np.maximum(at - 2, 0)] == of), before, 32)
        after = np.where((at < n) & (text[np.minimum(at, n - 1)] == of), after, 32) if n else after
        own = code[at]
        single = own
        ahead = (own << _BITS) | after
        behind = (np.int64(32) << _BITS) | own
        starts = before == 32
        triple = (((before << _BITS) | own) << _BITS) | after
        yield first, np.concatenate([single, ahead, behind[starts], triple]), np.concatenate(
            [of, of, of[starts], of]
        )


def text_profiles(texts: list[str | None], size: int = PROFILE) -> list[np.ndarray]:
    """The most frequent n-grams of every text, most frequent first, ties by code."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
    for first, grams, text in _gram_runs(texts):
        order = np.argsort(text, kind="stable")
        grams, text = grams[order], text[order]
        edges = np.flatnonzero(np.diff(text, prepend=-1, append=-1) != 0)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own = np.sort(grams[a:b])
            marks = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]]))
            counts, own = np.diff(marks), own[marks[:-1]]
            best = np.argsort(-counts, kind="stable")[:size]
            out[first + int(text[a])] = own[best]
    return out


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (lang, n-gram), combined over the batches of a task while they are few."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def out() -> pa.RecordBatch:
        names = [name for name, (grams, _) in held.items() for _ in range(len(grams))]
        return pa.record_batch({
            "lang": pa.array(names, pa.string()),
            "gram": pa.array(np.concatenate([g for g, _ in held.values()])),
            "n": pa.array(np.concatenate([n for _, n in held.values()])),
        })

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        texts = batch.column("text").to_pylist()
        for lang in dict.fromkeys(langs):
            for _, grams, _ in _gram_runs([t for t, name in zip(texts, langs, strict=True) if name == lang]):
                grams, counts = np.unique(grams, return_counts=True)
                if lang in held:
                    grams, at = np.unique(np.concatenate([held[lang][0], grams]), return_inverse=True)
                    counts = np.bincount(at, np.concatenate([held[lang][1], counts])).astype(np.int64)
                held[lang] = grams, counts
        if sum(len(g) for g, _ in held.values()) > _HELD:
            yield out()
            held.clear()
        give_back()
    if held:
        yield out()


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, place): the profile of every language, counted over all its texts.

    Rows without text or language are left out.  Ties are broken by the n-gram's code.
    """
    held = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna()
    counts = held.mapInArrow(_counts, "lang string, gram long, n long")
    totals = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # the best of each of several parts, then the best of those: no language is one task
    part = Window.partitionBy("lang", F.pmod(F.hash("gram"), F.lit(32))).orderBy(F.desc("n"), "gram")
    whole = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = totals.withColumn("place", F.row_number().over(part)).where(F.col("place") <= PROFILE)
    best = best.withColumn("place", F.row_number().over(whole) - 1).where(F.col("place") < PROFILE)
    return best.select("lang", "gram", "place")


def with_language(
    docs: DataFrame, profiles: DataFrame, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score"
) -> DataFrame:
    """All columns of ``docs`` with the language and score of each row's text (replaced if there).

    ``und`` with score 0 stands for a null text, a text without letters, and any text if
    no language was learned.  Ties go to the language that sorts first.  The score is
    1 minus the distance over the largest possible one, for the n-grams the text has.
    The profiles (``PROFILE`` rows a language) are sent to the tasks.  Long texts are read
    whole; repeated rows each get their result.
    """
    kept = docs.drop(lang_col, score_col)
    schema = kept.withColumns({lang_col: F.lit(None).cast("string"), score_col: F.lit(None).cast("double")}).schema
    found = profiles.orderBy("lang", "gram").collect()
    names = sorted({r.lang for r in found})
    codes = np.array(sorted({r.gram for r in found}), np.int64)
    places = np.full((len(names), len(codes) + 1), PROFILE, np.int64)
    known = np.full((len(names), len(codes) + 1), False)
    for r in found:
        at = np.searchsorted(codes, r.gram)
        places[names.index(r.lang), at], known[names.index(r.lang), at] = r.place, True

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = [], []
        texts = batch.column(text_col)
        parts = slices(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), _SCORED_CHARS)
        for grams in chain.from_iterable(text_profiles(texts.slice(a, b - a).to_pylist()) for a, b in parts):
            if not len(grams) or not names:
                langs.append("und")
                scores.append(0.0)
                continue
            at = np.minimum(np.searchsorted(codes, grams), len(codes) - 1)
            at = np.where(codes[at] == grams, at, len(codes))
            off = np.abs(places[:, at] - np.arange(len(grams)))
            distance = np.where(known[:, at], off, PROFILE).sum(axis=1)
            best = int(distance.argmin())
            langs.append(names[best])
            scores.append(1 - float(distance[best]) / (len(grams) * PROFILE))
        return with_columns(batch, **{lang_col: pa.array(langs, pa.string()), score_col: pa.array(scores, pa.float64())})

    return map_batches(kept, score, schema)


def predict_language(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score for every row of ``docs``; see ``with_language``."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_language(docs, profiles).drop("text")
