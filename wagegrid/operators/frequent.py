"""The most frequent terms of a table, by summaries of bounded size.

Every task counts terms and, when it holds more than ``capacity`` of them, takes the count
of the first term too many off all counts and drops those that reach zero (Misra and Gries,
in the form that merges).  A count is then too low by at most what was taken off, so that
the sums over all tasks bound every term's uses from both sides, also those of terms no
task kept.  If no task had to drop a term, the sums are exact.  Otherwise the best candidates
are counted exactly, and the bounds tell whether any other term could be among them; only
if so are all terms counted.  A shuffle carries at most ``capacity`` lines per task.

Rows come to the tasks in pieces of some words, so that what a task holds at a time grows neither
with the length of a row nor with the rows of a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagegrid import settings

#: Terms that a task keeps.
CAPACITY = 100_000
#: Words of a row that come to a task as one line; a batch has 10,000 lines.
PIECE = 16
_SUMMARY = "term string, n long, n_rows long, lost long"


def _pruned(held: dict[str, list[int]], capacity: int) -> tuple[dict[str, list[int]], int]:
    """At most ``capacity`` terms, and what was taken off their counts."""
    if len(held) <= capacity:
        return held, 0
    counts = np.fromiter((c[0] for c in held.values()), np.int64, len(held))
    off = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    return {t: [n - off, rows] for t, (n, rows) in held.items() if n > off}, off


class _Row:
    """The terms seen in the row whose pieces are being read: one row may go over several batches."""

    def __init__(self):
        self.number: int | None = None
        self.terms: set[str] = set()


def _batch_counts(words: pa.Array, numbers: np.ndarray, last: _Row) -> Iterator[tuple[str, int, int]]:
    """term, uses, rows that use it and were not counted with ``last``, of a batch of lists
    that are (parts of) the rows ``numbers``.
    """
    rows = numbers[pc.list_parent_indices(words).to_numpy()]
    flat = pc.list_flatten(words)
    if flat.null_count:
        rows, flat = rows[flat.is_valid().to_numpy(zero_copy_only=False)], flat.drop_null()
    if not len(flat):
        return
    coded = flat.dictionary_encode()
    codes, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
    starts = np.cumsum(np.concatenate([[0], rows[1:] != rows[:-1]]))
    pairs = np.sort(starts * len(names) + codes)
    firsts = np.concatenate([[True], pairs[1:] != pairs[:-1]])
    in_rows = np.bincount(pairs[firsts] % len(names), minlength=len(names))
    if rows[0] == last.number:
        again = [c for c in np.unique(codes[starts == 0]).tolist() if names[c] in last.terms]
        in_rows[again] -= 1
    if rows[-1] != last.number:
        last.number, last.terms = int(rows[-1]), set()
    last.terms.update(names[c] for c in np.unique(codes[starts == starts[-1]]).tolist())
    yield from zip(names, np.bincount(codes, minlength=len(names)).tolist(), in_rows.tolist(), strict=True)


def _summary(capacity: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of lists of words; a second column numbers the rows that they are pieces of, side by side."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}
        lost, before, last = 0, 0, _Row()
        for batch in batches:
            if batch.num_columns > 1:
                numbers = batch.column(1).to_numpy()
            else:
                numbers = np.arange(before, before + batch.num_rows)
            before += batch.num_rows
            for term, n, rows in _batch_counts(batch.column(0), numbers, last):
                own = held.get(term)
                if own is None:
                    held[term] = [n, rows]
                else:
                    own[0] += n
                    own[1] += rows
            if len(held) > 2 * capacity:
                held, off = _pruned(held, capacity)
                lost += off
        held, off = _pruned(held, capacity)
        yield pa.record_batch({
            "term": pa.array([*held, None], pa.string()), "n": pa.array([c[0] for c in held.values()] + [0], pa.int64()),
            "n_rows": pa.array([c[1] for c in held.values()] + [0], pa.int64()),
            "lost": pa.array([0] * len(held) + [lost + off], pa.int64()),
        })

    return run


def _pieces(df: DataFrame, words: str) -> DataFrame:
    """``words`` cut into lists of at most ``PIECE``, and the number of their row."""
    numbered = df.select(words, F.monotonically_increasing_id().alias("_row"))
    starts = F.when(F.size(words) > 0, F.sequence(F.lit(1), F.size(words), F.lit(PIECE)))
    cut = numbered.withColumn("_cut", F.transform(starts, lambda i: F.slice(words, i, F.lit(PIECE))))
    return settings.unfolded(cut.select("_cut", "_row"), "_cut", "_piece").select("_piece", "_row")


def most_frequent(
    df: DataFrame, words: str, n: int, min_rows: int, totals: Callable[[DataFrame, list[str] | None], DataFrame],
    capacity: int = CAPACITY,
) -> DataFrame:
    """``term``, ``n`` and ``n_rows`` of the ``n`` most frequent terms in at least ``min_rows`` rows.

    Ties by term.  ``totals`` counts terms exactly, those of a list or all.  The driver sees
    some thousand candidates (eight for each wanted term) at most.
    """
    found = settings.written(_pieces(df, words).mapInArrow(_summary(capacity), _SUMMARY), "term-summaries")
    lost = found.agg(F.sum("lost")).first()[0] or 0
    merged = found.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n"), F.sum("n_rows").alias("n_rows"))
    best = [F.desc("n"), F.asc("term")]
    if lost == 0:
        return merged.where(F.col("n_rows") >= min_rows).orderBy(*best).limit(n)
    most = max(8 * n, 1000)
    candidates = merged.orderBy(*best).limit(most + 1).collect()
    # what a term that is no candidate has at most
    bound = lost + (candidates[most].n if len(candidates) > most else 0)
    exact = settings.written(totals(df, [r.term for r in candidates[:most]]), "term-candidates")
    top = exact.where(F.col("n_rows") >= min_rows).orderBy(*best).limit(n)
    last = top.agg(F.min("n").alias("n"), F.count("*").alias("held")).first()
    if last.held == n and last.n > bound:
        return top
    return totals(df, None).where(F.col("n_rows") >= min_rows).orderBy(*best).limit(n)
