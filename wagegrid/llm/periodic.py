"""Periodic runs of words, found by recompression.

A run is a stretch of consecutive words with smallest period q, at least
``max(LEAST_WORDS, 2 q)`` words long, that no neighbouring word extends.

The words of a batch of texts are numbered and compressed in rounds.  A round first replaces
blocks (the same symbol several times in a row) and then pairs (a symbol of one half of the
alphabet before one of the other half), the halves being drawn by a hash.  Equal stretches
compress alike but for their ends, and the symbols of all rounds form a grammar with runs.
How far two places agree is read from it level by level: up while both places begin a
symbol of the next level, down again behind the first unequal symbol, a block at a time.

A run of period p holds two neighbouring places of the grid p, 2p, 3p, ...  So all pairs of
neighbours of all grids (n log n of them) that hold the same word are extended exactly, to the
left and to the right; long enough stretches are the runs, each at its smallest period.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagegrid.llm import words
from wagegrid.llm.common import map_batches, slices, with_columns

#: A run has at least so many words, and so many periods.
LEAST_WORDS = 12
LEAST_PERIODS = 2
#: Pairs of places compared at a time.
_PAIRS = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class _Level:
    """The symbols of one level.  Places are the bounds between them, 0 to their number."""

    symbols: np.ndarray
    ahead: np.ndarray  #: equal symbols from here on, by symbol
    behind: np.ndarray  #: equal symbols up to here, by symbol
    up: np.ndarray  #: place in the level above, -1 inside one of its symbols
    down: np.ndarray  #: places of the level above in this one


class Grammar:
    """A run-length grammar over sequences of numbers, with exact common extensions.

    ``codes`` are numbers from 0; ``bounds`` cuts them into sequences, which never share a symbol.
    """

    def __init__(self, codes: np.ndarray, bounds: np.ndarray):
        # a symbol of its own between sequences ends every comparison
        n, cuts = len(codes), len(bounds)
        ends = np.zeros(n + cuts, bool)
        ends[bounds + np.arange(cuts)] = True
        symbols = np.empty(n + cuts, np.int64)
        symbols[~ends] = codes
        first = int(codes.max()) + 1 if n else 0
        symbols[ends] = first + np.arange(cuts)
        self.shift = np.flatnonzero(~ends)  # place of a word
        self.levels: list[_Level] = []
        self._build(symbols, ends, first + cuts)

    def _build(self, symbols: np.ndarray, ends: np.ndarray, free: int) -> None:
        step = 0
        while True:
            edges = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1], [True]]))
            sizes = np.diff(edges)
            at = np.repeat(edges[:-1], sizes)
            size = np.repeat(sizes, sizes)
            here = np.arange(len(symbols))
            level = _Level(symbols, at + size - here, here - at + 1, np.zeros(0), np.zeros(0))
            self.levels.append(level)
            # blocks: one symbol for every (symbol, times)
            heads, held = edges[:-1], ends[edges[:-1]]
            made = symbols[heads]
            long = np.flatnonzero(sizes > 1)
            if len(long):
                made[long], free = _named(made[long], sizes[long], free)
            # pairs: of some cuts of the alphabet, the one that joins most
            joins = np.zeros(0, np.int64)
            inner = ~held[1:] & ~held[:-1]
            for seed in range(step, step + 4) if inner.any() else ():
                half = (words.mix(made.astype(np.uint64), seed) >> np.uint64(63)).astype(bool)
                found = np.flatnonzero(half[1:] & ~half[:-1] & inner)
                joins = found if len(found) > len(joins) else joins
            step += 4
            if not len(joins) and not len(long) and not (~held[1:] & ~held[:-1]).any():
                return  # every sequence is one symbol
            if len(joins):
                made[joins], free = _named(made[joins], made[joins + 1], free)
                keep = np.ones(len(made), bool)
                keep[joins + 1] = False
                made, heads, held = made[keep], heads[keep], held[keep]
            level.down = np.append(heads, len(symbols))
            level.up = np.full(len(symbols) + 1, -1)
            level.up[level.down] = np.arange(len(heads) + 1)
            symbols, ends = made, held

    def agree(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """Words that agree from the words ``a`` and ``b`` on, or before them; ``a < b``."""
        at, to = self.shift[a], self.shift[b]
        begin = at.copy()
        alive = np.arange(len(a))
        waiting: list[np.ndarray] = []
        top = len(self.levels) - 1
        for depth, level in enumerate(self.levels):
            alive, failed = self._advance(level, at, to, alive, forward, depth < top)
            waiting.append(failed)
            if not len(alive):
                break
            at[alive], to[alive] = level.up[at[alive]], level.up[to[alive]]
        falling = np.zeros(0, np.int64)
        for depth in range(len(waiting) - 1, -1, -1):
            level = self.levels[depth]
            if len(falling):
                at[falling], to[falling] = level.down[at[falling]], level.down[to[falling]]
                # what differs as one symbol may still begin alike
                _, falling = self._advance(level, at, to, falling, forward, False)
            falling = np.concatenate([falling, waiting[depth]])
        return at - begin if forward else begin - at

    @staticmethod
    def _advance(level: _Level, at: np.ndarray, to: np.ndarray, alive: np.ndarray, forward: bool, rises: bool):
        """Moves places over equal symbols; (those that can go up, those that met a difference)."""
        up, done = [], []
        symbols, run = level.symbols, level.ahead if forward else level.behind
        off = 0 if forward else 1
        while len(alive):
            a, b = at[alive], to[alive]
            if rises:
                ready = (level.up[a] >= 0) & (level.up[b] >= 0)
                up.append(alive[ready])
                alive, a, b = alive[~ready], a[~ready], b[~ready]
            # the first and last symbols are cuts, so that no place falls off
            same = symbols[a - off] == symbols[b - off]
            done.append(alive[~same])
            alive, a, b = alive[same], a[same] - off, b[same] - off
            step = np.minimum(run[a], run[b])
            at[alive] += step if forward else -step
            to[alive] += step if forward else -step
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *up]), np.concatenate([none, *done])


def _named(left: np.ndarray, right: np.ndarray, free: int) -> tuple[np.ndarray, int]:
    """New symbols for pairs, equal ones for equal pairs, and the next free symbol."""
    order = np.lexsort((right, left))
    new = np.ones(len(order), bool)
    new[1:] = (left[order][1:] != left[order][:-1]) | (right[order][1:] != right[order][:-1])
    names = np.empty(len(order), np.int64)
    names[order] = free + np.cumsum(new) - 1
    return names, free + int(new.sum())


def _candidates(codes: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(sequence, first place, period) of grid neighbours with equal numbers, some at a time.

    Sequences must be sorted by length, the longest first.
    """
    sizes = np.diff(bounds)
    parts, held = [], 0
    periods = np.arange(1, (int(sizes[0]) if len(sizes) else 0) // LEAST_PERIODS + 1)
    # places of the sequences that are long enough for a period
    lasts = bounds[np.searchsorted(-sizes, -LEAST_PERIODS * periods, side="right")]
    for period, last in zip(periods.tolist(), lasts.tolist(), strict=True):
        places = np.flatnonzero(codes[0 : last - period : period] == codes[period:last:period]) * period
        if len(places):
            of = np.searchsorted(bounds, places, side="right") - 1
            inside = places + period < bounds[of + 1]
            parts.append((of[inside], places[inside], np.full(int(inside.sum()), period)))
            held += len(parts[-1][0])
        if held >= _PAIRS:
            yield tuple(np.concatenate(p) for p in zip(*parts, strict=True))
            parts, held = [], 0
    if held:
        yield tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def find_runs(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows (sequence, start, length, period) of all runs, in this order.

    ``codes`` numbers equal words alike, ``bounds`` (from 0 to the number of words) cuts them
    into sequences; starts count from the beginning of the sequence.
    """
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    # the sequences with the longest first
    moved = np.concatenate([[0], np.cumsum(sizes[order])])
    place = np.repeat(bounds[:-1][order] - moved[:-1], sizes[order]) + np.arange(len(codes))
    codes = codes[place] if len(codes) else codes
    grammar, found = None, [np.zeros((0, 4), np.int64)]
    for of, first, period in _candidates(codes, moved):
        grammar = grammar or Grammar(codes, moved)
        for at in range(0, len(of), _PAIRS):
            part = slice(at, at + _PAIRS)
            a, b, p = first[part], first[part] + period[part], period[part]
            left, right = grammar.agree(a, b, False), grammar.agree(a, b, True)
            size = left + p + right
            enough = size >= np.maximum(LEAST_WORDS, LEAST_PERIODS * p)
            start = a - left - moved[of[part]]
            rows = np.stack([of[part], start, size, p], axis=1)[enough]
            found.append(_smallest_periods(rows))
    rows = _smallest_periods(np.concatenate(found))
    rows[:, 0] = order[rows[:, 0]]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _smallest_periods(rows: np.ndarray) -> np.ndarray:
    """Of equal stretches, the one with the smallest period: the others are multiples of it."""
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    return rows[new]


def _word_table(texts: pa.Array) -> Iterator[tuple[int, int, pa.Array, np.ndarray]]:
    """(first text, last text, words, bounds of the texts' words), some texts at a time."""
    data, at = words.text_bytes(texts)
    for first, last in slices(np.diff(at).tolist(), words.BATCH_BYTES):
        part = data[at[first] : at[last]]
        offsets = at[first : last + 1] - at[first]
        blank = _SPACE[part]
        begins = ~blank
        begins[1:] &= blank[:-1]
        begins[offsets[:-1][offsets[:-1] < len(part)]] = True
        begins &= ~blank
        starts = np.flatnonzero(begins)
        kept = part[~blank]
        ends = np.append(np.cumsum(~blank)[starts] - 1, len(kept)) if len(starts) else np.zeros(1, np.int64)
        held = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(kept))]
        )
        yield first, last, held, np.searchsorted(starts, offsets)


def _each_runs(texts: pa.Array, plans: list[Callable | None] | None = None):
    """For every text: its words (bytes, rearranged by its plan if it has one) and rows of runs."""
    for first, last, held, bounds in _word_table(texts):
        coded = held.dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64) if len(held) else np.zeros(0, np.int64)
        for i in range(first, last) if plans else ():
            if plans[i] is not None and bounds[i - first] < bounds[i - first + 1]:
                part = slice(bounds[i - first], bounds[i - first + 1])
                codes[part] = codes[part][plans[i](part.stop - part.start)]
        rows = find_runs(codes, bounds)
        spelled = coded.dictionary.to_pylist()
        edges = np.searchsorted(rows[:, 0], np.arange(last - first + 1))
        for i in range(last - first):
            own = codes[bounds[i] : bounds[i + 1]]
            yield [spelled[c] for c in own.tolist()], rows[edges[i] : edges[i + 1], 1:]


def _kept(n: int, runs: np.ndarray) -> np.ndarray:
    """True for words that no run holds behind its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth[:-1]) == 0


def with_runs(docs: DataFrame, text_col: str = "text", runs_col: str = "runs", collapsed_col: str | None = None) -> DataFrame:
    """All columns of ``docs`` and the runs of each text: array of (start, length, period).

    Words are runs of characters other than the six ASCII blanks; case counts.  Runs come by
    start, then period.  ``collapsed_col`` names a column for the text of the words that are
    left when every run keeps its first period only, joined by one blank.  Null and empty
    texts have no runs; a null text stays null.  Texts are read whole, rows that repeat get
    equal results.  Columns with the names of the new ones are replaced.
    """
    added = {runs_col: F.lit(None).cast("array<struct<start:bigint,length:bigint,period:bigint>>")}
    if collapsed_col:
        added[collapsed_col] = F.lit(None).cast("string")
    kept = docs.drop(*added)
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, runs, left = batch.column(text_col), [], []
        valid = texts.is_valid().to_pylist()
        for known, (own, rows) in zip(valid, _each_runs(texts), strict=True):
            runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in rows.tolist()])
            if collapsed_col:
                keep = _kept(len(own), rows)
                left.append(b" ".join(w for w, k in zip(own, keep.tolist(), strict=True) if k).decode() if known else None)
        made = {runs_col: pa.array(runs, kind)}
        if collapsed_col:
            made[collapsed_col] = pa.array(left, pa.string())
        return with_columns(batch, **made)

    return map_batches(kept, make, kept.withColumns(added).schema)


_DIGEST = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def run_digests(docs: DataFrame, repeat: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_runs, the longest run and digests of the runs and of the collapsed text.

    ``repeat`` is a number g by which a row's words are rearranged before the search, or null:
    with n words, a = g % n and p = 1 + (n - a) // (3 + g % 8), word i >= a becomes word
    a + (i - a) % p.  The longest run (ties: smallest start, then period) gives start, length,
    period and exponent_milli, null without a run.
    """
    repeat = F.lit(None) if repeat is None else repeat
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), repeat.cast("long").alias("g"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def plan(g: int | None) -> Callable | None:
        def order(n: int) -> np.ndarray:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            at = np.arange(n)
            return np.where(at < a, at, a + (at - a) % p)

        return None if g is None else order

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[str, list] = {c.split()[0]: [] for c in _DIGEST.split(", ")}
        plans = [plan(g) for g in batch.column("g").to_pylist()]
        for own, rows in _each_runs(batch.column("text"), plans):
            longest = max(rows.tolist(), key=lambda r: (r[1], -r[0], -r[2]), default=[None] * 3)
            listed = "".join(f"{s},{n},{p}\n" for s, n, p in rows.tolist())
            kept = (w for w, k in zip(own, _kept(len(own), rows).tolist(), strict=True) if k) if len(rows) else own
            exponent = 1000 * longest[1] // longest[2] if len(rows) else None
            values = (
                len(rows), *longest, exponent, hashlib.sha256(listed.encode()).hexdigest(),
                hashlib.sha256(b" ".join(kept)).hexdigest(),
            )
            for column, value in zip(found.values(), values, strict=True):
                column.append(value)
        arrays = {c: pa.array(v, pa.string() if c.endswith("sha256") else pa.int64()) for c, v in found.items()}
        return pa.record_batch({"doc_id": batch.column("doc_id"), **arrays})

    return map_batches(rows, make, f"doc_id {kind}, {_DIGEST}")
