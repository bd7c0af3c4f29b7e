"""Hidden Markov language model over words, trained and scored on whole documents.

Symbols.  The ``CORE`` most frequent training words are symbols of their own.  Every other
word, known or not, belongs to one of ``ENDINGS`` classes by a hash of its last two
characters; inside its class a word has probability (c + 1) / (C + V + 1), with its
count c, the class's tokens C and distinct words V.  The end of a text is a symbol too.
So the emission table has a fixed size while the counts grow with the corpus, and
P(text) = P(symbols by the forward recursion) * product of P(word | class).

Training.  Word counts, class totals and expected counts of Baum-Welch steps are sums over
all training rows, added up in tasks first.  The states begin apart by chance, and every step
that parts them further reads the whole corpus.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.llm.common import map_batches, slices

#: Words with emissions of their own, classes of other words, hidden states.
CORE = 65_536
ENDINGS = 256
STATES = 8
#: Steps over the corpus.
STEPS = 7
#: Weight, in tokens, of the overall frequencies in every state's emissions.
PRIOR = 200.0
_TOKENS = 200_000  # worked on at a time
_HELD = 400_000  # words counted in a task before they are handed on
_CHUNK = 4_096  # symbols in one row of expected counts
_SCALED = 8  # steps from one scaling of the forward probabilities to the next
_ROWS = 1 << 14  # rows of a trellis whose moves are summed at a time
_SUMMING = 3  # tasks for a core that sum expected counts

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[bytes]:
    """Runs of bytes other than space, tab, LF, VT, FF and CR, A-Z as a-z."""
    return (text or "").encode().translate(_LOWER).split()


def ending(word: bytes) -> int:
    return zlib.crc32(word.decode()[-2:].encode()) % ENDINGS


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows of ``text``."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.record_batch({
                "word": pa.array(list(held), pa.binary()).cast(pa.string()),
                "n": pa.array(list(held.values()), pa.int64()),
            })

        for batch in batches:
            for text in batch.column("text"):
                held.update(words(text.as_py()))
                if len(held) > _HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return texts.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Symbols:
    """What tasks need to turn words into symbols: bounded by ``CORE`` and ``ENDINGS``."""

    core: list[bytes]
    counts: np.ndarray  #: of every symbol: tokens
    known: np.ndarray  #: of every class of endings: distinct words
    tokens: int  #: N
    distinct: int  #: V

    @property
    def size(self) -> int:
        return len(self.core) + ENDINGS + 1

    @property
    def end(self) -> int:
        return self.size - 1


def learn_symbols(counts: DataFrame, documents: int, core: int = CORE) -> Symbols:
    top = counts.orderBy(F.desc("n"), "word").limit(core).collect()
    place = F.crc32(F.substring("word", -2, 2).cast("binary")) % ENDINGS
    all_of = counts.groupBy(place.cast("int").alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    by_class = {r.k: (r.n, r.v) for r in all_of}
    total, distinct = sum(n for n, _ in by_class.values()), sum(v for _, v in by_class.values())
    n = np.array([by_class.get(k, (0, 0))[0] for k in range(ENDINGS)], np.int64)
    v = np.array([by_class.get(k, (0, 0))[1] for k in range(ENDINGS)], np.int64)
    for r in top:
        k = ending(r.word.encode())
        n[k] -= r.n
        v[k] -= 1
    symbols = np.concatenate([np.array([r.n for r in top], np.int64), n, [documents]])
    return Symbols([r.word.encode() for r in top], symbols, v, total + documents, distinct + (documents > 0))


def encode(docs: DataFrame, symbols: Symbols) -> DataFrame:
    """docs without text, with seq (symbols as int32), n_tokens, core_known, core_base and others (words
    that are no symbol of their own)."""
    shared = docs.sparkSession.sparkContext.broadcast(symbols)
    cache: dict[int, tuple] = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not cache:
            s = shared.value
            base = np.log10((s.counts + 1) / (s.tokens + s.distinct + 1))
            base[len(s.core) : s.end] = 0
            cache[0] = s, {w: i for i, w in enumerate(s.core)}, base, {}
        s, index, base, endings = cache[0]
        seqs, lengths, known, bases, others = [], [], [], [], []
        end_known = int(s.counts[s.end] > 0)
        for text in batch.column("text"):
            found = words(text.as_py())
            seq = np.fromiter(map(index.get, found, repeat(-1)), np.int32, len(found))
            rest = np.flatnonzero(seq < 0)
            own = [found[i] for i in rest.tolist()]
            for i, w in zip(rest.tolist(), own, strict=True):
                tail = w[-8:]
                k = endings.get(tail)
                if k is None:
                    if len(endings) > 200_000:
                        endings.clear()
                    k = endings[tail] = ending(w)
                seq[i] = len(s.core) + k
            seq = np.append(seq, np.int32(s.end))
            seqs.append(seq.tobytes())
            lengths.append(len(seq))
            known.append(len(found) - len(own) + end_known)
            bases.append(float(base[seq].sum()))
            others.append(own)
        flat = pa.array([w for own in others for w in own], pa.binary()).cast(pa.string())
        edges = np.zeros(len(others) + 1, np.int32)
        np.cumsum([len(own) for own in others], out=edges[1:])
        return pa.record_batch({
            **{c: batch.column(c) for c in batch.schema.names if c != "text"},
            "seq": pa.array(seqs, pa.binary()), "n_tokens": pa.array(lengths, pa.int64()),
            "core_known": pa.array(known, pa.int64()), "core_base": pa.array(bases, pa.float64()),
            "others": pa.ListArray.from_arrays(pa.array(edges), flat),
        })

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return map_batches(
        docs, run, f"{kept}, seq binary, n_tokens long, core_known long, core_base double, others array<string>"
    )


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray  #: from row to column
    emit: np.ndarray  #: symbol, state


class Trellis:
    """Sequences in step-major order: rows of step t are offsets[t]:offsets[t + 1]."""

    def __init__(self, seqs: list[np.ndarray], model: Model):
        lengths = np.array([len(s) for s in seqs])
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        self.steps = int(lengths[0])
        self.alive = np.searchsorted(-lengths, -np.arange(self.steps), side="left")
        self.offsets = np.concatenate([[0], np.cumsum(self.alive)])
        flat = np.concatenate([seqs[i] for i in self.order.tolist()])
        step = np.concatenate([np.arange(n) for n in lengths.tolist()])
        at = self.offsets[step] + np.repeat(np.arange(len(lengths)), lengths)
        self.symbols = np.empty(len(flat), np.int64)
        self.symbols[at] = flat
        self.model = model
        self.likely = model.emit[self.symbols]

    def forward(self) -> tuple[np.ndarray, np.ndarray]:
        """Forward probabilities, scaled at every ``_SCALED``th step, and the scales of these steps'
        rows (1 elsewhere; their product is that of the steps before the end of a sequence).
        """
        alpha, move = self.likely.copy(), self.model.move
        scale = np.ones(len(alpha))
        a = alpha[: self.alive[0]]
        a *= self.model.start
        held = np.empty_like(a)
        edges = self.offsets.tolist()
        for t, n in enumerate(self.alive.tolist()):
            here = alpha[edges[t] : edges[t] + n]
            if t:
                here *= np.matmul(a[:n], move, out=held[:n])
            if t % _SCALED == 0:
                total = here @ np.ones(len(move))
                here /= total[:, None]
                scale[edges[t] : edges[t] + n] = total
            a = here
        return alpha, scale

    def _last(self) -> np.ndarray:
        """The row of every sequence's last step."""
        lengths = np.searchsorted(-self.alive, -np.arange(self.alive[0]), side="left")
        return self.offsets[lengths - 1] + np.arange(len(lengths))

    def log10(self) -> np.ndarray:
        """Log10 likelihood of every sequence, in the order they were given."""
        alpha, scale = self.forward()
        out = np.log10(alpha[self._last()].sum(axis=1))
        for t in range(0, self.steps, _SCALED):
            n, edge = self.alive[t], self.offsets[t]
            out[:n] += np.log10(scale[edge : edge + n])
        back = np.empty_like(out)
        back[self.order] = out
        return back

    def expected(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts of starts, moves and emissions (symbol, state)."""
        alpha, scale = self.forward()
        move, k = self.model.move, len(self.model.start)
        ahead, beta, turned = self.likely, np.empty_like(alpha), np.ascontiguousarray(move.T)
        # a sequence's last step stands for one over what its forward probabilities sum to
        last = self._last()
        beta[last] = (1 / alpha[last].sum(axis=1))[:, None]
        edges, alive = self.offsets.tolist(), self.alive.tolist()
        for t in range(self.steps - 1, 0, -1):
            n, edge = alive[t], edges[t]
            coming = ahead[edge : edge + n]
            coming *= beta[edge : edge + n]
            if t % _SCALED == 0:
                coming /= scale[edge : edge + n, None]
            np.matmul(coming, turned, out=beta[edges[t - 1] : edges[t - 1] + n])
        moves, before = np.zeros((k, k)), np.arange(alive[0], edges[-1]) - np.repeat(self.alive[:-1], self.alive[1:])
        for first in range(0, len(before), _ROWS):
            part = before[first : first + _ROWS]
            moves += alpha[part].T @ ahead[alive[0] + first : alive[0] + first + len(part)]
        gamma = alpha
        gamma *= beta
        size = len(self.model.emit)
        emit = np.stack([np.bincount(self.symbols, gamma[:, i], size) for i in range(k)], axis=1)
        return gamma[: alive[0]].sum(axis=0), moves * move, emit


def _groups(seqs: list[np.ndarray]) -> Iterator[list[int]]:
    """Positions of sequences of like length, about ``_TOKENS`` tokens at a time."""
    order = sorted(range(len(seqs)), key=lambda i: -len(seqs[i]))
    for a, b in slices([len(seqs[i]) for i in order], _TOKENS):
        yield order[a:b]


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(s, np.int32) for s in column.to_pylist()]


def fitted(start: np.ndarray, moves: np.ndarray, emit: np.ndarray, overall: np.ndarray) -> Model:
    """The model of expected counts: every state leans on the overall frequencies."""
    emit = emit + PRIOR * overall[:, None]
    return Model(
        (start + 1) / (start + 1).sum(), (moves + 1) / (moves + 1).sum(axis=1, keepdims=True), emit / emit.sum(axis=0)
    )


def first_model(overall: np.ndarray, states: int, seed: int = 0) -> Model:
    """States that lean by chance from the overall frequencies, each to words of its own."""
    draw = np.random.default_rng(seed)
    emit = overall[:, None] * draw.gamma(2.0, 0.5, (len(overall), states))
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


def step(encoded: DataFrame, model: Model, overall: np.ndarray) -> Model:
    """One Baum-Welch step over all rows of ``encoded``: sums of the tasks' expected counts.

    A task hands on counts of every symbol and state, however few rows it read: so there are
    ``_SUMMING`` tasks for a core and no more, and what is shuffled does not grow with the corpus.
    """
    context = encoded.sparkSession.sparkContext
    shared = context.broadcast(model)
    states = len(model.start)

    def expect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, moves, emit = np.zeros(states), np.zeros((states, states)), np.zeros_like(shared.value.emit)
        for batch in batches:
            seqs = _sequences(batch.column("seq"))
            for group in _groups(seqs):
                a, b, c = Trellis([seqs[i] for i in group], shared.value).expected()
                start, moves = start + a, moves + b
                emit += c
        parts = [emit[i : i + _CHUNK] for i in range(0, len(emit), _CHUNK)] + [moves, start]
        yield pa.record_batch({
            "chunk": pa.array(range(len(parts)), pa.int32()), "held": pa.array([p.tobytes() for p in parts], pa.binary()),
        })

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(h, np.float64) for h in group["held"])
        return pd.DataFrame({"chunk": group["chunk"].iloc[:1], "held": [total.tobytes()]})

    read = encoded.select("seq").coalesce(_SUMMING * context.defaultParallelism)
    sums = read.mapInArrow(expect, "chunk int, held binary")
    rows = sums.groupBy("chunk").applyInPandas(add, "chunk int, held binary").collect()
    held = [np.frombuffer(r.held, np.float64) for r in sorted(rows, key=lambda r: r.chunk)]
    shared.unpersist()
    if not held:
        return model
    return fitted(held[-1], held[-2].reshape(states, states), np.concatenate(held[:-2]).reshape(-1, states), overall)


def score_documents(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
    states: int = STATES, core: int = CORE, steps: int = STEPS,
) -> DataFrame:
    """Log10 probabilities of all rows under a model of the rows where ``learn`` holds.

    doc_id, n_tokens, n_known, train_tokens, base_score (words independent of each other,
    add-one over the training counts) and score (this model), for every row of ``docs``.  A null
    text is an empty one: it has just the end.  Repeated rows each get their result
    and each count.  Without training rows every word is unknown.  Other columns are not looked at.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    counts = settings.written(count_words(docs.where("learn")), "word-counts")
    documents = docs.where("learn").count()
    symbols = learn_symbols(counts, documents, core)
    encoded = settings.written(encode(docs.withColumn("row", F.monotonically_increasing_id()), symbols), "symbols")
    overall = symbols.counts + 1.0
    overall /= overall.sum()

    model = first_model(overall, states)
    for _ in range(steps):
        model = step(encoded.where("learn"), model, overall)

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def forward(batch: pa.RecordBatch) -> pa.RecordBatch:
        seqs = _sequences(batch.column("seq"))
        out = np.zeros(len(seqs))
        for group in _groups(seqs):
            out[group] = Trellis([seqs[i] for i in group], shared.value).log10()
        return batch.drop_columns(["seq"]).append_column("symbols_score", pa.array(out))

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = map_batches(
        encoded.select("row", "doc_id", "n_tokens", "core_known", "core_base", "seq"), forward,
        f"row long, doc_id {kind}, n_tokens long, core_known long, core_base double, symbols_score double",
    )
    rest = _others(encoded, counts, symbols)
    total, zero = F.lit(symbols.tokens).cast("long"), F.lit(0.0)
    return scored.join(rest, "row", "left").select(
        "doc_id", "n_tokens", (F.col("core_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        total.alias("train_tokens"), (F.col("core_base") + F.coalesce("base", zero)).alias("base_score"),
        (F.col("symbols_score") + F.coalesce("inside", zero)).alias("score"),
    )


def _others(encoded: DataFrame, counts: DataFrame, symbols: Symbols) -> DataFrame:
    """Per row: known words outside the core, their base score and score inside their classes."""
    totals = symbols.counts[len(symbols.core) : symbols.end] + symbols.known + 1
    inside = F.element_at(F.array(*[F.lit(float(t)) for t in totals]), F.col("k") + 1)
    named = settings.unfolded(encoded.select("row", "others"), "others", "word").select("row", "word")
    joined = named.join(counts, "word", "left").select(
        "row", F.coalesce("n", F.lit(0)).alias("n"),
        (F.crc32(F.substring("word", -2, 2).cast("binary")) % ENDINGS).cast("int").alias("k"),
    )
    return joined.groupBy("row").agg(
        F.sum((F.col("n") > 0).cast("long")).alias("known"),
        F.sum(F.log10((F.col("n") + 1) / F.lit(float(symbols.tokens + symbols.distinct + 1)))).alias("base"),
        F.sum(F.log10((F.col("n") + 1) / inside)).alias("inside"),
    )
