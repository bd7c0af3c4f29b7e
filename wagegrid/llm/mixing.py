"""Mixing sources to target weights by a hypergeometric splitting tree.

A source's documents, in an order drawn by hash, lie end to end on a line of words;
a target above the source's size runs through the line again.  The line up to the target
is cut into blocks of ``block`` words, the last one shorter.  A tree over the output
shards splits the exact numbers of blocks of all sources in two at every node: the left
half gets a multivariate hypergeometric draw.  A task can walk from the root to its shard
by itself, as the draws depend on the seed and the node alone.  A shard gets, for each
source, a run of that source's permuted blocks that no other shard has, and shuffles
its pieces.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.llm.common import looked_up

#: A source gives at most so many times its size, and so does a document.
MOST = 3
#: Weights of sources in order of code points, repeated; a null source comes last.
WEIGHTS = (1, 2, 3)
#: Words in a block, and blocks in a shard.
BLOCK = 5_000
SHARD_BLOCKS = 200
#: Documents whose places on the line are worked out together.
_RUN = 5_000
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> dict[str | None, float]:
    """Words to take from each source.

    The sources share the sum of all sizes by weight; who would exceed ``most`` times its
    size gets that, and the others share the rest by weight, until nobody exceeds.
    """
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    rest, free = sum(sizes.values()), list(order)
    targets: dict[str | None, float] = {}
    while free:
        share = rest / sum(weight[s] for s in free)
        over = [s for s in free if share * weight[s] > most * sizes[s]]
        if not over:
            return targets | {s: share * weight[s] for s in free}
        for s in over:
            targets[s] = float(most * sizes[s])
            rest -= most * sizes[s]
        free = [s for s in free if s not in targets]
    return targets


def shard_runs(quotas: np.ndarray, shards: int, shard: int, seed: int) -> list[tuple[int, int, int]]:
    """(source, first block, blocks) of one shard: the walk from the root to its leaf."""
    left = quotas.astype(np.int64)
    begin, node, lo, hi = np.zeros(len(left), np.int64), 1, 0, shards
    while hi - lo > 1:
        middle = (lo + hi) // 2
        take = int(left.sum()) * (middle - lo) // (hi - lo)
        draw = np.random.default_rng([seed, node])
        part = draw.multivariate_hypergeometric(left, take, method="marginals") if take else left * 0
        if shard < middle:
            left, hi, node = part, middle, 2 * node
        else:
            begin, left, lo, node = begin + part, left - part, middle, 2 * node + 1
    return [(i, int(begin[i]), int(left[i])) for i in np.flatnonzero(left).tolist()]


def _stride(n: int, seed: int) -> int:
    """A step without a common divisor with ``n``, so that multiples visit all blocks."""
    step = max(1, int(n * 0.6180339887) + seed % 97) % n if n > 1 else 0
    while n > 1 and math.gcd(step, n) != 1:
        step = (step + 1) % n
    return step


def _placed(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` with ``start``: words of the source's line before the document."""
    runs = rows.groupBy("number").agg(F.ceil(F.count("*") / _RUN).alias("runs"))
    mixed = F.xxhash64(F.lit(seed), "doc_id", "size", "content")
    rows = looked_up(rows, runs, "number", F.col("row"))
    rows = rows.withColumn("mixed", mixed).withColumn("run", F.pmod("mixed", "runs")).drop("runs")
    sums = rows.groupBy("number", "run").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("number").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    inside = Window.partitionBy("number", "run").orderBy("mixed", "doc_id", "size", "content")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(sums, ["number", "run"])
    return joined.withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))).drop(
        "run", "before", "mixed"
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    seed: int = 7, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS, row_col: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The documents with their source's target, and the pieces of the mix.

    First: row, doc_id, source, size, source_size, target for every row of ``docs``.  Second:
    shard, position, row, doc_id, pass, first_word, words: words ``first_word`` to
    ``first_word + words`` of a document, ``pass`` being how often the document was
    run through before.  Positions shuffle the pieces of a shard.

    ``row`` numbers the rows of ``docs`` (``row_col`` names a column that does so already): rows
    that share an id are documents of their own, with any sizes, sources and texts.  Places on
    the line follow from id, size and text alone, so that equal inputs give equal mixes
    however they are dealt over tasks; equal rows are interchangeable.  A null text has no
    words and gives no piece; a null source is a source of its own, the last one; null ids are
    ids like others.  An empty table has an empty mix.  The driver holds one number per
    source.  Other columns are not looked at.
    """
    number = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    rows = docs.select(
        number.alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("content"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("")).alias("key"),
    )
    rows = settings.written(rows, "mix-sizes")
    spark = docs.sparkSession
    sizes = {r.source: r.size for r in rows.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    targets = source_targets(sizes)
    names = list(targets)
    lines = [round(targets[s]) for s in names]
    quotas = [-(-n // block) for n in lines]
    facts = spark.createDataFrame(
        [(i, "" if s is None else f"={s}", sizes[s], float(targets[s]), lines[i], quotas[i]) for i, s in enumerate(names)],
        "number int, key string, source_size long, target double, line long, quota long",
    )
    kept = looked_up(rows, facts, "key", F.col("row")).drop("key")
    kept = settings.written(_placed(kept, seed), "mix-places")

    # blocks that each pass of a document touches
    passes = F.sequence(F.lit(0), F.floor((F.col("line") - F.col("start") - 1) / F.col("source_size")).cast("int"))
    held = settings.unfolded(kept.where("size > 0 AND start < line"), passes, "pass")
    begin = F.col("start") + F.col("pass") * F.col("source_size")
    held = held.withColumn("begin", begin).withColumn("end", F.least(begin + F.col("size"), F.col("line")))
    touched = F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block))
    pieces = settings.unfolded(held.select("number", "row", "doc_id", "content", "pass", "begin", "end"), touched, "block")
    owned = _owners(spark, np.array(quotas, np.int64), shard_blocks, seed)
    low, high = F.greatest("begin", F.col("block") * block), F.least("end", (F.col("block") + 1) * block)
    pieces = pieces.join(owned, ["number", "block"]).select(
        "shard", "row", "doc_id", "content", "pass", (low - F.col("begin")).alias("first_word"), (high - low).alias("words")
    )
    told = ["doc_id", "content", "pass", "first_word"]
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 1), "shard", *told), *told)
    pieces = pieces.withColumn("position", F.row_number().over(local) - 1)
    return kept.select("row", "doc_id", "source", "size", "source_size", "target"), pieces.select(
        "shard", "position", "row", "doc_id", "pass", "first_word", "words"
    )


def _owners(spark, quotas: np.ndarray, shard_blocks: int, seed: int) -> DataFrame:
    """(number, block, shard): the shard of every block of every source."""
    shards = max(1, -(-int(quotas.sum()) // shard_blocks))

    def walk(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"].tolist():
                for number, first, n in shard_runs(quotas, shards, shard, seed):
                    total = int(quotas[number])
                    at = (np.arange(first, first + n) * _stride(total, seed)) % total
                    yield pd.DataFrame({"number": number, "block": at, "shard": shard})

    return spark.range(shards).mapInPandas(walk, "number int, block long, shard long")


def taken(documents: DataFrame, pieces: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes, repeats counted)."""
    words = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    joined = documents.join(words, "row", "left")
    return joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 7, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """The mix as rows with the columns of ``docs`` (doc_id, text, source, n_chars among them).

    One row for each pass in which the mix takes a document; where it takes only part
    of a document's words, the text is cut to them, from the first to the last taken
    (pieces of a pass are neighbours).  ``n_chars`` follows the text.  The rows are written
    once with a number, by which their pieces find them.  Rows without words are in no mix.
    """
    docs = settings.written(docs.withColumn("#row", F.monotonically_increasing_id()), "mix-docs")
    _, pieces = mix(docs, seed=seed, block=block, shard_blocks=shard_blocks, row_col="#row")
    parts = pieces.groupBy(F.col("row").alias("#row"), "pass").agg(
        F.min("first_word").alias("#first"), F.sum("words").alias("#words"),
    ).drop("pass")
    joined = docs.join(parts, "#row")
    whole = F.col("#words") >= word_count(F.col("text"))
    # words and the white space behind each
    runs = F.slice(F.regexp_extract_all("text", F.lit(_WORD + r"[\x20\x09-\x0D]*"), F.lit(0)),
                   (F.col("#first") + 1).cast("int"), F.col("#words").cast("int"))
    cut = F.regexp_replace(F.array_join(runs, ""), r"[\x20\x09-\x0D]+$", "")
    changed = joined.withColumn("#whole", whole).withColumn("text", F.when(F.col("#whole"), F.col("text")).otherwise(cut))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.when(F.col("#whole"), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return changed.drop("#row", "#first", "#words", "#whole")
