"""Near-duplicate vectors by cosine: an inverted multi-index over vector halves.

Equal vectors form a class; classes are compared.  Two codebooks, one for each half of the
unit vectors, span a grid of cells.  A vector's way through the grid takes cells by
growing distance (for each half, the squared distance from the vector to the border of
the code's region; the two sums in order are the multi-sequence) and stops where a vector
at the threshold lies beyond with probability 1 - ``RECALL``: its offset has a random direction,
so the part across the borders is chi-square distributed.  Two vectors meet in one cell only,
that of the later of them in the order of cells.

A cell's vectors and visitors are dealt by hash into blocks; a task multiplies two
blocks, and hands on counts of links and one link per vector that spans the block's
components, never the pairs themselves.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.llm.common import map_batches
from wagegrid.llm.graph import components
from wagegrid.llm.vectors import matrix, most_common_size, sampled, usable

RECALL = 0.999
#: Sampled vectors the codebooks are fitted on; vectors in a cell, about; codes of a half at most.
SAMPLE = 20_000
CELL = 512
_MOST_CODES = 1_024
_PART = 1_024  # vectors of a cell compared at a time
_BLOCK = 2_048  # visitors compared at a time


def codebook(points: np.ndarray, codes: int, seed: int, rounds: int = 6) -> np.ndarray:
    """Centres by a few rounds of k-means."""
    draw = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    if len(points) <= codes:
        return points
    centres = points[draw.choice(len(points), codes, replace=False)]
    for _ in range(rounds):
        near = distances(points, centres).argmin(axis=1)
        counts = np.bincount(near, minlength=codes)
        sums = np.stack([np.bincount(near, points[:, i], codes) for i in range(points.shape[1])], axis=1)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return np.unique(centres, axis=0)


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all centres."""
    return np.maximum((points**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * points @ centres.T, 0)


def borders(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest code of each point, and the squared distance to each code's region (at least)."""
    to = distances(points, centres)
    near = to.argmin(axis=1)
    apart = np.sqrt(np.maximum(distances(centres, centres), 1e-300))[near]
    gap = np.maximum(to - to[np.arange(len(points)), near][:, None], 0) / (2 * apart)
    gap[np.arange(len(points)), near] = 0
    return near, gap**2


def traversal(first: np.ndarray, second: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Codes (i, j) whose sum is at most ``reach``, by growing sum."""
    rows, columns = np.flatnonzero(first <= reach), np.argsort(second, kind="stable")
    ends = np.searchsorted(second[columns], reach - first[rows], side="right")
    i = np.repeat(rows, ends)
    j = np.concatenate([columns[:n] for n in ends.tolist()]) if len(rows) else columns[:0]
    order = np.argsort(first[i] + second[j], kind="stable")
    return i[order], j[order]


def linked(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` have at least the cosine (close calls by the plain formula)."""
    unit_a, unit_b = (x / np.sqrt((x * x).sum(axis=1))[:, None] for x in (a, b))
    found = unit_a @ unit_b.T
    out = found >= cosine
    for i, j in zip(*np.nonzero(np.abs(found - cosine) < 1e-10), strict=True):
        x, y = a[i], b[j]
        out[i, j] = (x * y).sum() / (math.sqrt((x * x).sum()) * math.sqrt((y * y).sum())) >= cosine
    return out


def block_components(mask: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id reachable from each row and column over the true cells of ``mask``."""
    far = np.iinfo(np.int64).max
    a, b = left.copy(), right.copy()
    while True:
        new_a = np.minimum(a, np.where(mask, b, far).min(axis=1, initial=far))
        new_b = np.minimum(b, np.where(mask, new_a[:, None], far).min(axis=0, initial=far))
        if (new_a == a).all() and (new_b == b).all():
            return a, b
        a, b = new_a, new_b


def near_vectors(
    vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors``.

    Vectors with at least the cosine (in double precision) link; ``n_links`` counts the
    other vectors linked directly.  Vectors that are null, empty, all zero or hold null or
    non-finite components, and those of another length than most, link with nothing.
    Ids are longs.  Repeated rows (same id and vector) are one vector; all come
    back.  A row with a null id links with nothing and is kept.  Other columns are not
    looked at.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    sound = usable(F.col("vector")) & F.col("vec_id").isNotNull()
    size = most_common_size(rows.where(sound), "vector")
    sound = sound & (F.size("vector") == size)
    rows = rows.withColumn("digest", F.when(sound, F.sha2(F.col("vector").cast("string").cast("binary"), 256)))
    ids = settings.written(rows.select("vec_id", "digest"), "vector-ids")
    classes = rows.where("digest IS NOT NULL").dropDuplicates(["vec_id", "digest"]).groupBy("digest").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("vector").alias("vector")
    )
    classes = settings.written(classes, "vector-classes")
    links = _block_links(classes, cosine, max(size, 2))
    links = settings.written(links, "vector-links")
    labels = components(links.select(F.col("id").alias("u"), F.col("root").alias("v")))
    counts = links.groupBy("id").agg(F.sum("n").alias("links"))

    facts = classes.select("digest", "rep", "n").join(counts, F.col("rep") == F.col("id"), "left").drop("id")
    facts = facts.join(labels, F.col("rep") == F.col("node"), "left").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"),
    )
    out = ids.join(facts, "digest", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )


def _block_links(classes: DataFrame, cosine: float, size: int) -> DataFrame:
    """(id, n, root): links of a class with others in one block, and an id it is linked to through them."""
    count = classes.count()
    codes = min(_MOST_CODES, max(1, round(math.sqrt(count / CELL))))
    rows = sampled(classes.select("rep", "vector"), "rep", count, SAMPLE, 29).orderBy("rep").collect()
    x = np.array([r.vector for r in rows], np.float64).reshape(-1, size)
    x /= np.maximum(np.sqrt((x * x).sum(axis=1)), 1e-300)[:, None]
    half = size // 2
    books = [codebook(part, codes, 31) if len(part) else np.zeros((1, part.shape[1])) for part in (x[:, :half], x[:, half:])]
    wide = len(books[1])
    # squared length of the offset at the threshold, spread evenly over all directions
    reach = 2 * (1 - cosine) / size * 2 * math.log(1 / (1 - RECALL))

    def visit(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        x = matrix(batch.column("vector"), size)
        x = x / np.sqrt((x * x).sum(axis=1))[:, None]
        (near_a, gap_a), (near_b, gap_b) = (borders(part, book) for part, book in zip((x[:, :half], x[:, half:]), books, strict=True))
        own = near_a * wide + near_b
        at, cells = [], []
        for k in range(len(x)):
            i, j = traversal(gap_a[k], gap_b[k], reach)
            visited = i * wide + j
            visited = visited[visited >= own[k]]
            cells.append(visited)
            at.append(np.full(len(visited), k))
        at, cells = np.concatenate(at), np.concatenate(cells)
        return pa.record_batch({
            "rep": batch.column("rep").take(pa.array(at)), "n": batch.column("n").take(pa.array(at)),
            "vector": batch.column("vector").take(pa.array(at)),
            "cell": pa.array(cells.astype(np.int64)), "own": pa.array(cells == own[at]),
        })

    visits = map_batches(
        classes.select("rep", "n", "vector"), visit, "rep long, n long, vector array<double>, cell long, own boolean"
    )
    visits = settings.written(visits, "visits")
    sizes = visits.groupBy("cell").agg(
        F.ceil(F.sum(F.col("own").cast("int")) / _PART).cast("int").alias("parts"),
        F.ceil(F.count("*") / _BLOCK).cast("int").alias("blocks"),
    ).where("parts > 0")

    def every(n: str):
        return F.sequence(F.lit(0), F.col(n) - 1)

    placed = visits.join(sizes, "cell")
    inside = placed.where("own").withColumn("part", F.pmod(F.hash("rep"), "parts"))
    inside = settings.unfolded(inside, every("blocks"), "block").select("cell", "part", "block", "rep", "n", "vector")
    asking = placed.withColumn("block", F.pmod(F.hash("rep"), "blocks"))
    asking = settings.unfolded(asking, every("parts"), "part").select("cell", "part", "block", "rep", "n", "vector", "own")

    def compare(inside: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(inside) or not len(asking):
            return pd.DataFrame({"id": [], "n": [], "root": []}).astype("int64")
        asking.columns = [c.removeprefix("asking_") for c in asking.columns]
        a, b = asking["rep"].to_numpy(), inside["rep"].to_numpy()
        mask = linked(np.stack(asking["vector"].to_numpy()), np.stack(inside["vector"].to_numpy()), cosine)
        # inside a cell a pair counts where the visitor's id is the smaller one
        mask &= ~asking["own"].to_numpy()[:, None] | (a[:, None] < b)
        rows, columns = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
        mask, a, b = mask[np.ix_(rows, columns)], a[rows], b[columns]
        roots = block_components(mask, a, b)
        return pd.DataFrame({
            "id": np.concatenate([a, b]),
            "n": np.concatenate([mask @ inside["n"].to_numpy()[columns], asking["n"].to_numpy()[rows] @ mask]).astype(np.int64),
            "root": np.concatenate(roots),
        })

    by = ["cell", "part", "block"]
    # other names for one side: both come from one table
    asking = asking.toDF(*(f"asking_{c}" for c in asking.columns))
    return inside.groupBy(*by).cogroup(asking.groupBy(*(f"asking_{c}" for c in by))).applyInPandas(compare, "id long, n long, root long")
