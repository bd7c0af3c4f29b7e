"""Nearest neighbours by inner product: stable projections in a kd-tree, chi-square stop.

Vectors of a band of norms (a factor of two) get one more component that brings them all to
the same norm, so the largest inner product is the smallest distance.  A fixed Gaussian
matrix projects them to ``PROJECTED`` dimensions: the squared projected distance over the
squared distance is chi-square distributed.  A kd-tree over a bounded sample of
projections cuts the space into regions; every vector goes to the region of its projection, and
each region (dealt by hash into parts if it holds many) is a kd-tree of its own in a task.

A query starts in the region nearest to its projection.  In a tree it takes leaves by growing
projected distance and verifies their vectors with exact inner products, until the
chi-square test says that a vector nearer than the k-th best would have been seen by now
with probability ``SURE``.  The k-th best found there is the bound with which the query goes
on to the other regions that the same test does not rule out.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.llm.vectors import matrix, most_common_size, sampled, usable

PROJECTED = 12
#: Probability with which a nearer vector would have been met when a search stops.
SURE = 0.98
#: Sampled projections that the regions are cut from, and vectors in a region, about.
SAMPLE = 20_000
REGION = 8_192
_LEAF = 64
_MOST_REGIONS = 1_024
_QUERIES = 512  # searched together in a task
_BLOCK = 4_096  # queries sent to a region together


def chi_square_point(degrees: int, share: float) -> float:
    """The point below which a chi-square variable lies with probability ``share``."""
    def below(x: float) -> float:
        term = total = math.exp(-x / 2 + degrees / 2 * math.log(x / 2) - math.lgamma(degrees / 2 + 1))
        n = degrees / 2
        while term > 1e-16 * total:
            n += 1
            term *= x / 2 / n
            total += term
        return total

    low, high = 1e-9, 10.0 * degrees + 100
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < share else (low, middle)
    return high


def directions(size: int, projected: int = PROJECTED, seed: int = 17) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(size, projected))


def kd_leaves(points: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Positions of the points in each leaf: halves along the widest side, again and again."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        own = todo.pop()
        spread = np.ptp(points[own], axis=0) if len(own) else np.zeros(1)
        if len(own) <= leaf or spread.max() == 0:
            out += np.array_split(own, max(1, -(-len(own) // leaf)))
            continue
        side = int(spread.argmax())
        middle = len(own) // 2
        order = np.argpartition(points[own, side], middle)
        todo += [own[order[middle:]], own[order[:middle]]]
    return out


def box_distances(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every query to every box."""
    out = np.zeros((len(queries), len(low)))
    for i in range(queries.shape[1]):
        q = queries[:, i, None]
        out += np.maximum(np.maximum(low[None, :, i] - q, q - high[None, :, i]), 0) ** 2
    return out


def cuts(points: np.ndarray, leaf: int) -> list[tuple[int, float, int, int]]:
    """A kd-tree of splits (side, threshold, child below, child above); leaves are -1 - region."""
    nodes: list[tuple[int, float, int, int]] = []
    regions = 0

    def build(own: np.ndarray) -> int:
        nonlocal regions
        spread = np.ptp(points[own], axis=0) if len(own) else np.zeros(1)
        if len(own) <= leaf or spread.max() == 0:
            regions += 1
            return -regions
        side = int(spread.argmax())
        middle = float(np.median(points[own, side]))
        below = points[own, side] <= middle
        if below.all():
            middle = float(points[own, side][points[own, side] < middle].max())
            below = points[own, side] <= middle
        at = len(nodes)
        nodes.append((side, middle, 0, 0))
        children = build(own[below]), build(own[~below])
        nodes[at] = side, middle, *children
        return at

    build(np.arange(len(points)))
    return nodes


def regions_of(points: np.ndarray, nodes: list[tuple[int, float, int, int]]) -> np.ndarray:
    out = np.zeros(len(points), np.int64)
    todo = [(0, np.arange(len(points)))] if nodes else []
    while todo:
        node, own = todo.pop()
        if node < 0:
            out[own] = -node - 1
            continue
        side, middle, low, high = nodes[node]
        below = points[own, side] <= middle
        todo += [(low, own[below]), (high, own[~below])]
    return out


class _Search:
    """What tasks share: dimensions, projection, test."""

    def __init__(self, size: int, k: int):
        self.size, self.k = size, k
        self.directions = directions(size + 1)
        self.reach = chi_square_point(PROJECTED, SURE)

    def raised(self, x: np.ndarray, top: float) -> np.ndarray:
        """Vectors with the component that brings them to norm ``top``, projected."""
        rest = np.sqrt(np.maximum(top * top - (x * x).sum(axis=1), 0))
        return x @ self.directions[:-1] + rest[:, None] * self.directions[-1]

    def in_region(self, held: pd.DataFrame, asked: pd.DataFrame, top: float) -> pd.DataFrame:
        """The k best of the region's vectors for each query; a query's ``bound`` is a
        score that a result must reach."""
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        if not len(held) or not len(asked):
            return empty
        x, ids = np.stack(held["vector"].to_numpy()), held["vec_id"].to_numpy()
        points = self.raised(x, top)
        leaves = kd_leaves(points, _LEAF)
        low = np.stack([points[own].min(axis=0) for own in leaves])
        high = np.stack([points[own].max(axis=0) for own in leaves])
        order = np.concatenate(leaves)
        x, ids = x[order], ids[order]
        edges = np.concatenate([[0], np.cumsum([len(own) for own in leaves])])
        out = []
        for a in range(0, len(asked), _QUERIES):
            part = asked.iloc[a : a + _QUERIES]
            out.append(self._search(x, ids, edges, low, high, part, top))
        return pd.concat(out) if out else empty

    def _search(self, x, ids, edges, low, high, part: pd.DataFrame, top: float) -> pd.DataFrame:
        q, query_ids = np.stack(part["vector"].to_numpy()), part["query_id"].to_numpy()
        bound = part["bound"].to_numpy()
        lengths = (q * q).sum(axis=1)
        projected = q @ self.directions[:-1]
        gaps = box_distances(projected, low, high)
        visit = np.argsort(gaps, axis=1, kind="stable")
        gaps = np.take_along_axis(gaps, visit, axis=1)
        scores = np.full((len(q), len(x)), -np.inf)
        best = bound.copy()  # the k-th best score so far, at least the bound
        live, done, n = np.arange(len(q)), 0, 4
        k = min(self.k + 1, len(x))
        while len(live) and done < len(low):
            for leaf in np.unique(visit[live, done : done + n]).tolist():
                rows = live[(visit[live, done : done + n] == leaf).any(axis=1)]
                scores[rows, edges[leaf] : edges[leaf + 1]] = q[rows] @ x[edges[leaf] : edges[leaf + 1]].T
            done, n = done + n, 2 * n
            kth = -np.partition(-scores[live], k - 1, axis=1)[:, k - 1]
            best[live] = np.maximum(bound[live], kth) if len(x) > self.k else bound[live]
            if done < len(low):
                distance = np.maximum(top * top + lengths[live] - 2 * best[live], 0)
                live = live[gaps[live, done] < self.reach * distance]
        # exact scores of all that may be among the k best, ties included
        slack = 1e-12 * top * np.sqrt(lengths)
        rows, columns = np.nonzero((scores >= (best - slack)[:, None]) & np.isfinite(scores))
        keep = ids[columns] != query_ids[rows]
        rows, columns = rows[keep], columns[keep]
        exact = np.concatenate([
            (q[rows[i : i + 100_000]] * x[columns[i : i + 100_000]]).sum(axis=1) for i in range(0, len(rows), 100_000)
        ]) if len(rows) else np.zeros(0)
        order = np.lexsort((ids[columns], -exact, rows))
        rows, columns, exact = rows[order], columns[order], exact[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        rows, columns, exact = rows[rank < self.k], columns[rank < self.k], exact[rank < self.k]
        return pd.DataFrame({"query_id": query_ids[rows], "vec_id": ids[columns], "score": exact})


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score for the ``k`` best vectors found for each query.

    Ids are longs and name a vector once in each frame; a query never finds its own id.
    Vectors that are null, empty, all zero or hold null or non-finite components take
    no part, nor do those of another length than most.  Repeated rows (same id and vector)
    count once.  Score is the inner product in double precision, ties go to the smaller id.
    With fewer candidates than ``k`` all are returned.  Other columns are not looked at.
    """
    spark = vectors.sparkSession
    held, asked = (
        df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
        .where(usable(F.col("vector")) & F.col("vec_id").isNotNull())
        for df in (vectors, queries)
    )
    size = most_common_size(held, "vector")
    fits = F.size("vector") == size
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, v: a + v * v))
    held = held.where(fits).dropDuplicates(["vec_id"]).withColumn("band", F.floor(F.log2(length)).cast("int"))
    held = settings.written(held.withColumn("length", length), "vectors")
    asked = asked.where(fits).dropDuplicates(["vec_id"]).select(F.col("vec_id").alias("query_id"), "vector")
    asked = settings.written(asked, "queries")
    bands = {r.band: r for r in held.groupBy("band").agg(F.count("*").alias("n"), F.max("length").alias("top")).collect()}
    search = _Search(max(size, 1), k)
    maps = {band: _region_map(held.where(F.col("band") == band), r, search) for band, r in sorted(bands.items())}
    tops = {band: float(r.top) for band, r in bands.items()}
    filed = settings.written(_filed(held, maps, tops, search), "regions")
    pieces = _pieces(filed)

    first = _routed(asked.withColumn("bound", F.lit(float("-inf"))), maps, tops, search, pieces, home=True)
    found = settings.written(_searched(filed, first, tops, search, pieces), "home-results")
    kth = found.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))
    kth = kth.select("query_id", F.when(F.size("s") >= k, F.element_at("s", k)).otherwise(F.lit(float("-inf"))).alias("bound"))
    going = asked.join(kth, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    rest = _routed(going, maps, tops, search, pieces, home=False)
    found = found.unionByName(_searched(filed, rest, tops, search, pieces))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _region_map(held: DataFrame, band, search: _Search) -> tuple[list, np.ndarray, np.ndarray]:
    """Splits of a band's regions, and the boxes that hold all their projections."""
    size = search.size
    rows = sampled(held.select("vec_id", "vector"), "vec_id", band.n, SAMPLE, 23).collect()
    points = search.raised(np.array([r.vector for r in rows], np.float64).reshape(-1, size), float(band.top))
    wanted = min(_MOST_REGIONS, max(1, band.n // REGION))
    nodes = cuts(points, max(1, -(-len(points) // wanted))) if len(points) else []
    n = max(1, len(nodes) + 1)
    # a region is the box its splits leave open; sides without a split have no end
    low, high = np.full((n, PROJECTED), -np.inf), np.full((n, PROJECTED), np.inf)
    todo = [(0, np.full(PROJECTED, -np.inf), np.full(PROJECTED, np.inf))] if nodes else []
    while todo:
        node, a, b = todo.pop()
        if node < 0:
            low[-node - 1], high[-node - 1] = a, b
            continue
        side, middle, below, above = nodes[node]
        c, d = b.copy(), a.copy()
        c[side], d[side] = middle, middle
        todo += [(below, a, c), (above, d, b)]
    return nodes, low, high


def _filed(held: DataFrame, maps: dict, tops: dict[int, float], search: _Search) -> DataFrame:
    size = search.size

    def file(frames):
        for batch in frames:
            x = matrix(batch.column("vector"), size)
            bands = batch.column("band").to_numpy()
            region = np.zeros(len(x), np.int64)
            for band in np.unique(bands).tolist():
                own = np.flatnonzero(bands == band)
                region[own] = regions_of(search.raised(x[own], tops[band]), maps[band][0])
            yield batch.select(["vec_id", "vector", "band"]).append_column("region", _array(region))

    return held.mapInArrow(file, "vec_id long, vector array<double>, band int, region long")


def _array(values: np.ndarray):
    import pyarrow as pa

    return pa.array(values)


def _pieces(filed: DataFrame) -> dict[tuple[int, int], int]:
    """Parts of each region, by its rows: at most ``_MOST_REGIONS`` numbers for a band."""
    rows = filed.groupBy("band", "region").count().collect()
    return {(r.band, r.region): max(1, -(-r["count"] // (2 * REGION))) for r in rows}


def _routed(asked: DataFrame, maps: dict, tops: dict[int, float], search: _Search, pieces: dict, home: bool) -> DataFrame:
    """Queries with the regions they visit: the nearest one, or all others not ruled out."""
    size, reach = search.size, search.reach
    full = {band: np.array([(band, r) in pieces for r in range(len(maps[band][1]))]) for band in maps}

    def route(frames):
        import pyarrow as pa

        for batch in frames:
            q = matrix(batch.column("vector"), size)
            bound = batch.column("bound").to_numpy()
            projected, lengths = q @ search.directions[:-1], (q * q).sum(axis=1)
            gaps, bands, regions, limits = [], [], [], []
            for band, (_, low, high) in maps.items():
                gap = box_distances(projected, low, high)
                gap[:, ~full[band]] = np.inf
                gaps.append(gap)
                bands += [band] * len(low)
                regions += range(len(low))
                # inner products cannot exceed the lengths' product
                limits.append(np.where(tops[band] * np.sqrt(lengths) >= bound, 1.0, -1.0)[:, None] * reach
                              * np.maximum(tops[band] ** 2 + lengths - 2 * bound, 0)[:, None] * np.ones((1, len(low))))
            if not gaps:
                continue
            gap, limit = np.concatenate(gaps, axis=1), np.concatenate(limits, axis=1)
            # the home: the nearest region in the band of the longest vectors
            top = max(maps)
            own = gap[:, np.array(bands) == top].argmin(axis=1) + bands.index(top)
            if home:
                rows, columns = np.arange(len(q)), own
            else:
                away = np.isfinite(gap) & (gap <= limit)
                away[np.arange(len(q)), own] = False
                rows, columns = np.nonzero(away)
            yield pa.record_batch({
                "query_id": batch.column("query_id").take(pa.array(rows)), "vector": batch.column("vector").take(pa.array(rows)),
                "bound": batch.column("bound").take(pa.array(rows)),
                "band": pa.array(np.array(bands, np.int32)[columns]), "region": pa.array(np.array(regions, np.int64)[columns]),
            })

    return asked.mapInArrow(route, "query_id long, vector array<double>, bound double, band int, region long")


def _searched(filed: DataFrame, routed: DataFrame, tops: dict[int, float], search: _Search, pieces: dict) -> DataFrame:
    """Results of the routed queries, by parts of regions and blocks of queries."""
    spark: SparkSession = filed.sparkSession
    routed = settings.written(routed, "routed")
    asked = {(r.band, r.region): r["count"] for r in routed.groupBy("band", "region").count().collect()}
    facts = spark.createDataFrame(
        [(b, r, pieces[b, r], max(1, -(-n // _BLOCK))) for (b, r), n in asked.items()],
        "band int, region long, parts int, blocks int",
    )
    def every(n: str):
        return F.sequence(F.lit(0), F.col(n) - 1)

    x = filed.join(F.broadcast(facts), ["band", "region"]).withColumn("part", F.pmod(F.hash("vec_id"), "parts"))
    x = settings.unfolded(x, every("blocks"), "block").select("band", "region", "part", "block", "vec_id", "vector")
    q = routed.join(F.broadcast(facts), ["band", "region"]).withColumn("block", F.pmod(F.hash("query_id"), "blocks"))
    q = settings.unfolded(q, every("parts"), "part").select("band", "region", "part", "block", "query_id", "vector", "bound")

    def run(key: tuple, held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        return search.in_region(held, asking, tops[int(key[0])])

    by = ["band", "region", "part", "block"]
    return x.groupBy(*by).cogroup(q.groupBy(*by)).applyInPandas(run, "query_id long, vec_id long, score double")
